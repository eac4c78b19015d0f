"""Registered queries of the training-data operators, and SQL where it can say the same."""

from __future__ import annotations

from tideframe.llm import op5_url_rules, op8_mixing, op11_vector_codes, op12_neighbours, op13_fill_in_middle
from tideframe.llm.op1_toxicity import op1_toxicity
from tideframe.llm.op2_quality import op2_quality_rules
from tideframe.llm.op3_minhash import op3_minhash_dedup
from tideframe.llm.op4_chat import op4_chat_formatting
from tideframe.llm.op6_token_counts import op6_token_counts
from tideframe.llm.op7_language import op7_language_id
from tideframe.llm.op9_embeddings import op9_embedding_dedup
from tideframe.llm.op10_packing import op10_best_fit_packing

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_url_rules": op5_url_rules.op5_url_rules,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_mixing": op8_mixing.op8_mixing,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_vector_codes": op11_vector_codes.op11_vector_codes,
    "op12_neighbours": op12_neighbours.op12_neighbours,
    "op13_fill_in_middle": op13_fill_in_middle.op13_fill_in_middle,
}

ORACLE_SQL = {
    "op5_url_rules": op5_url_rules.ORACLE_SQL,
    "op8_mixing": op8_mixing.ORACLE_SQL,
    "op11_vector_codes": op11_vector_codes.ORACLE_SQL,
    "op13_fill_in_middle": op13_fill_in_middle.ORACLE_SQL,
}
