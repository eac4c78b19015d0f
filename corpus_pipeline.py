"""A training corpus from documents, stage by stage: each stage is written as Parquet and reread by the next.

Stages: quality rules, language ID, MinHash near-dedup, mixing to target weights, best-fit
packing. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideframe.llm import op2_quality, op3_minhash, op7_language, op8_mixing, op10_packing
from tideframe.llm.common import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity band of their language keep."""
    return op2_quality.kept_documents(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: with a posterior of one half at least and n-grams as likely as that language's have them; `und` goes."""
    return op7_language.told_languages(docs, op7_language.train(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return op3_minhash.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, once for each epoch."""
    return op8_mixing.mixed(docs)[0].select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return op10_packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("minhash_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: The language model, the classifier and the signatures of these stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; each stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
