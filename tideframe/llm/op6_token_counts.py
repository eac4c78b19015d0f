"""Token counts without token ids.

1. Every task counts its distinct chunks (see tokens.py); one shuffle sums them.
2. The tokenizer runs once over each distinct chunk and gives its number of pieces.
3. The most frequent chunks of at most HEAD_BYTES bytes, HEAD at most, are broadcast; the table's
   size is bounded by these two numbers. They hold most of a text, and every hot chunk.
4. A document's frequencies of its other chunks are joined to the pieces by chunk, and summed.

Nulls: a null text counts as empty: 0 bytes, 0 tokens. Rows are told apart by a number of their
own, so null and repeated ids keep their rows. Texts of any length are whole; equal frequencies at the
head's edge go in or out together, which changes no count. Other columns are not looked at, so their names may
be any. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.common import byte_values, sliced, stored, tidied
from tideframe.llm.tokens import VOCABULARY, chunk_ids

LIMIT = 2048
HEAD, HEAD_BYTES = 131_072, 64
_FOLD_AT = 150_000


def chunk_counts(docs: DataFrame, text: str) -> DataFrame:
    """chunk, n over all texts; a task hands on its distinct chunks, a bounded number at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["chunk", "n"])
            found.clear()
            return made

        for batch in sliced(batches, 0):
            for value in byte_values(batch.column(0)):
                if value:
                    found.update(value.split())
            if len(found) > _FOLD_AT:
                yield out()
        yield out()

    return docs.select(F.col(text).alias("text")).mapInArrow(tidied(run), "chunk binary, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def piece_counts(chunks: DataFrame, vocabulary: str) -> DataFrame:
    """chunk, n, pieces: the tokenizer's number of tokens in each distinct chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids(vocabulary)
        for batch in sliced(batches, 0, 1 << 20):
            pieces = [len(x) // 4 for x in ids.encode(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int32())], names=["chunk", "n", "pieces"])

    return chunks.mapInArrow(tidied(run), "chunk binary, n long, pieces int")


def head_chunks(pieces: DataFrame) -> DataFrame:
    """chunk, pieces of the chunks above the smallest frequency that HEAD of them reach at most.

    The frequency is found from a histogram in steps of 2**(1/8), which has a few hundred rows.
    """
    short = pieces.where(F.length("chunk") <= HEAD_BYTES).withColumn("step", F.floor(F.log2("n") * 8).cast("int"))
    least, above = 0, 0
    for step, n in sorted(short.groupBy("step").count().collect(), reverse=True):
        above += n
        if above > HEAD:
            least = step + 1
            break
    return short.where(F.col("step") >= least).select("chunk", "pieces")


def token_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each row of docs."""
    pieces = stored(piece_counts(chunk_counts(docs, text), vocabulary))
    head = head_chunks(pieces).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(head.column(0).to_pylist(), head.column(1).to_pylist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in sliced(batches, 0):
            parents, chunks, times, heads, sizes = [], [], [], [], []
            for i, value in enumerate(byte_values(batch.column(0))):
                head_sum, own = 0, len(chunks)
                for chunk, n in Counter((value or b"").split()).items():
                    if chunk in known:
                        head_sum += n * known[chunk]
                    else:
                        chunks.append(chunk)
                        times.append(n)
                if len(chunks) == own:  # nothing to join: a key that no chunk has, spread over the partitions
                    chunks.append(b" %d" % (i % 4096))
                    times.append(0)
                parents.extend([i] * (len(chunks) - own))
                heads.extend([head_sum, *[0] * (len(chunks) - own - 1)])
                sizes.extend([len(value or b"")] * (len(chunks) - own))
            rows = np.array(parents, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(rows), batch.column(2).take(rows), pa.array(sizes, pa.int64()), pa.array(chunks, pa.binary()), pa.array(times, pa.int32()), pa.array(heads, pa.int64())], names=["row", "doc_id", "n_bytes", "chunk", "times", "head"])

    rows = docs.select(F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = rows.mapInArrow(tidied(run), f"row long, doc_id {kind}, n_bytes long, chunk binary, times int, head long")
    joined = parts.join(pieces.select("chunk", "pieces"), "chunk", "left")
    total = F.sum(F.col("head") + F.coalesce(F.col("times") * F.col("pieces"), F.lit(0)))
    summed = joined.groupBy("row", "doc_id", "n_bytes").agg(total.alias("n_tokens"))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
