"""Near-duplicate vectors by counted collisions of sorted projections.

Only vectors of one label and dimension are compared. Equal vectors are one class and are compared
once. There are TABLES projections; a table deals the vectors by the signs of a few random
hyperplanes, so that a bucket is about BUCKET rows at any size of the input, sorts each bucket by one Gaussian
projection, and lets two vectors collide when they lie within a window centred on either. Without
the signs, single projections collide for a fifth of all pairs, which is quadratic. Pairs that
collide in COUNT tables are verified by cosine in double precision. The number of tables follows
from the number of signs, so that a pair just at the threshold is found with a probability of
RECALL; a closer pair is found more often.

All tables of a pair are computed from its two vectors where they meet. A pair is only counted
in the first table where it collides, so a bucket gives each member's number of links and a
spanning forest of them: as many rows as members, not as pairs. A bucket of more than BLOCK rows is
cut into blocks, and each pair of blocks is a task's group of its own.

Nulls: vectors that are null, empty, zero or hold null or non-finite components, and vectors with
a null label, link with nothing; vectors of any finite magnitude are scaled before they are squared. Repeated
rows are links of each other; of rows with one id each gets a row. Equal projections lie in one window. Other columns are
not looked at, so their names may be any. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, comb, erf, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.common import stored, tidied
from tideframe.llm.components import connected

THRESHOLD, RECALL, COUNT = 0.98, 0.999, 2
BUCKET, BLOCK = 512, 1024
#: The window's half width, in standard deviations of the projected difference of a pair at the threshold.
WIDTH = 2.0
SEED = 29


def calibrated(rows: int, threshold: float = THRESHOLD, recall: float = RECALL, count: int = COUNT) -> tuple[int, int, float]:
    """Signs and tables for a label of so many rows, and the window."""
    signs = max(0, int(np.ceil(np.log2(max(rows, 1) / BUCKET))))
    p = (1 - acos(threshold) / pi) ** signs * erf(WIDTH / sqrt(2))
    tables = count
    while sum(comb(tables, k) * p**k * (1 - p) ** (tables - k) for k in range(count)) > 1 - recall:
        tables += 1
    return signs, tables, WIDTH * sqrt(2 - 2 * threshold)


def _directions(dim: int, signs: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, tables * signs)), rng.standard_normal((dim, tables))


def _units(column: pa.Array) -> np.ndarray:
    """Rows of equal dimension as double unit vectors; scaled by the largest component first, so that no square over- or underflows."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _codes(units: np.ndarray, signs: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row and table, the signs as an integer and the projection."""
    planes, lines = _directions(units.shape[1], signs, tables)
    bits = (units @ planes > 0).reshape(len(units), tables, signs)
    return (bits * (1 << np.arange(signs, dtype=np.int64))).sum(axis=2), units @ lines


def classes(vectors: DataFrame, embedding: str, label: str) -> DataFrame:
    """vectors with class: a digest of label and components; null where a vector links with nothing."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for tag, value in zip(batch.column(at_label).to_pylist(), batch.column(at_vector).to_pylist(), strict=True):
                fine = tag is not None and value is not None and len(value) and None not in value
                x = np.array(value, np.float64) if fine else np.zeros(1)
                fine = fine and np.isfinite(x).all() and x.any()
                digests.append(xxhash.xxh3_128_digest(repr(tag).encode() + b"\0" + x.tobytes()) if fine else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=[*batch.schema.names, "class"])

    at_label, at_vector = vectors.columns.index(label), vectors.columns.index(embedding)
    return vectors.mapInArrow(tidied(run), StructType([*vectors.schema.fields, StructField("class", BinaryType())]))


def links(rows: DataFrame, signs: int, tables: int, width: float, threshold: float = THRESHOLD, count: int = COUNT, block: int = BLOCK) -> DataFrame:
    """class, links, root: from each bucket, the vectors that a class is linked with there, and a class of its tree."""
    kind = rows.schema["embedding"].dataType.simpleString()

    def deal(with_vector: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    codes, _ = _codes(_units(part.column("embedding")), signs, tables)
                    which = np.repeat(np.arange(part.num_rows), tables)
                    key = [pa.array(np.tile(np.arange(tables, dtype=np.int32), part.num_rows)), pa.array(codes.ravel())]
                    taken = part.take(pa.array(which)) if with_vector else part.select(["label", "dim"]).take(pa.array(which))
                    yield pa.RecordBatch.from_arrays([*taken.columns, *key], names=[*taken.schema.names, "table", "code"])

        return run

    label_kind = rows.schema["label"].dataType.simpleString()
    bucket = ["label", "dim", "table", "code"]
    sizes = rows.mapInArrow(tidied(deal(False)), f"label {label_kind}, dim int, table int, code long").groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes.select(*bucket, F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = rows.mapInArrow(tidied(deal(True)), f"label {label_kind}, dim int, class binary, size long, embedding {kind}, table int, code long")
    dealt = dealt.join(sizes, bucket).withColumn("own", F.pmod(F.xxhash64("class", "table"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("group", F.xxhash64(*bucket, F.least("own", "other"), F.greatest("own", "other")))

    def pairs(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        column = lambda c: group.column(c).combine_chunks()
        units = _units(column("embedding"))
        codes, lines = _codes(units, signs, tables)
        table, own, other = (column(c).to_numpy() for c in ("table", "own", "other"))
        t, n = int(table[0]), len(units)
        order = np.argsort(lines[:, t], kind="stable")
        units, codes, lines, own, other = units[order], codes[order], lines[order], own[order], other[order]
        sizes = column("size").to_numpy()[order]
        stop = np.searchsorted(lines[:, t], lines[:, t] + width, "right")
        n_links, root = np.zeros(n, np.int64), np.arange(n)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for start in range(0, n, 128):
            rows = np.arange(start, min(start + 128, n))
            spans = stop[rows] - rows - 1
            a = np.repeat(rows, spans)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(spans) - spans, spans)
            good = (own[a] != own[b]) | (own[a] == other[a])
            a, b = a[good], b[good]
            met = np.zeros(len(a), np.int64)
            first = np.full(len(a), -1)
            for k in range(tables):
                hit = (codes[a, k] == codes[b, k]) & (np.abs(lines[a, k] - lines[b, k]) <= width)
                first = np.where((first < 0) & hit, k, first)
                met += hit
            good = (met >= count) & (first == t)
            a, b = a[good], b[good]
            good = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
            a, b = a[good], b[good]
            np.add.at(n_links, a, sizes[b])
            np.add.at(n_links, b, sizes[a])
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                i, j = find(i), find(j)
                if i != j:
                    root[max(i, j)] = min(i, j)
        linked = np.flatnonzero(n_links)
        names = column("class").take(pa.array(order))
        return pa.table([names.take(pa.array(linked)), pa.array(n_links[linked]), names.take(pa.array(np.array([find(i) for i in linked], np.int64)))], names=["class", "links", "root"])

    return dealt.select("group", "label", "dim", "class", "size", "embedding", "table", "own", "other").groupBy("group", "label", "dim", "table").applyInArrow(pairs, "class binary, links long, root binary")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of vectors."""
    given = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    rows = stored(classes(given, "embedding", "label"))
    by_class = rows.where(F.col("class").isNotNull()).groupBy("label", F.size("embedding").alias("dim"), "class")
    table = stored(by_class.agg(F.count("*").alias("size"), F.any_value("embedding").alias("embedding"), F.min("vec_id").alias("least")))
    largest = table.groupBy("label", "dim").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    signs, tables, width = calibrated(largest or 1, threshold)
    found = stored(links(table.select("label", "dim", "class", "size", "embedding"), signs, tables, width, threshold))
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    components = connected(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    whole = table.select("class", "size", "least").join(counts, "class", "left").join(components, "class", "left")
    whole = stored(whole.withColumn("component", F.coalesce("component", "class")))
    ids = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    digest = whole.join(ids, "component").select("class", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where(F.col("class").isNotNull()).join(digest, "class").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("class").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
