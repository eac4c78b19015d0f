"""Product codes of vectors by exact integer k-means with norm-of-sum bounds.

Each component x is the integer floor(4096 x). A vector has PARTS equal parts, and each part position a codebook
of ENTRIES entries, which starts as that part of the smallest kept ids. Each of ROUNDS rounds assigns every part
to its nearest entry (ties to the lower index) and moves each entry to the floor of its parts' mean.

A part keeps its entry, an upper bound of its distance to it and a lower bound of its distance to
all others, each with the round in which it was computed. All codebooks so far are kept (16 entries for each
round, whatever the input), so in round t a bound of round s is corrected by how far entries have moved net
from s to t, the norm of the sum of their moves; the sum of the norms, which bounds that drift instead would add,
is never less. Only where the bounds do not tell the nearest entry is the upper one made exact, and only where
that does not tell either are all entries scanned. Bounds are rounded outward and compared strictly,
so every assignment is the exact one.

A round is one pass over the rows, which writes their new states to the shared folder and, for each task, what
the parts that changed entry add to and take from the sums of entries; those are a fixed number of rows a task and aggregate
in Spark, and only sums of entries reach the driver. The table of the round before is then removed.

Nulls: rows whose vector is null, empty or holds null or non-finite components are dropped, as are vectors of another
dimension than that of the smallest kept id; a null id sorts last, a null label is a label. Rows of equal ids are told apart by their components; repeated rows
each give a row. With fewer rows than entries the codebooks are as small as that. A dimension that PARTS does not divide is an error.
Integers beyond 2**28 are computed with whole Python integers, slower but exact; an error that a long cannot hold is then null. Other columns
are not looked at, so their names may be any. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.common import broadcast_if_small, removed, shared_folder, stored, tidied

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers up to this size have squared distances that 64 bits hold.
NARROW = 1 << 28
#: By this share a bound must clear another; distances are rounded to 1e-7 of their size.
MARGIN = 1e-6
STATE = np.dtype([("entry", "u1"), ("upper_round", "u1"), ("lower_round", "u1"), ("upper", "<f4"), ("lower", "<f4")])


class Codes(NamedTuple):
    """rows: vec_id, label, codes (a byte for each part), error; codebooks[part, entry, place] in integers."""

    rows: DataFrame
    codebooks: np.ndarray


def integers(column: pa.Array) -> np.ndarray:
    """floor(SCALE * x) of rows of one dimension; as Python integers where 64 bits may not hold their squares."""
    x = np.floor(np.asarray(column.flatten(), np.float64) * SCALE).reshape(len(column), -1)
    if np.abs(x).max(initial=0) <= NARROW:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], object)


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    if x.dtype == object or entries.dtype == object:
        return ((x.astype(object) - entries.astype(object)) ** 2).sum(axis=1)
    difference = x - entries
    return np.einsum("ij,ij->i", difference, difference)


class Bounds:
    """What the codebooks so far tell of one part position in the last round."""

    def __init__(self, history: list[np.ndarray]):
        self.t, self.book = len(history) - 1, history[-1]
        moved = np.array([np.sqrt(((self.book - h).astype(np.float64) ** 2).sum(axis=1)) for h in history])
        self.moved = moved  # of each entry, from the start of each round until now: net
        order = np.argsort(-moved, axis=1)
        self.farthest = order[:, 0]
        self.most = np.take_along_axis(moved, order[:, :1], 1)[:, 0]
        self.second = np.take_along_axis(moved, order[:, 1:2], 1)[:, 0] if len(self.book) > 1 else np.zeros(len(history))

    def assign(self, x: np.ndarray, state: np.ndarray) -> None:
        """Bring the states of parts x up to this round, in place."""
        entry = state["entry"].astype(int)
        upper = state["upper"] + self.moved[state["upper_round"], entry]
        since = state["lower_round"]
        lower = state["lower"] - np.where(self.farthest[since] == entry, self.second[since], self.most[since])
        unsure = np.flatnonzero(~(upper * (1 + MARGIN) < lower * (1 - MARGIN)))
        if not len(unsure):
            return
        exact = np.sqrt(_squared(x[unsure], self.book[entry[unsure]]).astype(np.float64))
        self.tell(state, "upper", unsure, exact)
        unsure = unsure[~(exact * (1 + MARGIN) < lower[unsure] * (1 - MARGIN))]
        if len(unsure):
            self.scan(x, state, unsure)

    def scan(self, x: np.ndarray, state: np.ndarray, rows: np.ndarray) -> None:
        """Compare some rows with every entry."""
        x = x[rows]
        squares = np.stack([_squared(x, np.broadcast_to(e, x.shape)) for e in self.book], axis=1)
        best = squares.argmin(axis=1)
        state["entry"][rows] = best
        distances = np.sqrt(squares.astype(np.float64))
        self.tell(state, "upper", rows, distances[np.arange(len(rows)), best])
        distances[np.arange(len(rows)), best] = np.inf
        self.tell(state, "lower", rows, distances.min(axis=1))

    def tell(self, state: np.ndarray, which: str, rows: np.ndarray, distance: np.ndarray) -> None:
        outward = np.float32(np.inf if which == "upper" else 0)
        with np.errstate(over="ignore"):
            state[which][rows] = np.nextafter(distance.astype(np.float32), outward)
        state[f"{which}_round"][rows] = self.t


def _pass(rows: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """One round over rows (vec_id, label, embedding, state): kind `row` with new states, and kind `sum` with what entries gain."""
    schema = rows.schema
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    total = pa.decimal128(38, 0)
    parts, k, width = history[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = [Bounds([h[p] for h in history]) for p in range(parts)]
        gain = np.zeros((parts, k, width), object)
        count = np.zeros((parts, k), np.int64)
        names = None
        for batch in batches:
            names = names or batch.schema
            step = max(1, (1 << 20) // (parts * width))
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                x = integers(piece.column("embedding")).reshape(piece.num_rows, parts, width)
                given = piece.column("state")
                fresh = given.null_count > 0
                state = np.zeros((len(x), parts), STATE) if fresh else np.frombuffer(b"".join(given.to_pylist()), STATE).reshape(len(x), parts).copy()
                for p, bound in enumerate(bounds):
                    before = state["entry"][:, p].copy()
                    if fresh:
                        bound.scan(x[:, p], state[:, p], np.arange(len(x)))
                    else:
                        bound.assign(x[:, p], state[:, p])
                    after = state["entry"][:, p]
                    changed = np.flatnonzero((before != after) | fresh)
                    for e in range(k):
                        joins, leaves = changed[after[changed] == e], changed[before[changed] == e] if not fresh else changed[:0]
                        if len(joins) or len(leaves):
                            gain[p, e] += x[joins, p].sum(axis=0).astype(object) - x[leaves, p].sum(axis=0).astype(object)
                            count[p, e] += len(joins) - len(leaves)
                states = pa.array([s.tobytes() for s in state], pa.binary())
                n = piece.num_rows
                none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(total))]
                yield pa.RecordBatch.from_arrays([pa.array(["row"] * n), *(piece.column(c) for c in ("vec_id", "label", "embedding")), states, *none], names=out)
        told = [(p, e) for p in range(parts) for e in range(k) if count[p, e] or gain[p, e].any()]
        if told:
            m = len(told)
            sums = pa.array([[Decimal(int(v)) for v in gain[p, e]] for p, e in told], pa.list_(total))
            columns = [pa.nulls(m, names.field(c).type) for c in ("vec_id", "label", "embedding", "state")]
            yield pa.RecordBatch.from_arrays([pa.array(["sum"] * m), *columns, pa.array([p for p, _ in told], pa.int32()), pa.array([e for _, e in told], pa.int32()), pa.array([int(count[i]) for i in told]), sums], names=out)

    out = ["kind", "vec_id", "label", "embedding", "state", "part", "entry", "n", "gain"]
    return rows.mapInArrow(tidied(run), f"kind string, {kinds}, part int, entry int, n long, gain array<decimal(38,0)>")


def _finals(rows: DataFrame, book: np.ndarray) -> DataFrame:
    """vec_id, label, codes, error of rows in their last state."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    parts, _, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 20) // (parts * width))
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                n = piece.num_rows
                x = integers(piece.column("embedding")).reshape(n, parts, width)
                entry = np.frombuffer(b"".join(piece.column("state").to_pylist()), STATE).reshape(n, parts)["entry"]
                error = sum(_squared(x[:, p], book[p, entry[:, p]]) for p in range(parts))
                errors = [int(e) if e < 1 << 63 else None for e in error.tolist()]
                yield pa.RecordBatch.from_arrays([piece.column("vec_id"), piece.column("label"), pa.array([e.tobytes() for e in np.ascontiguousarray(entry)], pa.binary()), pa.array(errors, pa.int64())], names=["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(tidied(run), f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error long")


def encode(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codebooks learned from all rows, and every row's codes."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    rows = rows.where(F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & (F.size("embedding") > 0))
    order = [F.asc_nulls_last("vec_id"), "embedding"]
    first = rows.orderBy(*order).first()
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    if first is None:
        return Codes(spark.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error long"), np.zeros((parts, 0, 0), np.int64))
    dim = len(first["embedding"])
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("embedding") == dim)
    start = [r["embedding"] for r in rows.orderBy(*order).limit(entries).collect()]
    book = integers(pa.array(start, pa.list_(pa.float64()))).reshape(len(start), parts, -1).transpose(1, 0, 2)
    history, sums, counts = [book], np.zeros(book.shape, object), np.zeros(book.shape[:2], object)
    rows, path = rows.withColumn("state", F.lit(None).cast("binary")), None
    schema = rows.schema
    for t in range(rounds + 1):
        made = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
        _pass(rows, history).write.partitionBy("kind").parquet(made)
        rows = spark.read.schema(schema).parquet(f"{made}/kind=row")
        if path:
            removed(spark, path)
        path = made
        if t == rounds:
            break
        gained = spark.read.schema("part int, entry int, n long, gain array<decimal(38,0)>").parquet(made).where("kind = 'sum'")
        places = gained.select("part", "entry", "n", F.posexplode("gain").alias("place", "gain"))
        for r in places.groupBy("part", "entry", "place").agg(F.sum("gain").alias("gain"), F.sum("n").alias("n")).collect():  # as many as the codebooks have components
            sums[r["part"], r["entry"], r["place"]] += int(r["gain"])
            if r["place"] == 0:
                counts[r["part"], r["entry"]] += r["n"]
        moved = history[-1].astype(object)
        for p, e in np.argwhere(counts > 0):
            moved[p, e] = sums[p, e] // counts[p, e]
        book = moved if np.abs(moved).max() > NARROW else moved.astype(np.int64)
        history.append(book)
    result = stored(_finals(rows, book))
    removed(spark, path)
    return Codes(result, book)


def code_text(codes: str = "codes"):
    """The codes of all parts in order, two hex digits each."""
    return F.lower(F.hex(codes))


def codebook_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in book.ravel()).encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """rows with label_error: the errors of all rows of equal label together; null where a long cannot hold it."""
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"))
    return rows.join(broadcast_if_small(by_label), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = with_label_error(found.rows)
    return rows.select("vec_id", code_text().alias("code"), "error", "label_error", F.lit(codebook_digest(found.codebooks)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same by full scans: one pair of common tables for each round."""
    nearest = "a{0} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT x.vec_id, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{0} c ON x.part = c.part AND x.place = c.place GROUP BY ALL) GROUP BY ALL)"
    moved = "c{1} AS MATERIALIZED (SELECT c.part, c.entry, c.place, coalesce(n.v, c.v) AS v FROM c{0} c LEFT JOIN (SELECT part, entry, place, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v FROM x JOIN a{0} USING (vec_id, part) GROUP BY ALL) n ON n.part = c.part AND n.entry = c.entry AND n.place = c.place)"
    steps = [s.format(t, t + 1) for t in range(rounds) for s in (nearest, moved)]
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
  size AS (SELECT max(len(embedding)) // {parts} AS width FROM kept),
  x AS MATERIALIZED (SELECT vec_id, i // width AS part, i % width AS place, CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS v FROM kept, size, unnest(range(0, width * {parts})) AS r(i)),
  s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}), c0 AS MATERIALIZED (SELECT part, entry, place, v FROM x JOIN s USING (vec_id)),
  {", ".join(steps)}, {nearest.format(rounds)},
  t AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
  l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM t JOIN kept USING (vec_id) GROUP BY label)
  SELECT t.vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) FROM c{rounds}) AS codebooks_sha256 FROM t JOIN kept USING (vec_id) JOIN l ON kept.label IS NOT DISTINCT FROM l.label"""


ORACLE_SQL = oracle_sql()
