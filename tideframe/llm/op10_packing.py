"""Best-fit packing of documents into sequences, by length patterns fitted to the histogram.

1. Each text becomes its token ids and a closing id; longer ones are cut into pieces of at most
   LENGTH tokens. Only the pieces' lengths and checksums go on.
2. The histogram of lengths has LENGTH rows at most, whatever the corpus; it alone reaches the driver.
   There, patterns of a few documents that fill a sequence are enumerated, their repeat counts
   fitted to the histogram by non-negative least squares, rounded down, and what remains is packed
   best-fit-decreasing, into the slack of the patterns first.
3. The plan says, for each length, which ranks of pieces go to which place of which sequences.
   Pieces get their ranks in parts of each length, so that a hot length is spread, and look up
   their place in the plan, whose size is bounded by LENGTH too.

Nulls: a null text counts as empty and is one piece that holds the closing id alone. Rows are
told apart by a number of their own; null and repeated ids keep their rows. An empty table packs
into nothing. More than one plan is best; ties go to the first pattern enumerated. Texts of any length
are whole. Other columns are not looked at, so their names may be any.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.llm.common import byte_values, sliced, stored, tidied
from tideframe.llm.tokens import VOCABULARY, chunk_ids

LENGTH = 2048
END_ID = 0
SWEEPS = 30


def token_pieces(docs: DataFrame, text: str, doc_id: str, vocabulary: str, length: int) -> DataFrame:
    """row, doc_id, piece, start, length, ids_crc32: the pieces of every text."""
    end = np.array([END_ID], "<u4").tobytes()
    names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids(vocabulary)
        for batch in sliced(batches, 0):
            parents, piece, start, size, crc = [], [], [], [], []
            for i, found in enumerate(ids.texts([(v or b"").split() for v in byte_values(batch.column(0))])):
                found += end
                for k, at in enumerate(range(0, len(found), 4 * length)):
                    part = found[at : at + 4 * length]
                    parents.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            rows = np.array(parents, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(rows), batch.column(2).take(rows), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=names)

    rows = docs.select(F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidied(run), f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# ---- the plan -------------------------------------------------------------------------------


def patterns(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths of the histogram, each closed by the longest one that still fits."""
    present = np.flatnonzero(histogram)
    if not len(present):
        return []

    def closed(*firsts: int) -> tuple[int, ...] | None:
        left = length - sum(firsts)
        at = int(np.searchsorted(present, left, "right")) - 1
        return tuple(sorted((*firsts, int(present[at])), reverse=True)) if at >= 0 else None

    cumulative = np.cumsum(histogram[present])
    grid = lambda n: sorted({int(present[np.searchsorted(cumulative, cumulative[-1] * (k + 0.5) / n)]) for k in range(n)})
    found = {closed(int(a)) or (int(a),): None for a in present}
    found |= {p: None for a in present for b in grid(16) if (p := closed(int(a), b))}
    few = grid(12)
    found |= {p: None for a in few for b in few if a <= b for c in few if b <= c and (p := closed(a, b, c))}
    return list(found)


def fitted(histogram: np.ndarray, found: list[tuple[int, ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative repeat counts of the patterns, least squares to the histogram, by cyclic coordinate descent."""
    residual = histogram.astype(float)
    columns = []
    for p in found:
        lengths, times = np.unique(p, return_counts=True)
        columns.append((lengths.tolist(), times.tolist(), float((times**2).sum())))
    x = [0.0] * len(found)
    r = residual.tolist()
    for _ in range(sweeps):
        moved = 0.0
        for j, (lengths, times, norm) in enumerate(columns):
            step = sum(t * r[n] for n, t in zip(lengths, times, strict=True)) / norm
            new = max(0.0, x[j] + step)
            if (step := new - x[j]) != 0.0:
                x[j] = new
                moved = max(moved, abs(step))
                for n, t in zip(lengths, times, strict=True):
                    r[n] -= t * step
        if moved < 0.5:
            break
    return np.array(x)


def plan(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in order, how many sequences hold just these): every piece of the histogram once."""
    left = histogram.astype(np.int64).copy()
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))  # by room left
    found = patterns(left, length)
    for p, x in sorted(zip(found, fitted(left, found), strict=True), key=lambda px: (sum(px[0]), px[1]), reverse=True):
        lengths, times = np.unique(p, return_counts=True)
        n = int(min(int(x), (left[lengths] // times).min()))
        if n > 0:
            left[lengths] -= n * times
            open_[length - sum(p)][p] += n
    rooms = np.zeros(length + 1, bool)
    rooms[[k for k in open_ if k > 0]] = True
    for size in range(length, 0, -1):
        todo = int(left[size])
        while todo:
            fits = np.flatnonzero(rooms[size:])
            if len(fits):
                room = size + int(fits[0])
                p, n = open_[room].popitem()
                if not open_[room]:
                    rooms[room] = False
                used = min(n, todo)
                if n > used:
                    open_[room][p] = n - used
                    rooms[room] = True
                done, todo = (*p, size), todo - used
            else:
                each = min(length // size, todo)
                used = todo // each
                done, todo, room = (size,) * each, todo - used * each, length - (each - 1) * size
            open_[room - size][done] += used
            rooms[room - size] = room > size
    return [(p, n) for room in sorted(open_) for p, n in sorted(open_[room].items()) if n]


def slots(planned: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length << 40 | first rank), and for each the first sequence and the offset there."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for p, n in planned:
        offset = 0
        for size in p:
            rows.append((size << 40 | used[size], sequence, offset))
            used[size] += n
            offset += size
        sequence += n
    rows.sort()
    return tuple(np.array([r[k] for r in rows], np.int64) for k in range(3))


# ---- ranks and places -----------------------------------------------------------------------


def ranked(pieces: DataFrame, sizes: DataFrame) -> DataFrame:
    """pieces with a rank from 0 within each length. A length of n pieces is numbered in about sqrt(n) parts side by side."""
    parts = pieces.join(sizes, "length").withColumn("part", F.pmod(F.xxhash64("row", "piece"), F.ceil(F.sqrt("n"))))
    counts = parts.groupBy("length", "part").agg(F.count("*").alias("in_part"))
    before = F.sum("in_part").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "row", "piece"))
    return parts.withColumn("own", own).join(starts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("own") - 1).drop("part", "n", "own", "first")


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece."""
    pieces = stored(token_pieces(docs, text, doc_id, vocabulary, length))
    sizes = stored(pieces.groupBy("length").agg(F.count("*").alias("n")))
    table = sizes.toArrow()
    histogram = np.zeros(length + 1, np.int64)
    histogram[table.column("length").to_numpy()] = table.column("n").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(slots(plan(histogram, length)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = shared.value
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, size << 40 | rank, "right") - 1
            places = [sequences[at] + rank - (keys[at] & ((1 << 40) - 1)), offsets[at]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, places)], names=[*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked(pieces, sizes).select(*kept, "rank").mapInArrow(tidied(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
