"""Near-duplicates by BagMinHash signatures of shingle multisets.

A text is the multiset of its five-word shingles; a text of fewer words is one shingle. Texts with
the same words are one class, and only classes are compared.

Signature. The weight axis of a shingle is cut into [0,1), [1,2), [2,4), [4,8) ... Each interval
has a Poisson process of its own, seeded by shingle and interval, whose rate is its length; every
point has an arrival time, a register, and a weight coordinate. A text sees the points whose
coordinate is below the shingle's count, so intervals above the count are never opened. A register
keeps the earliest point it sees, so two texts agree in it with a probability of their weighted
Jaccard similarity. Points are made in order of arrival and a shingle stops once it is later than
all registers of its text.

Candidates. BANDS bands of ROWS registers: a pair at the threshold meets in none with a probability
below 4e-5. A bucket's members are paired with one pivot, not with each other; verified pairs are
contracted into components, then a second pivot is tried where a bucket still has several. One
minus the similarity is a metric, so members near the pivot cannot be linked with those beyond its
ring (similarity below 2 * threshold - 1). What remains of different components in an open bucket, be it the
only one of a member, is compared pair by pair, in blocks: signatures first, which drop a pair at the threshold
with a probability below 1e-5, then exactly, for members that have a candidate left. So a pair exactly at the
threshold is missed with a probability below 5e-5 in all. Pairs never become rows; each group of blocks gives a spanning forest of the links that it
has found. A member of a bucket of n rows goes to n / BLOCK groups with its signature of 260 bytes, with its
shingles only where it has a candidate.

Verification is exact: the overlap of both multisets of shingle occurrences over their union.

Nulls: null texts are in no class, link with nothing and are kept; texts without words are one
class. A group keeps its row with the smallest id (null last; of rows with one text and id, any one, also
where their other columns differ). Texts of any length are whole. Columns of docs may have any names; the
helpers' own take names that are free. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.common import byte_values, fresh, sliced, stored, tidied, with_arrow_columns
from tideframe.llm.components import connected

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 26, 5
#: Rows of a block of a large bucket, and how far below the threshold an estimate may lie.
BLOCK, ESTIMATE_SPREADS = 512, 5.0
_REGISTERS = BANDS * ROWS
_REMEMBER = 200_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(bits: np.ndarray) -> np.ndarray:
    return ((bits >> _U(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


class Shingler:
    """Hashes of the shingles of texts; a bounded number of words is remembered with its hash."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def shingles(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """All shingles of the texts, text by text, and how many each text has."""
        new = {w for words in texts for w in words if w not in self.known}
        extra = {w: xxhash.xxh3_64_intdigest(w) for w in new}
        if len(self.known) < _REMEMBER:
            self.known.update(extra)
            look = self.known
        else:
            look = self.known | extra
        sizes = np.array([len(words) for words in texts], np.int64)
        ids = np.fromiter((look[w] for words in texts for w in words), _U, int(sizes.sum()))
        if not len(ids):
            return np.zeros(0, _U), np.zeros(len(texts), np.int64)
        counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
        starts = np.cumsum(sizes) - sizes
        first = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        width = np.repeat(np.minimum(sizes, SHINGLE), counts)
        key = np.zeros(len(first), _U)
        for k in range(SHINGLE):
            here = ids[np.minimum(first + k, len(ids) - 1)]
            key = np.where(k < width, _mix(key * _U(0x9E3779B97F4A7C15) + here + _U(1)), key)
        return key, counts


def signatures(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The registers of each text: arrival times of the earliest points, which are equal just where the points are the same."""
    texts = len(counts)
    owner = np.repeat(np.arange(texts), counts)
    pair = _mix(shingles + owner.astype(_U) * _U(0xD1342543DE82EF95))
    _, at, weight = np.unique(pair, return_index=True, return_counts=True)
    owner, shingle = owner[at], shingles[at]
    # one process for each interval that the weight reaches into: level 0 is [0, 1), level k is [2**(k-1), 2**k)
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, shingle, weight = (np.repeat(x, levels) for x in (owner, shingle, weight))
    base = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.where(level > 0, base, 1.0)
    seed = _mix(shingle ^ _mix(level.astype(_U) + _U(0x5851F42D4C957F2D)))
    registers = np.full(texts * _REGISTERS, np.inf)
    latest = np.full(texts, np.inf)
    time = np.zeros(len(owner))
    k = 0
    while len(owner):
        bits = _mix(seed + _U((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log(_unit(bits)) / length
        alive = time < latest[owner]
        owner, seed, length, base, weight, time = (x[alive] for x in (owner, seed, length, base, weight, time))
        bits = _mix(seed + _U((2 * k + 2) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        register = (bits >> _U(40)).astype(np.int64) % _REGISTERS
        seen = base + length * ((bits & _U((1 << 40) - 1)).astype(np.float64) / (1 << 40)) < weight
        np.minimum.at(registers, owner[seen] * _REGISTERS + register[seen], time[seen])
        latest = registers.reshape(texts, _REGISTERS).max(axis=1)
        k += 1
    return registers.reshape(texts, _REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each text."""
    bits = np.ascontiguousarray(registers).view(_U).reshape(len(registers), BANDS, ROWS)
    key = np.broadcast_to(_mix(np.arange(1, BANDS + 1, dtype=_U)), bits.shape[:2])
    for r in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + bits[:, :, r])
    return key.view(np.int64)


def register_marks(registers: np.ndarray) -> np.ndarray:
    """Sixteen bits of each register, by which signatures are compared."""
    return (_mix(np.ascontiguousarray(registers).view(_U)) >> _U(48)).astype(np.uint16)


def occurrences(shingles: np.ndarray) -> np.ndarray:
    """A multiset of shingles as a sorted set: the i-th occurrence of a shingle is an element of its own."""
    ordered = np.sort(shingles)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
    nth = np.arange(len(ordered)) - np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    return np.sort(_mix(ordered + nth.astype(_U) * _U(0xD1342543DE82EF95)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets given as occurrences; two empty ones are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int((a[at] == b).sum())
    return both / (len(a) + len(b) - both)


def _split(column: pa.Array) -> list[list[bytes]]:
    return [v.split() if v else [] for v in byte_values(column)]


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def with_class(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """docs with a digest of its words, which texts with the same words share; null for a null text."""
    name = fresh(docs, "class")

    def make():
        return lambda column: [[v if v is None else _digest(v.split()) for v in byte_values(column)]]

    return with_arrow_columns(docs, [text], [pa.field(name, pa.binary())], make), name


def class_bands(docs: DataFrame, text: str) -> DataFrame:
    """class, bands, marks: one row for each class and task, of texts that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, done = Shingler(), set()
        for batch in sliced(batches, 0):
            fresh_texts = {}
            for words in _split(batch.column(0)):
                if words and (d := _digest(words)) not in done:
                    done.add(d)
                    fresh_texts[d] = words
            if fresh_texts:
                registers = signatures(*shingler.shingles(list(fresh_texts.values())))
                keys = band_keys(registers)
                marks = [x.tobytes() for x in register_marks(registers)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(fresh_texts, pa.binary()), lists, pa.array(marks, pa.binary())], names=["class", "bands", "marks"])

    return docs.select(F.col(text).alias("text")).mapInArrow(tidied(run), "class binary, bands array<long>, marks binary")


def class_texts(docs: DataFrame, text: str) -> DataFrame:
    """class, text: one row for each class and task, of texts that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in sliced(batches, 0):
            digests = [_digest(words) if words else None for words in _split(batch.column(0))]
            new = [i for i, d in enumerate(digests) if d is not None and d not in done and not done.add(d)]
            yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in new], pa.binary()), batch.column(0).take(pa.array(new, pa.int64()))], names=["class", "text"])

    return docs.select(F.col(text).alias("text")).mapInArrow(tidied(run), "class binary, text string")


def class_shingles(texts: DataFrame) -> DataFrame:
    """class, shingles (occurrences) of class texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in sliced(batches, 1):
            keys, counts = shingler.shingles(_split(batch.column(1)))
            sets = [occurrences(x).tobytes() for x in np.split(keys, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["class", "shingles"])

    return texts.select("class", "text").mapInArrow(tidied(run), "class binary, shingles binary")


def verified(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (c.to_pylist() for c in batch.columns)
            found = np.array([similarity(np.frombuffer(x, _U), np.frombuffer(y, _U)) for x, y in zip(left, right, strict=True)])
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["a", "b", "similarity"])
            yield out.filter(pa.array(found >= threshold))

    left = shingles.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    right = shingles.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    # what cannot reach the threshold by its sizes alone
    n, m = F.length("left"), F.length("right")
    return full.where(F.least(n, m) >= threshold * F.greatest(n, m)).mapInArrow(tidied(run), "a binary, b binary, similarity double")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def linked_classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """class, component: for each class that is linked with another, the smallest class that it is connected with."""
    bands = stored(class_bands(docs, text).groupBy("class").agg(F.any_value("bands").alias("bands"), F.any_value("marks").alias("marks")))
    rows = bands.select("class", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    rows = stored(rows.join(shared, "key"))
    involved = rows.select("class").distinct()
    shingles = stored(class_shingles(class_texts(docs, text).join(involved, "class").dropDuplicates(["class"])))

    # a pivot for each bucket; how similar its members are to it tells which of them can be linked at all
    ring = 2 * threshold - 1
    stars = rows.join(pivots(rows, 0), "key").where("class != pivot")
    near = stored(verified(stars.select(*_ordered("class", "pivot")).distinct(), shingles, ring))
    edges = near.where(F.col("similarity") >= threshold).select("a", "b")
    components = connected(edges).withColumnRenamed("node", "class")

    # a second pivot for what a bucket's first has not connected
    members = in_components(rows, components)
    open_ = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low != high and n > 2")
    members = members.join(open_.select("key"), "key")
    second = members.join(pivots(members, 1), "key").where("class != pivot").select(*_ordered("class", "pivot")).distinct()
    second = second.join(near, ["a", "b"], "left_anti")
    edges = edges.union(stored(verified(second, shingles, threshold)).select("a", "b"))
    components = connected(edges).withColumnRenamed("node", "class")

    # distance is a metric: members near the pivot are linked with each other or with its ring, not with what is beyond
    told = near.select(F.col("a").alias("class"), F.col("b").alias("pivot"), "similarity").union(near.select("b", "a", "similarity"))
    placed = rows.join(pivots(rows, 0), "key").join(told, ["class", "pivot"], "left")
    placed = placed.withColumn("similarity", F.when(F.col("class") == F.col("pivot"), 1.0).otherwise(F.coalesce("similarity", F.lit(0.0))))
    placed = stored(in_components(placed.select("band", "key", "class", "similarity"), components))
    ringed = placed.groupBy("key").agg(F.count_if((F.col("similarity") < threshold) & (F.col("similarity") >= ring)).alias("in_ring"))
    active = placed.join(ringed, "key").where((F.col("similarity") < threshold) | (F.col("in_ring") > 0)).select("band", "key", "class", "component")
    open_ = active.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
    active = active.join(open_, "key")
    # each pair of different components is compared where it first meets, also if that is the only open bucket of either
    active = stored(active)
    sizes = active.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = active.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("class", "band"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("group", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    dealt = stored(dealt.join(bands.select("class", "marks"), "class").select("group", "band", "own", "other", "class", "component", "marks"))
    # by signatures alone first: shingles go only to members that have a candidate left
    compared = dealt.join(surviving(dealt, threshold), ["group", "class"]).join(shingles, "class")
    rest = stored(linked_in_blocks(compared, threshold))
    return components if rest.isEmpty() else connected(edges.union(rest)).withColumnRenamed("node", "class")


def candidate_pairs(group: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of members of different components whose signatures agree enough, each pair in the group where it first meets.

    A pair that is ESTIMATE_SPREADS deviations below the threshold by its signatures is left out.
    """
    least = threshold - ESTIMATE_SPREADS * (threshold * (1 - threshold) / _REGISTERS) ** 0.5
    n, band = group.num_rows, group.column("band")[0].as_py()
    own, other = (group.column(c).to_numpy() for c in ("own", "other"))
    component = group.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
    marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint16).reshape(n, _REGISTERS)
    for start in range(0, n, 32):
        rows = np.arange(start, min(start + 32, n))
        equal = marks[rows, None, :] == marks[None, start:, :]
        good = equal.mean(axis=2) >= least
        good &= ((own[rows, None] != own[None, start:]) | (own[rows, None] == other[rows, None])) & (component[rows, None] != component[None, start:])
        x, y = np.nonzero(good)
        later = y > x
        x, y = x[later], y[later]
        if len(x):
            first = equal[x, y].reshape(len(x), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
            yield x[first] + start, y[first] + start


def surviving(dealt: DataFrame, threshold: float) -> DataFrame:
    """group, class: the members of groups of blocks that have a candidate there."""

    def find(group: pa.Table) -> pa.Table:
        places = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.concatenate(pair) for pair in candidate_pairs(group, threshold))]))
        return group.select(["group", "class"]).take(pa.array(places))

    return dealt.groupBy("group").applyInArrow(find, "group long, class binary")


def linked_in_blocks(dealt: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between different components inside groups of at most two blocks; a spanning forest of them.

    dealt: group, band, own, other (blocks), class, component, marks, shingles. Candidates are compared exactly.
    """

    def compare(group: pa.Table) -> pa.Table:
        names, components = (group.column(c).to_pylist() for c in ("class", "component"))
        sets = [np.frombuffer(x, _U) for x in group.column("shingles").to_pylist()]
        tree, firsts = [0] * len(names), {}
        for i, c in enumerate(components):
            tree[i] = firsts.setdefault(c, i)  # members of one component are connected already

        def find(i: int) -> int:
            while tree[i] != i:
                tree[i] = tree[tree[i]]
                i = tree[i]
            return i

        found = []
        for x, y in candidate_pairs(group, threshold):
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                if find(i) != find(j) and similarity(sets[i], sets[j]) >= threshold:
                    tree[find(i)] = find(j)
                    found.append((names[i], names[j]))
        return pa.table([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"])

    return dealt.select("group", "band", "own", "other", "class", "component", "marks", "shingles").groupBy("group").applyInArrow(compare, "a binary, b binary")


def pivots(members: DataFrame, turn: int) -> DataFrame:
    """key, pivot: one member of each bucket, the same in every bucket that holds it first in the turn's order."""
    return members.groupBy("key").agg(F.min_by("class", F.xxhash64("class", F.lit(turn))).alias("pivot"))


def in_components(members: DataFrame, components: DataFrame) -> DataFrame:
    """members with their component, a class of its own where none is known."""
    return members.join(components, "class", "left").withColumn("component", F.coalesce("component", "class"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, component_id, kept: one row for each row of docs.

    class_id is the smallest id with the same words, component_id the smallest id of the group; of
    each group one row is kept.
    """
    slim, name = with_class(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    slim = stored(slim.select("doc_id", F.col(name).alias("class"), F.monotonically_increasing_id().alias("row")))
    components = linked_classes(docs, text, threshold)
    first = F.struct(F.isnull("doc_id").alias("unknown"), F.col("doc_id"), F.col("row"))
    classes = slim.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(first).alias("first"))
    classes = stored(classes.join(components, "class", "left").withColumn("component", F.coalesce("component", "class")))
    groups = classes.groupBy("component").agg(F.min("first").alias("group_first"))
    table = classes.join(groups, "component").select("class", "first", "group_first")
    some = slim.where(F.col("class").isNotNull()).join(table, "class")
    some = some.select("doc_id", F.col("first.doc_id").alias("class_id"), F.col("group_first.doc_id").alias("component_id"), (F.col("row") == F.col("group_first.row")).alias("kept"))
    none = slim.where(F.col("class").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return some.union(none)


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group of near-duplicates, with all columns; texts are shuffled once, to meet the rows to keep."""
    rows, name = with_class(docs, text)
    slim = stored(rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(F.struct(F.isnull(doc_id).alias("unknown"), F.col(doc_id).alias("id"))).alias("first")))
    slim = slim.select(F.col(name).alias("class"), "first")
    components = linked_classes(docs, text, threshold)
    whole = slim.join(components, "class", "left").withColumn("component", F.coalesce("component", "class"))
    keep = stored(whole.groupBy("component").agg(F.min(F.struct("first", "class")).alias("k")).select(F.col("k.class").alias("class"), F.col("k.first.id").alias("id")))
    keep = keep.withColumnsRenamed({"class": fresh(rows, "keep_class"), "id": fresh(rows, "keep_id")})
    kept = rows.where(F.col(name).isNotNull()).join(keep, (F.col(name) == keep[keep.columns[0]]) & F.col(doc_id).eqNullSafe(keep[keep.columns[1]])).drop(*keep.columns)
    once = kept.dropDuplicates([name, doc_id])
    return once.drop(name).union(docs.where(F.col(text).isNull()))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
