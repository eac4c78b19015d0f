"""Approximate nearest neighbours: a neighbour graph by NN-descent as Spark joins, searched greedily.

Nearness is the largest inner product. For the graph each vector x becomes (x, sqrt(M^2 - |x|^2)) / M, with M the largest
norm, so that all lie on a sphere and the nearest of (q, 0) there is the one with the largest inner product with q.
Equal vectors are one node.

Graph. A node starts with the nearest of those that share one of its PLACES nearest pivots, of at most PIVOTS sampled
ones; a pivot's group is cut at random into blocks of about BLOCK. Then rounds of descent: each node's list and up to REVERSE nodes that list it
are brought together, all their pairs are scored in the task, and each gets the others that are nearer than the last of its list.
Lists keep their DEGREE nearest. Rounds end when fewer than SETTLED of all entries are new. A list is an approximation; every node has one, whatever its group.

Search. A query enters at its best nodes of a sample, and at the node of its own vector if that is indexed. Each step opens its
nearest unopened nodes, joins them with their lists (and those that list them, up to REVERSE), scores what is new where the candidates are, and keeps
the BEAM best. It ends when all steps of OPENED are done or nothing is left to open. The best RERANK nodes are scored again in double
precision on the original vectors, and stand for all their equal vectors.

Nothing is brought together whole: the pivots and entries are a bounded sample that is broadcast, joins are by node,
groups are of bounded size, and only counts reach the driver.

Nulls: vectors that are null, empty, zero or hold null or non-finite components take no part, as query or candidate. Only
vectors of one dimension meet. Equal scores go by the smaller vec_id. Of repeated rows each is a candidate and each query row has its own result; of
rows with the query's own id one is left out. A null id is a candidate that comes first among ties. Other columns are not looked at, so their names may be
any. An empty table gives an empty result; where there are fewer candidates, all are given.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.llm.common import stored, tidied

TOP, DEGREE, REVERSE = 20, 24, 16
PIVOTS, PLACES, BLOCK = 4096, 12, 1024
SETTLED, MOST_ROUNDS = 0.05, 12
ENTRIES, BEAM, RERANK = 8, 128, 48
#: How many nodes each step of a search opens.
OPENED = (24, 32, 40, 40)
LIST = "node long, ids array<long>, scores array<float>, fresh array<boolean>"


class Index(NamedTuple):
    """nodes: node, digest, dim, code, embedding; graph: node, ids (its list and who lists it); members: node, vec_id (the smallest few)."""

    nodes: DataFrame
    graph: DataFrame
    members: DataFrame
    entries: dict[int, tuple[np.ndarray, np.ndarray]]


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by a key, put together so that rows of one key are never apart."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        other = np.flatnonzero(values != values[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if not cut and kept and kept[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(kept)
            kept = []
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = [batch.slice(cut)]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def _encoded(x: np.ndarray) -> pa.Array:
    """Rows of unit size as half floats."""
    return pa.array([r.tobytes() for r in x.astype("<f2")], pa.binary())


def _decoded(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Codes of one dimension as rows of floats."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), "<f2").reshape(len(column), -1).astype(np.float32)


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows of doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield batch.filter(pa.array(dims == dim))


def _lists(owner: np.ndarray, ids: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Sorted owners with arrays of what each has."""
    names, starts = np.unique(owner, return_index=True)
    offsets = pa.array(np.append(starts, len(owner)).astype(np.int32))
    return names, [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (ids, *values)]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, dim, digest, embedding of the rows that take part; equal vectors have equal digests."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.where(fine).withColumn("dim", F.size("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_dim(batches):
            digests = [xxhash.xxh3_128_digest((r + 0.0).tobytes()) for r in _rows(batch.column("embedding"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=[*batch.schema.names, "digest"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(tidied(run), f"{kinds}, digest binary")


def _coded(rows: DataFrame, largest: float | None) -> DataFrame:
    """rows with code: on the sphere of vectors no longer than largest, or, for queries (None), their direction and a last 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_dim(batches):
            x = _rows(batch.column("embedding"))
            if largest is None:
                x = x / np.abs(x).max(axis=1)[:, None]
                x = np.column_stack([x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros(len(x))])
            else:
                x = x / largest
                x = np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))])
            yield pa.RecordBatch.from_arrays([*batch.columns, _encoded(x)], names=[*batch.schema.names, "code"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(tidied(run), f"{kinds}, code binary")


def _norm() -> Column:
    return F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def merged(edges: DataFrame, degree: int = DEGREE) -> DataFrame:
    """The lists of nodes: of all that edges (node, ids, scores, fresh) give a node, the nearest few, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_runs(batches, "node"):
            group = group.combine_chunks()
            lengths = np.asarray(pc.list_value_length(group.column("ids").combine_chunks()))
            owner = np.repeat(group.column("node").to_numpy(), lengths)
            ids, scores, fresh = (np.asarray(group.column(c).combine_chunks().flatten()) for c in ("ids", "scores", "fresh"))
            order = np.lexsort((-scores, fresh, ids, owner))
            owner, ids, scores, fresh = owner[order], ids[order], scores[order], fresh[order]
            first = np.append(True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])) if len(owner) else np.zeros(0, bool)
            owner, ids, scores, fresh = owner[first], ids[first], scores[first], fresh[first]
            order = np.lexsort((ids, -scores, owner))
            owner, ids, scores, fresh = owner[order], ids[order], scores[order], fresh[order]
            near = np.arange(len(owner)) - np.searchsorted(owner, owner, "left") < degree
            names, columns = _lists(owner[near], ids[near], scores[near], fresh[near])
            yield pa.RecordBatch.from_arrays([pa.array(names), *columns], names=["node", "ids", "scores", "fresh"])

    return edges.repartition("node").sortWithinPartitions("node").mapInArrow(tidied(run), LIST)


def _nearest(names: np.ndarray, x: np.ndarray, degree: int) -> pa.RecordBatch | None:
    """The lists of nodes that are compared with each other."""
    n = len(names)
    if n < 2:
        return None
    k = min(degree, n - 1)
    scores = x @ x.T
    np.fill_diagonal(scores, -2)
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    _, columns = _lists(np.repeat(np.arange(n), k), names[best].ravel(), np.take_along_axis(scores, best, 1).ravel(), np.ones(n * k, bool))
    return pa.RecordBatch.from_arrays([pa.array(names), *columns], names=["node", "ids", "scores", "fresh"])


def first_lists(nodes: DataFrame, pivots: dict[int, np.ndarray], places: int = PLACES, block: int = BLOCK, degree: int = DEGREE) -> DataFrame:
    """Lists from the groups of pivots: nodes of a dimension without a pivot are one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_dim(batches):
            known = pivots.get(batch.column("dim")[0].as_py())
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                if known is None:
                    own = np.zeros((piece.num_rows, 1), np.int64)
                else:
                    k = min(places, len(known))
                    own = np.argpartition(-(_decoded(piece.column("code")) @ known.T), k - 1, axis=1)[:, :k].astype(np.int64)
                offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * own.shape[1])
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.ListArray.from_arrays(offsets, pa.array(own.ravel()))], names=["node", "dim", "code", "pivots"])

    dealt = stored(nodes.select("node", "dim", "code").mapInArrow(tidied(run), "node long, dim int, code binary, pivots array<long>"))
    each = dealt.select("node", "dim", "code", F.explode("pivots").alias("pivot"))
    sizes = each.groupBy("dim", "pivot").agg(F.ceil(F.count("*") / (1.5 * block)).cast("int").alias("blocks")).where("blocks > 1")
    each = each.join(F.broadcast(stored(sizes)), ["dim", "pivot"], "left")  # as many rows as pivots and dimensions without one
    each = each.withColumn("block", F.pmod(F.xxhash64("node", "pivot"), F.coalesce("blocks", F.lit(1))))

    def compare(group: pa.Table) -> pa.Table:
        found = _nearest(group.column("node").to_numpy(), _decoded(group.column("code")), degree)
        return pa.Table.from_batches([found]) if found else pa.table({"node": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "scores": pa.array([], pa.list_(pa.float32())), "fresh": pa.array([], pa.list_(pa.bool_()))})

    return merged(each.select("dim", "pivot", "block", "node", "code").groupBy("dim", "pivot", "block").applyInArrow(compare, LIST), degree)


def with_reverse(lists: DataFrame, most: int = REVERSE) -> DataFrame:
    """node, ids: each list and up to so many nodes that list the node, chosen at random; ranks are cut before they are shuffled."""
    edges = lists.select(F.col("node").alias("other"), F.explode("ids").alias("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("node", "other"), "other"))
    reverse = edges.withColumn("place", place).where(F.col("place") <= most).groupBy("node").agg(F.collect_list("other").alias("others"))
    return lists.select("node", "ids").join(reverse, "node", "left").select("node", F.array_union("ids", F.coalesce("others", F.array().cast("array<long>"))).alias("ids"))


def descended(nodes: DataFrame, lists: DataFrame, degree: int = DEGREE) -> DataFrame:
    """One round of descent: neighbours of a node are told of each other."""
    around = with_reverse(lists).select(F.col("node").alias("at"), F.explode("ids").alias("node"))
    full = F.size("ids") >= degree
    worst = lists.select("node", F.when(full, F.array_min("scores")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    gathered = around.join(nodes.select("node", "code").join(worst, "node").hint("shuffle_hash"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "at"):
            table = table.combine_chunks()
            at, names, worst = (table.column(c).to_numpy() for c in ("at", "node", "worst"))
            codes = table.column("code").combine_chunks()
            starts = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
            owners, ids, scores = [], [], []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                x = _decoded(codes.slice(a, b - a))
                s = x @ x.T
                np.fill_diagonal(s, -3)
                i, j = np.nonzero(s > worst[a:b, None])
                owners.append(names[a + i])
                ids.append(names[a + j])
                scores.append(s[i, j])
            owner, other, score = np.concatenate(owners), np.concatenate(ids), np.concatenate(scores)
            order = np.argsort(owner, kind="stable")
            names, columns = _lists(owner[order], other[order], score[order], np.ones(len(order), bool))
            yield pa.RecordBatch.from_arrays([pa.array(names), *columns], names=["node", "ids", "scores", "fresh"])

    told = gathered.repartition("at").sortWithinPartitions("at").mapInArrow(tidied(run), LIST)
    old = lists.withColumn("fresh", F.transform("ids", lambda _: F.lit(False)))
    return merged(told.unionByName(old), degree)


def settled(lists: DataFrame) -> float:
    """The share of entries that the last round brought."""
    told = lists.agg(F.sum(F.size(F.filter("fresh", lambda f: f))).alias("new"), F.sum(F.size("ids")).alias("all")).first()
    return (told["new"] or 0) / max(told["all"] or 0, 1)


def build(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", top: int = TOP, degree: int = DEGREE) -> Index:
    """The graph over all usable rows."""
    rows = stored(usable(vectors, vec_id, embedding))
    distinct = rows.groupBy("dim", "digest").agg(F.any_value("embedding").alias("embedding"))
    largest = rows.agg(F.max(_norm())).first()[0]
    coded = _coded(distinct.select("dim", "digest", "embedding"), (largest or 1.0) * (1 + 1e-9))
    nodes = stored(coded.withColumn("node", F.monotonically_increasing_id()))
    # the smallest ids of each node, one more than are wanted as the query's own may be among them
    place = F.row_number().over(Window.partitionBy("dim", "digest").orderBy(F.asc_nulls_first("vec_id")))
    fewest = rows.select("dim", "digest", "vec_id").withColumn("place", place).where(F.col("place") <= top + 1)
    members = stored(fewest.join(nodes.select("dim", "digest", "node"), ["dim", "digest"]).select("node", "vec_id"))

    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(PIVOTS).collect()}
    sample: dict[int, list] = {}
    for r in nodes.select("dim", "node", "code").orderBy(F.xxhash64("node", F.lit(7)), "node").limit(PIVOTS).collect():
        sample.setdefault(r["dim"], []).append((r["node"], np.frombuffer(r["code"], "<f2").astype(np.float32)))
    entries = {dim: (np.array([n for n, _ in found]), np.stack([x for _, x in found])) for dim, found in sample.items()}
    wanted = lambda dim: 1 if sizes.get(dim, 0) <= 2 * BLOCK else sizes[dim] * PLACES // BLOCK
    pivots = {dim: x[: wanted(dim)] for dim, (_, x) in entries.items()}
    lists = stored(first_lists(nodes, pivots, degree=degree))
    for _ in range(MOST_ROUNDS):
        lists = stored(descended(nodes, lists, degree))
        if settled(lists) < SETTLED:
            break
    return Index(nodes, stored(with_reverse(lists)), members, entries)


def _entered(queries: DataFrame, entries: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """q, ids, scores: where each query enters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_dim(batches):
            names, known = entries.get(batch.column("dim")[0].as_py(), (np.zeros(0, np.int64), None))
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                k = min(ENTRIES, len(names))
                best = np.zeros((piece.num_rows, 0), np.int64)
                if k:
                    best = np.argpartition(-(_decoded(piece.column("code")) @ known.T), k - 1, axis=1)[:, :k]
                offsets = pa.array(np.arange(len(best) + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays([piece.column("q"), pa.ListArray.from_arrays(offsets, pa.array(names[best].ravel()))], names=["q", "ids"])

    return queries.select("q", "dim", "code").mapInArrow(tidied(run), "q long, ids array<long>")


BEAM_KIND = "q long, ids array<long>, scores array<float>, done array<boolean>"


def _kept(beams: DataFrame, found: DataFrame, beam: int) -> DataFrame:
    """Beams with newly scored candidates (q, id, score) in them, the best few of each query, best first; a node that is in both stays as it was."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_runs(batches, "q"):
            owner, ids, scores, done = (group.column(c).to_numpy() for c in ("q", "id", "score", "done"))
            order = np.lexsort((~done, ids, owner))
            owner, ids, scores, done = owner[order], ids[order], scores[order], done[order]
            first = np.append(True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1]))
            owner, ids, scores, done = owner[first], ids[first], scores[first], done[first]
            order = np.lexsort((ids, -scores, owner))
            owner, ids, scores, done = owner[order], ids[order], scores[order], done[order]
            best = np.arange(len(owner)) - np.searchsorted(owner, owner, "left") < beam
            names, columns = _lists(owner[best], ids[best], scores[best], done[best])
            yield pa.RecordBatch.from_arrays([pa.array(names), *columns], names=["q", "ids", "scores", "done"])

    held = beams.select("q", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"), F.col("done").alias("done"))))
    both = held.unionByName(found.withColumn("done", F.lit(False)))
    return both.repartition("q").sortWithinPartitions("q").mapInArrow(tidied(run), BEAM_KIND)


def _scored(asked: DataFrame, queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """asked (q, ids) as q, id, score: each candidate scored where its code is."""
    pairs = asked.join(queries.select("q", F.col("code").alias("query")), "q").select("q", "query", F.explode("ids").alias("node"))
    pairs = pairs.join(nodes.select("node", "dim", "code").hint("shuffle_hash"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_dim(batches):
            scores = np.einsum("ij,ij->i", _decoded(batch.column("query")), _decoded(batch.column("code")))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(scores)], names=["q", "id", "score"])

    return pairs.mapInArrow(tidied(run), "q long, id long, score float")


def search(index: Index, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", top: int = TOP, opened: tuple[int, ...] = OPENED, beam: int = BEAM, own: bool = True) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest indexed rows of each query row; own: a row with the query's own id is itself and left out."""
    rows = stored(usable(queries, vec_id, embedding).select(F.col("vec_id").alias("query_id"), "dim", "digest", "embedding"))
    alike = rows.groupBy("dim", "digest").agg(F.any_value("embedding").alias("embedding"))
    asked = stored(_coded(alike, None).withColumn("q", F.monotonically_increasing_id()))
    here = asked.join(index.nodes.select("dim", "digest", "node"), ["dim", "digest"]).select("q", F.array("node").alias("ids"))
    entered = _entered(asked, index.entries).unionByName(here).groupBy("q").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
    beams = stored(_kept(asked.sparkSession.createDataFrame([], BEAM_KIND), _scored(entered, asked, index.nodes), beam))
    for most in opened:
        # beams are sorted: the first few that are not done are opened
        waiting = F.filter(F.arrays_zip("ids", "done"), lambda x: ~x["done"])
        opening = F.transform(F.slice(waiting, 1, most), lambda x: x["ids"])
        beams = beams.withColumn("opening", opening).withColumn("done", F.zip_with("ids", "done", lambda i, d: d | F.array_contains("opening", i)))
        frontier = beams.select("q", F.explode("opening").alias("node"))
        near = frontier.join(index.graph, "node").groupBy("q").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("near"))
        fresh = near.join(beams.select("q", "ids"), "q").select("q", F.array_except("near", "ids").alias("ids"))
        beams = stored(_kept(beams.drop("opening"), _scored(fresh, asked, index.nodes), beam))

    best = beams.select("q", F.explode(F.slice("ids", 1, RERANK)).alias("node")).join(asked.select("q", F.col("embedding").alias("query")), "q")
    product = F.aggregate(F.zip_with("query", "embedding", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    exact = best.join(index.nodes.select("node", "embedding"), "node").select("q", "node", product.alias("score"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "score")))
    answers = exact.join(index.members, "node").groupBy("q").agg(ranked.alias("found"))
    answers = stored(answers.join(asked.select("q", "dim", "digest"), "q").select("dim", "digest", F.slice("found", 1, 2 * top + 1).alias("found")))
    told = rows.select("query_id", "dim", "digest").join(answers, ["dim", "digest"])
    at = F.coalesce(F.array_position(F.transform("found", lambda x: x["vec_id"]), F.col("query_id")), F.lit(0)) if own else F.lit(0)
    rest = F.filter("found", lambda x, i: (F.col("at") == 0) | (i != F.col("at") - 1))
    told = told.withColumn("at", at).select("query_id", F.posexplode(F.slice(rest, 1, top)).alias("place", "hit"))
    return told.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(build(vectors), vectors.where(F.col("vec_id") % 20 == 0))
