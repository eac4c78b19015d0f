"""Toxicity by a subsequence-kernel support vector machine with Nystrom landmarks.

Kernel. A unit is a word's letters, or a run of single letters that are spelled out. Two units are
compared by their subsequences of three letters, each weighted by DECAY to the power of the span it
covers, up to MAX_SPAN letters; so gaps and inserted characters weaken a match instead of losing it.
A unit's feature vector is divided by the root of its summed squared weights, and the product of
two is raised to POWER, so that chance matches fade.

Machine. Landmarks are the units of the training sentences that tell most, by the likelihood ratio
of their documents' labels, for toxic and for clean documents; the Nystrom map whitens the kernel to the
landmarks, and a linear SVM with squared hinge loss is trained on it. Labels belong to documents,
so training is multi-instance: of a toxic document the units that lean to toxic documents are
positive, and one at least; of each sentence of a clean document the most toxic unit is
negative, chosen anew after each fit. Toxic units are also shown with one, two and all gaps filled. The landmarks
and their weights, which are broadcast, have a fixed size.

A document scores by its most toxic unit, through a logistic fitted on the training documents with
the labelled rows' share of toxic ones. Spark finds the distinct units of all texts and each is scored
once; the most frequent, HEAD at most, are broadcast with their decisions, and the others are joined.

Training takes at most SAMPLE labelled rows of each label, in the order of a hash, among those of
at most SAMPLE_CHARS characters; everything else covers all rows and whole texts.

Nulls: a null or empty text has no unit and scores what the logistic gives a weight of 0. Rows with
a null label or id teach nothing; a document labelled twice is toxic if one label says so. Without
labelled rows of both kinds every score is 0. Repeated rows are scored as often as they come. Texts of
any length are scored whole; of equal decisions any unit is the highest, which changes no score. The score's column
takes a name that no column of docs has in any case.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from tideframe.llm.char_codes import symbols
from tideframe.llm.common import byte_values, fresh, held_out, learnable, sliced, stored, tidied

SAMPLE, SAMPLE_CHARS = 2000, 20_000
DECAY, MAX_SPAN, POWER = 0.7, 6, 2
#: Landmarks that tell for toxic, and for clean documents.
LANDMARKS, CLEAN_LANDMARKS = 160, 96
ROUNDS, RIDGE = 3, 1e-5
#: What the disguised forms of a toxic unit weigh together, as a share of the unit's own weight.
GAPPED_SHARE = 3.0
#: Share of toxic documents among those with a unit, shrunk, from which it counts as toxic before the first fit.
FIRST_SHARE = 0.8
_TABLE = 1 << 18
#: The symbol that opens every unit.
_START = 63
#: Units that are broadcast at most, and the bytes that one has at most; a task holds _FOLD_AT distinct ones before it hands them on.
HEAD, HEAD_BYTES, _FOLD_AT = 131_072, 64, 150_000
#: Three or more single characters with single spaces between them.
_SPELLED = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+")
_OFFSETS = [(i, j) for j in range(2, MAX_SPAN) for i in range(1, j)]


def units(text: str) -> list[bytes]:
    """The words of a text, and what its spelled-out runs say."""
    found = text.encode("utf-8", "replace").split()
    if _SPELLED.search(text):
        runs = ["".join(m.group().split()) for m in _SPELLED.finditer(text)]  # its first or last letter may be a word of its own
        found += [x.encode("utf-8", "replace") for run in runs for x in (run, run[1:], run[:-1])]
    return found


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words' letters, and the word of each; other characters are left out. Each word opens with a symbol of its own."""
    codes, lengths = symbols(words)
    owner = np.repeat(np.arange(len(words)), lengths)
    letter = (codes > 0) & (codes < 52) & (codes != 27)
    codes, owner = codes[letter], owner[letter]
    first = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else owner
    return np.insert(codes, first, _START), np.insert(owner, first, owner[first])


def _subsequences(words: list[bytes]):
    """(word, packed subsequence, weight) arrays, an offset pair at a time."""
    codes, owner = _letters(words)
    for i, j in _OFFSETS:
        if len(codes) > j:
            inside = owner[:-j] == owner[j:]
            key = (codes[:-j] << 12 | codes[i : len(codes) - j + i] << 6 | codes[j:])[inside]
            yield owner[:-j][inside], key, DECAY ** (j + 1)


class Landmarks:
    """The kernel between units and the landmarks: their normalised match to the power of POWER, which stays positive definite."""

    def __init__(self, words: list[bytes]):
        self.keys = np.unique(np.concatenate([np.zeros(1, np.int64), *(key for _, key, _ in _subsequences(words))]))
        self.at = np.full(_TABLE, -1, np.int32)
        self.at[self.keys] = np.arange(len(self.keys))
        features, norm = np.zeros((len(self.keys), len(words)), np.float32), np.zeros(len(words))
        for owner, key, weight in _subsequences(words):
            norm += np.bincount(owner, minlength=len(words)) * weight**2
            np.add.at(features, (self.at[key], owner), weight)
        features /= np.sqrt(np.maximum(norm, 1e-12)).astype(np.float32)
        row, self.landmark = np.nonzero(features)  # a key is in few landmarks; its entries lie from its start to the next one's
        self.start, self.value, self.n = np.searchsorted(row, np.arange(len(self.keys) + 1)), features[row, self.landmark], len(words)
        values, vectors = np.linalg.eigh(self.kernel(words).astype(np.float64))
        strong = values > 1e-6 * max(values.max(), 1e-12)
        self.whiten = vectors[:, strong] / np.sqrt(values[strong])

    def kernel(self, words: list[bytes]) -> np.ndarray:
        """Words by landmarks."""
        out = np.zeros((len(words), self.n), np.float32)
        for first in range(0, len(words), 500):
            part = words[first : first + 500]
            sums, norm = np.zeros(len(part) * self.n), np.zeros(len(part))
            for owner, key, weight in _subsequences(part):
                norm += np.bincount(owner, minlength=len(part)) * weight**2
                known = self.at[key] >= 0
                owners, places = owner[known], self.at[key[known]]
                for begin in range(0, len(owners), 20_000):  # long words a piece at a time
                    owner, place = owners[begin : begin + 20_000], places[begin : begin + 20_000]
                    times = self.start[place + 1] - self.start[place]
                    entry = np.repeat(self.start[place] - np.cumsum(times) + times, times) + np.arange(times.sum())
                    sums += np.bincount(np.repeat(owner, times) * self.n + self.landmark[entry], self.value[entry] * weight, len(sums))
            out[first : first + 500] = (sums.reshape(len(part), self.n) / np.sqrt(np.maximum(norm, 1e-12))[:, None]) ** POWER
        return out


def linear_svm(parts: list[np.ndarray], y: np.ndarray, cost: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights (the last is the bias) of the squared-hinge SVM over the rows of all parts, by Newton steps on the active rows, a block at a time."""
    starts = np.cumsum([0, *(len(x) for x in parts)])
    blocks = [(k, i, starts[k] + i) for k, x in enumerate(parts) for i in range(0, len(x), 5000)]
    w = np.zeros(parts[0].shape[1] + 1)
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-9
    for _ in range(30):
        squares, sums = penalty.copy(), np.zeros(len(w))
        for k, i, at in blocks:
            some = parts[k][i : i + 5000].astype(np.float64)
            some = np.hstack([some, np.ones((len(some), 1))])
            labels, costs = y[at : at + len(some)], cost[at : at + len(some)]
            active = labels * (some @ w) < 1
            some = some[active]
            weighted = some * costs[active, None]
            squares += weighted.T @ some
            sums += weighted.T @ labels[active]
        new = np.linalg.solve(squares, sums)
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float]:
    a, b = 0.0, 0.0
    z = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        h = (z * (cost * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (cost * (y - p)) - 1e-6 * np.array([a, b]))
        a, b = a + np.clip(step[0], -5, 5), b + np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def gapped(unit: bytes) -> list[list[bytes]]:
    """A unit with foreign letters, as an insult is disguised: in each inner place, in each two, and in all of them."""
    text = unit.decode("utf-8", "replace")
    places = range(1, len(text))

    def filled(at: tuple[int, ...]) -> bytes:
        return "".join((chr(97 + (7 * i + 11 * len(at) + 3 * at[0]) % 26) if i in at else "") + c for i, c in enumerate(text)).encode("utf-8")

    return [[filled((i,)) for i in places], [filled(two) for two in combinations(places, 2)], [filled(tuple(places))]]


def telling(df: list[np.ndarray], n: list[int]) -> list[int]:
    """The units that tell most for toxic, and for clean documents: the likelihood ratio of their labels' document frequencies."""

    def part(count, expected):
        return np.where(count > 0, count * np.log(np.maximum(count, 1) / np.maximum(expected, 1e-12)), 0.0)

    both = (df[0] + df[1]) / (n[0] + n[1])
    ratio = sum(part(df[k], n[k] * both) + part(n[k] - df[k], n[k] * (1 - both)) for k in (0, 1))
    sides = [np.where(df[k] * n[1 - k] > df[1 - k] * n[k], ratio, -1.0) for k in (0, 1)]
    return sorted({int(i) for k, most in ((1, LANDMARKS), (0, CLEAN_LANDMARKS)) for i in np.argsort(-sides[k], kind="stable")[:most] if sides[k][i] > 0})


class Model:
    """What scoring needs: the landmarks with their weights, and the logistic of a document's highest decision."""

    def __init__(self, landmarks: Landmarks, weights: np.ndarray, slope: float, offset: float):
        self.landmarks, self.weights, self.slope, self.offset = landmarks, weights.astype(np.float32), slope, offset

    def decision(self, words: list[bytes]) -> np.ndarray:
        """How toxic each word is; a bounded number at a time."""
        return np.concatenate([np.zeros(0), *(self.landmarks.kernel(words[i : i + 10_000]) @ self.weights for i in range(0, len(words), 10_000))])


def fit(texts: list[str], toxic: list[int], share: float | None = None) -> Model | None:
    """A model of labelled texts; share is the toxic share to calibrate to. None without both labels."""
    y = np.array(toxic)
    if not len(y) or y.min() == y.max():
        return None
    index: dict[bytes, int] = {}
    flat, starts, owners = array("i"), array("i"), array("i")  # all units in a row, each sentence's start, and its document
    for d, t in enumerate(texts):
        for sentence in _SENTENCE.split(t):
            if found := units(sentence):
                starts.append(len(flat))
                owners.append(d)
                flat.extend(index.setdefault(u, len(index)) for u in found)
    words, unit, starts, owners = list(index), np.array(flat), np.array(starts), np.array(owners)
    del index, flat
    lengths = np.diff(np.append(starts, len(unit)))
    pairs = np.unique(np.repeat(owners, lengths).astype(np.int64) * max(len(words), 1) + unit)  # each document's distinct units
    doc, held = np.divmod(pairs, max(len(words), 1))
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    df = [np.bincount(held[y[doc] == k], minlength=len(words)) for k in (0, 1)]
    n = [int((y == k).sum()) for k in (0, 1)]
    share = n[1] / len(y) if share is None else share
    g = (df[1] + 1.0) / (df[1] + df[0] * n[1] / n[0] + 2.5)  # the share of toxic documents among those with a unit, shrunk
    landmarks = Landmarks([words[i] for i in telling(df, n)] or words[:1])

    def best_of(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where each run's first highest value is."""
        if not len(begin):
            return begin
        size = np.diff(np.append(begin, len(values)))
        at = np.flatnonzero(values == np.repeat(np.maximum.reduceat(values, begin), size))
        return at[np.unique(np.repeat(np.arange(len(begin)), size)[at], return_index=True)[1]]

    whiten = landmarks.whiten.astype(np.float32)

    def mapped(some: list[bytes]) -> np.ndarray:
        out = np.zeros((len(some), whiten.shape[1]), np.float32)
        for i in range(0, len(some), 5000):
            out[i : i + 5000] = landmarks.kernel(some[i : i + 5000]) @ whiten
        return out

    toxic_pairs = y[doc] == 1
    chosen = (g[held] > FIRST_SHARE) & toxic_pairs
    best = best_of(g[held], first)
    chosen[best[y[doc[best]] == 1]] = True
    positive, times = np.unique(held[chosen], return_counts=True)
    shown = [(c, gapped(words[u])) for u, c in zip(positive.tolist(), times.tolist(), strict=True) if g[u] > 0.5 and 4 <= len(words[u]) <= 16]
    disguised = [(v, c * GAPPED_SHARE / len(levels) / len(vs)) for c, levels in shown for vs in levels for v in vs]
    x = [mapped([words[i] for i in positive]), mapped([v for v, _ in disguised])]
    clean = y[owners] == 0
    negative: Counter = Counter()
    for _ in range(ROUNDS):
        worst = unit[best_of(g[unit], starts)][clean]
        negative |= Counter(worst.tolist())
        weight = [np.array([*times, *(c for _, c in disguised)], float), np.array(list(negative.values()), float)]
        cost = np.concatenate([c / max(c.sum(), 1.0) for c in weight])
        label = np.repeat([1.0, -1.0], [len(weight[0]), len(weight[1])])
        w = linear_svm([*x, mapped([words[i] for i in negative])], label, cost)
        weights = landmarks.whiten @ w[:-1]
        g = np.concatenate([landmarks.kernel(words[i : i + 10_000]) @ weights for i in range(0, len(words), 10_000)] or [np.zeros(0)])
    highest = np.zeros(len(y))
    highest[doc[first]] = np.maximum.reduceat(g[held], first) if len(first) else 0.0
    slope, offset = _logistic(highest, y.astype(float), np.where(y == 1, share / n[1], (1 - share) / n[0]) * len(y))
    return Model(landmarks, weights, slope, offset)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic", sample: int = SAMPLE) -> Model | None:
    """A model of a bounded sample of the labelled rows outside the held-out fifth."""
    told = labels.where(learnable(F.col(doc_id)) & F.col(toxic).isNotNull()).groupBy(F.col(doc_id).alias("label_id")).agg(F.max((F.col(toxic) == 1).cast("int")).alias("y"))
    told = stored(told)
    counts = dict(told.groupBy("y").count().collect())
    order = F.xxhash64("label_id")
    # twice as many ids as rows are wanted: some have no document, or too long a one
    ids = [told.where(F.col("y") == k).orderBy(order, "label_id").limit(2 * sample) for k in (0, 1)]
    chosen = F.broadcast(stored(ids[0].union(ids[1])))  # at most 4 * sample rows of two numbers
    short = docs.where(F.length(text) <= SAMPLE_CHARS).select(F.col(doc_id).alias("label_id"), F.col(text).alias("text"))
    found = short.join(chosen, "label_id")
    rows = [r for k in (0, 1) for r in found.where(F.col("y") == k).orderBy(order, "label_id", "text").limit(sample).select("text", "y").collect()]
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return fit([r[0] for r in rows], [r[1] for r in rows], share)


def _units_of(column: pa.Array) -> Iterator[list[bytes]]:
    for text, raw in zip(column.to_pylist(), byte_values(column), strict=True):
        yield units(text) if text and _SPELLED.search(text) else (raw or b"").split()


def decided(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """unit, n, decision of the distinct units of all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["unit", "n"])
            held.clear()
            return made

        for batch in sliced(batches, 0):
            for us in _units_of(batch.column(0)):
                held.update(us)
            if len(held) > _FOLD_AT:
                yield out()
        yield out()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0, 1 << 20):
            made = shared.value.decision(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())], names=["unit", "n", "decision"])

    distinct = docs.select(F.col(text).alias("text")).mapInArrow(tidied(found), "unit binary, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(tidied(decide), "unit binary, n long, decision double")


def head_units(decisions: DataFrame) -> DataFrame:
    """unit, decision of the short units above the smallest frequency that HEAD of them reach at most, by a histogram of a few hundred steps."""
    short = decisions.where(F.length("unit") <= HEAD_BYTES).withColumn("step", F.floor(F.log2("n") * 8).cast("int"))
    least, above = 0, 0
    for step, n in sorted(short.groupBy("step").count().collect(), reverse=True):
        above += n
        if above > HEAD:
            least = step + 1
            break
    return short.where(F.col("step") >= least).select("unit", "decision")


def scored(docs: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, str]:
    """docs without its text and with a score from 0 to 1; and the score's name. The texts are read twice and never shuffled."""
    name = fresh(docs, "score")
    others = [c for c in docs.columns if c != text]
    if model is None:
        return docs.select(*others, F.lit(0.0).alias(name)), name
    decisions = stored(decided(docs, model, text))
    head = head_units(decisions).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(head.column(0).to_pylist(), head.column(1).to_pylist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in sliced(batches, 0):
            parents, rest, heads = [], [], []
            for i, us in enumerate(_units_of(batch.column(0))):
                us = set(us)
                unknown = [u for u in us if u not in known] or [b" %d" % (i % 4096)]  # nothing to join: a key that no unit has, spread over the partitions
                best = max((known[u] for u in us if u in known), default=float("-inf") if us else 0.0)
                parents.extend([i] * len(unknown))
                rest.extend(unknown)
                heads.extend([best] * len(unknown))
            rows = np.array(parents, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(rows), batch.column(2).take(rows), pa.array(rest, pa.binary()), pa.array(heads, pa.float64())], names=["row", "own", "unit", "head"])

    rows = docs.select(F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"), F.struct(*others).alias("own"))
    parts = rows.mapInArrow(tidied(run), StructType([rows.schema["row"], rows.schema["own"], StructField("unit", BinaryType()), StructField("head", DoubleType())]))
    joined = parts.join(decisions.select("unit", "decision"), "unit", "left")
    best = joined.groupBy("row", "own").agg(F.max(F.greatest("head", "decision")).alias("best"))
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("best") * model.slope + model.offset))
    return best.select(*(F.col("own")[c].alias(c) for c in others), (1 / (1 + F.exp(-z))).alias(name)), name


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out, score = scored(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.5).cast("int").alias("predicted"))
