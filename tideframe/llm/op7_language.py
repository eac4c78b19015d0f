"""Language identification: multinomial naive Bayes over hashed character n-grams.

Spark counts, for each language, every n-gram of one to MAX_N characters inside every word of
every learning row. The log-probability matrix has BUCKETS rows and a column for each language;
languages are a closed set of labels, so its size is bounded, and more than MAX_LANGUAGES labels
are refused with an error, never left out. A batch is scored in numpy: distinct words first, then the sum over a text's words.

Nulls: a null text, and a text without a letter, is `und` with score 0; rows with a null language
or id teach nothing. Without any learning row every text is `und`. A tie takes the language that
sorts first. Repeated rows count as often as they come. Texts of any length are whole. New columns
take names that no column of docs has in any case. An empty table teaches nothing and gives no row.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.char_codes import code_points
from tideframe.llm.common import broadcast_if_small, byte_values, content_key, fresh, held_out, learnable, sliced, stored, tidied, with_arrow_columns, without

BUCKETS, MAX_N, MAX_LANGUAGES = 1 << 15, 3, 512
SMOOTHING = 0.5
#: How far below its language's median a document's n-grams may be: robust deviations of a mean of so many, and a margin.
SPREADS, MARGIN = 6.0, 0.25
#: Distinct words of all languages that a task holds before it folds them, so many at a time, and languages whose counts it holds.
_FOLD_AT, _AT_ONCE, _LABELS_HELD = 150_000, 5_000, 64
#: Words remembered with their scores by a task, and the bytes of those scores.
_REMEMBER, _REMEMBER_BYTES = 200_000, 16 << 20


def _lower_table() -> np.ndarray:
    return np.array([ord(chr(cp).lower()[0]) for cp in range(0x3000)], dtype=np.uint32)


def _features(words: list[bytes], lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and the word that each belongs to."""
    points, lengths = code_points(words)
    points = np.where(points < len(lower), lower[np.minimum(points, len(lower) - 1)], points).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    buckets, owners = [], []
    key, valid = np.zeros(len(points), np.uint64), np.ones(len(points), bool)
    for n in range(1, MAX_N + 1):
        here = np.zeros_like(points)
        here[: len(points) - n + 1] = points[n - 1 :]
        key = (key + here + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        valid &= np.concatenate([points[n - 2 :] != 0, np.zeros(n - 2, bool)]) if n > 1 else points != 0  # may end in a word's end, never cross it
        buckets.append((key[valid] >> np.uint64(64 - 15)).astype(np.int64))
        owners.append(owner[valid])
    return np.concatenate(buckets), np.concatenate(owners)


def bucket_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, bucket, n over all rows whose text and language are known; bucket -1 counts a language's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = _lower_table()
        totals: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        words: dict[str, Counter] = defaultdict(Counter)
        rows: Counter = Counter()

        def fold() -> Iterator[pa.RecordBatch]:
            for label, counted in words.items():
                some = list(counted)
                for start in range(0, len(some), _AT_ONCE):
                    part = some[start : start + _AT_ONCE]
                    buckets, owners = _features(part, lower)
                    weight = np.fromiter(map(counted.__getitem__, part), np.int64, len(part))
                    totals[label] += np.bincount(buckets, weight[owners], BUCKETS).astype(np.int64)
            words.clear()
            if len(totals) > _LABELS_HELD:
                yield from out()

        def out() -> Iterator[pa.RecordBatch]:
            for label, n in rows.items():
                used = np.flatnonzero(totals[label])
                yield pa.RecordBatch.from_arrays([pa.array([label] * (len(used) + 1), pa.string()), pa.array([*used.tolist(), -1], pa.int32()), pa.array([*totals[label][used].tolist(), n], pa.int64())], names=["lang", "bucket", "n"])
            totals.clear()
            rows.clear()

        for batch in sliced(batches, 0):
            for value, label in zip(byte_values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words[label].update(value.split())
                rows[label] += 1
            if sum(map(len, words.values())) > _FOLD_AT:
                yield from fold()
        yield from fold()
        yield from out()

    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return known.mapInArrow(tidied(run), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class NaiveBayes:
    """Labels in sorted order, their log priors, and log P(bucket | label) as float32."""

    def __init__(self, langs: list[str], buckets: np.ndarray, counts: np.ndarray):
        self.labels = sorted(set(langs))
        if len(self.labels) > MAX_LANGUAGES:
            raise ValueError(f"{len(self.labels)} languages; at most {MAX_LANGUAGES} are learned")
        which = np.searchsorted(np.array(self.labels, dtype=object), np.array(langs, dtype=object)) if langs else np.zeros(0, int)
        table, rows = np.full((BUCKETS, len(self.labels)), SMOOTHING), np.zeros(len(self.labels))
        seen = buckets >= 0
        table[buckets[seen], which[seen]] += counts[seen]
        rows[which[~seen]] = counts[~seen]
        self.prior = np.log(np.maximum(rows, 1) / max(rows.sum(), 1))
        self.matrix = np.log(table / table.sum(axis=0)).astype(np.float32)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> NaiveBayes:
    """The model of all given rows; at most (BUCKETS + 1) * MAX_LANGUAGES counts reach the driver."""
    table = bucket_counts(docs, text, lang).toArrow()
    return NaiveBayes(table.column("lang").to_pylist(), table.column("bucket").to_numpy(), table.column("n").to_numpy())


def predict(docs: DataFrame, model: NaiveBayes, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """docs with the predicted language, its posterior, and how likely its n-grams are in that language (their
    mean log probability, and their number); and the new columns' names."""
    names = {c: fresh(docs, c) for c in ("lang_pred", "score", "fit", "n_grams")}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        nb, lower, index = shared.value, _lower_table(), {}
        width = len(nb.labels) + 1  # a word's last number is how many n-grams it has
        held = np.empty((min(_REMEMBER, _REMEMBER_BYTES // (4 * width)), width), np.float32)

        def scores(words: list[bytes]) -> np.ndarray:
            out = np.empty((len(words), width), np.float32)
            for start in range(0, len(words), _AT_ONCE):
                part = words[start : start + _AT_ONCE]
                buckets, owners = _features(part, lower)
                order = np.argsort(owners, kind="stable")
                n = np.bincount(owners, minlength=len(part))
                out[start : start + len(part), :-1] = np.add.reduceat(nb.matrix[buckets[order]], np.cumsum(n) - n, axis=0)
                out[start : start + len(part), -1] = n
            return out

        def compute(column):
            texts, raws = column.to_pylist(), byte_values(column)
            split = [raw.split() if raw else [] for raw in raws]
            here = list(set().union(*split))
            new = [i for i, w in enumerate(here) if w not in index]
            rows = np.empty((len(here), width), np.float32)
            known = [i for i, w in enumerate(here) if w in index]
            rows[known] = held[[index[here[i]] for i in known]]
            rows[new] = scores([here[i] for i in new])
            first = len(index)
            room = new[: len(held) - first]
            held[first : first + len(room)] = rows[room]
            index.update((here[i], first + k) for k, i in enumerate(room))
            at = {w: i for i, w in enumerate(here)}
            out = []
            for t, words in zip(texts, split, strict=True):
                if not words or not nb.labels or not any(map(str.isalpha, t)):
                    out.append(("und", 0.0, None, 0))
                    continue
                places = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
                summed = sum(rows[places[i : i + _AT_ONCE]].sum(axis=0, dtype=np.float64) for i in range(0, len(places), _AT_ONCE))
                total = nb.prior + summed[:-1]
                best = int(total.argmax())
                out.append((nb.labels[best], float(1.0 / np.exp(total - total[best]).sum()), float(summed[best] / summed[-1]), int(summed[-1])))
            return [list(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]

        return compute

    fields = [pa.field(names[c], t) for c, t in (("lang_pred", pa.string()), ("score", pa.float64()), ("fit", pa.float64()), ("n_grams", pa.int64()))]
    return with_arrow_columns(docs, [text], fields, make), names


def told_languages(docs: DataFrame, model: NaiveBayes, text: str = "text") -> DataFrame:
    """The documents whose language is told: not `und`, with a posterior of one half at least, and with n-grams about as
    likely as that language's documents have them. The lower limit is SPREADS robust deviations below the language's
    median, for a mean over so many n-grams, and a margin; it rejects texts of languages that were not learned, which naive Bayes
    would give to one of its own with certainty. Texts are scored once. A verdict depends on the text
    alone, so rejected ones are known by a key of it; texts are shuffled only where too many are rejected to broadcast their keys."""
    texts = docs.select(F.col(text).alias("text"), content_key(text).alias("key"))
    found = stored(predict(texts, model, "text")[0].drop("text"))
    known = found.where("fit IS NOT NULL")
    centres = broadcast_if_small(known.groupBy(F.col("lang_pred").alias("l")).agg(F.percentile_approx("fit", F.lit(0.5), F.lit(10_000)).alias("centre")))
    z = (F.col("fit") - F.col("centre")) * F.sqrt(F.col("n_grams").cast("double"))
    cuts = known.join(centres, F.col("lang_pred") == F.col("l")).groupBy("l", "centre").agg(F.percentile_approx(z, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias("q"))
    limits = broadcast_if_small(cuts.select("l", "centre", ((F.col("q")[1] - F.col("q")[0]) / 1.349).alias("spread")))
    low = F.col("centre") - SPREADS * F.col("spread") / F.sqrt(F.col("n_grams").cast("double")) - MARGIN
    told = F.coalesce((F.col("score") >= 0.5) & (F.col("fit") >= low), F.lit(False))
    return without(docs, content_key(text), found.join(limits, F.col("lang_pred") == F.col("l"), "left").where(~told).select("key"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(learnable(F.col("doc_id"))))
    scored, names = predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model)
    return scored.select("doc_id", "held_out", *(names[c] for c in ("lang_pred", "score")))
