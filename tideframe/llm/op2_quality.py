"""Quality rules: base counts, and bands of n-gram perplexity for each language.

Language model. Spark counts every n-gram of ORDER characters of every document, for each language:
characters as they are, capitals, all scripts and the ends of words included, so an n-gram also sees
how words follow each other, and what is gathered grows with the corpus. Distinct left extensions
give the lower orders; each order's discounts, totals and back-off mass are aggregations, and
interpolated modified Kneser-Ney probabilities go up the orders by joins. The model is a table of
64-bit n-gram hashes with their surprise. Its HEAD most frequent n-grams at most are broadcast as
sorted hash arrays, whose size this bounds; a document's other n-grams are joined to the table, and no
n-gram is left out. Texts are scored by a model of the same documents, so every n-gram is known.

A document's log-perplexity of a word, its end included, is compared with an upper and a lower limit
of its language, which come from the documents that the base rules keep.

Nulls: a null text has no words, so it fails the base rules; a null language is a language of its own;
ids are never looked at, so repeated rows and null ids are kept apart as they are, and equal
texts of one language are judged alike. Texts of any length are whole. New columns take names that
no column of docs has in any case. Empty tables give empty results. Rows are numbered as they are read, so
docs must give the same rows in the same order when read again, as files do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.llm.common import broadcast_if_small, content_key, frequent, fresh, sliced, stored, tidied, with_arrow_columns, without

ORDER = 5
MIN_WORDS = 20
WINDOW = 8
#: Half width of a band: SPREADS robust deviations of a text of that many words, and a margin.
SPREADS, MARGIN = 3.0, 0.02
#: N-grams that are broadcast at most.
HEAD = 1 << 20
_WHITE = " \t\v\f\r"
_SYMBOLS = "#*$%&|<>"
#: Bits of a character's number in a packed n-gram, and characters held by a task before they are folded into counts.
_BITS, _FOLD_AT = 12, 1_000_000
_SLICE = 1 << 19
_U = np.uint64


# ---- characters -----------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Characters:
    """The characters of some texts in a row, each run of white space as one blank.

    padded opens each text with ORDER - 1 zeros and closes it with a blank, which leads to none
    where a text has no word; at says where its characters lie in padded, and doc whose they are.
    """

    def __init__(self, texts: list[str | None]):
        points = np.frombuffer("".join(f"{t or ''} " for t in texts).encode("utf-32-le"), np.uint32).copy()
        sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
        blank = (points == 32) | ((points >= 9) & (points <= 13))
        self.symbols = np.isin(points, np.frombuffer(_SYMBOLS.encode("utf-32-le"), np.uint32))
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        self.n_symbols = np.bincount(doc[self.symbols], minlength=len(texts))
        points[blank] = 32
        points[points == 0] = 0xFFFD  # 0 is kept for what precedes a text
        keep = ~(blank & np.concatenate([[True], blank[:-1]])) if len(points) else blank
        self.points, self.doc, self.blank = points[keep], doc[keep], blank[keep]
        self.n_words = np.bincount(self.doc[self.blank], minlength=len(texts))
        self.size = np.bincount(self.doc, minlength=len(texts))
        self.at = np.arange(len(self.points)) + (ORDER - 1) * (self.doc + 1)
        self.padded = np.zeros(len(self.points) + (ORDER - 1) * len(texts), np.uint32)
        self.padded[self.at] = self.points

    def hashes(self, seeds: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the n-gram that ends at each character, by a seed for each text."""
        return gram_hashes([self.padded[self.at - back] for back in range(ORDER - 1, -1, -1)], seeds[self.doc])

    def repeated_words(self) -> np.ndarray:
        """For each text, its words inside windows of WINDOW words that it holds twice or more, by 64-bit hashes."""
        out = np.zeros(len(self.size), np.int64)
        letters = ~self.blank
        if letters.sum() < WINDOW:
            return out
        word = (np.cumsum(self.blank) - self.blank)[letters]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        place = np.arange(len(word)) - first[word]
        ids = np.add.reduceat(_mix(self.points[letters].astype(_U) | place.astype(_U) << _U(21)), first)
        doc = self.doc[letters][first]
        windows = len(ids) - WINDOW + 1
        if windows < 2:
            return out
        key = np.zeros(windows, _U)
        for k in range(WINDOW):
            key = _mix(key + ids[k : k + windows])
        inside = doc[:windows] == doc[WINDOW - 1 :]
        key = _mix(key + doc[:windows].astype(_U))[inside]
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            starts = np.flatnonzero(inside)[np.isin(key, twice)]
            marks = np.bincount(starts, minlength=len(ids) + 1) - np.bincount(starts + WINDOW, minlength=len(ids) + 1)
            out += np.bincount(doc[np.cumsum(marks)[: len(ids)] > 0], minlength=len(out))
        return out


def gram_hashes(points: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """Hashes of n-grams given as the arrays of their first, second, ... characters."""
    key = seeds.copy()
    for first in range(0, len(points), 3):
        part = points[first].astype(_U)
        for more in points[first + 1 : first + 3]:
            part = part << _U(21) | more
        key = _mix(key + part)
    return key


def language_seed(language: str) -> int:
    return int.from_bytes(hashlib.md5(language.encode()).digest()[:8], "little")


def language_of(lang: str) -> Column:
    """A language's own name, which is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit(""))


# ---- counting -------------------------------------------------------------------------------


class _Counts:
    """Counts of n-grams as packed numbers of characters; the numbers are dealt as characters come."""

    def __init__(self):
        self.numbers, self.alphabet = np.zeros(0x110000, np.int16), [0]
        self.held: list[np.ndarray] = []
        self.keys, self.counts, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def fits(self, points: np.ndarray) -> bool:
        """Deal numbers to the characters; False, with nothing done, where there are more than fit."""
        new = np.flatnonzero(np.bincount(points, minlength=1))
        new = new[(self.numbers[new] == 0) & (new > 0)]
        if len(self.alphabet) + len(new) > 1 << _BITS:
            return False
        self.numbers[new] = np.arange(len(self.alphabet), len(self.alphabet) + len(new))
        self.alphabet.extend(new.tolist())
        return True

    def add(self, text: Characters) -> None:
        numbers = self.numbers[text.padded].astype(np.int64)
        key = np.zeros(len(text.at), np.int64)
        for back in range(ORDER - 1, -1, -1):
            key = key << _BITS | numbers[text.at - back]
        self.held.append(key)
        self.waiting += len(key)
        if self.waiting > _FOLD_AT:
            self.fold()

    def fold(self) -> None:
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *self.held]), return_counts=True)
        self.keys, where = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        self.counts = np.bincount(where, np.concatenate([self.counts, counts]), len(self.keys)).astype(np.int64)
        self.held, self.waiting = [], 0

    def strings(self) -> tuple[list[str], np.ndarray]:
        self.fold()
        alphabet = np.array(self.alphabet, np.uint32)
        points = np.stack([alphabet[self.keys >> _BITS * back & (1 << _BITS) - 1] for back in range(ORDER - 1, -1, -1)], axis=1)
        return _strings(points), self.counts


def _strings(points: np.ndarray) -> list[str]:
    """Rows of ORDER characters as strings; the last character is never 0."""
    return np.ascontiguousarray(points, np.uint32).view(f"<U{ORDER}").ravel().tolist()


def ngram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """language, ngram, n: occurrences of every n-gram of ORDER characters over all whole texts."""

    def made(language: str, grams: list[str], counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([language] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], names=["language", "ngram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, _Counts] = {}
        for batch in sliced(batches, 0, _SLICE):
            texts, languages = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for language in sorted(set(languages)):
                characters = Characters([t for t, x in zip(texts, languages, strict=True) if x == language])
                own = found.setdefault(language, _Counts())
                if not own.fits(characters.padded):
                    yield made(language, *own.strings())
                    own = found[language] = _Counts()
                    if not own.fits(characters.padded):  # more characters in one slice than have numbers
                        points = np.stack([characters.padded[characters.at - back] for back in range(ORDER - 1, -1, -1)], axis=1)
                        rows, counts = np.unique(points, axis=0, return_counts=True)
                        yield made(language, _strings(rows), counts)
                        continue
                own.add(characters)
            if len(found) > 8 or sum(len(own.keys) for own in found.values()) > _FOLD_AT:
                for language, own in found.items():
                    yield made(language, *own.strings())
                found.clear()
        for language, own in found.items():
            yield made(language, *own.strings())

    parts = docs.select(F.col(text).alias("text"), language_of(lang).alias("language")).mapInArrow(tidied(run), "language string, ngram string, n long")
    return parts.groupBy("language", "ngram").agg(F.sum("n").alias("n"))


# ---- model ----------------------------------------------------------------------------------


def discounts(levels: list[DataFrame]) -> DataFrame:
    """language, level, d: Chen and Goodman's three discounts of each order; kept within what a count has where the counts of counts are degenerate."""
    every = reduce(DataFrame.union, (level.select("language", F.lit(n).alias("level"), "n") for n, level in enumerate(levels, 1)))
    n = every.groupBy("language", "level").agg(*(F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(k: int, otherwise: float) -> Column:
        some = F.col(f"n{k}") > 0
        return F.when(some & (F.col("n1") > 0), F.least(F.lit(k - 0.1), F.greatest(F.lit(0.1), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")))).otherwise(otherwise)

    return n.select("language", "level", F.array(d(1, 0.5), d(2, 1.0), d(3, 1.5)).alias("d"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """language, ngram, n, p: interpolated modified Kneser-Ney probabilities of the counted n-grams.

    The highest order has the given counts, lower ones count distinct left extensions. Below the
    first order every character of the language, and one that it lacks, is as likely.
    """
    levels = [counts]
    for n in range(ORDER - 1, 0, -1):
        shorter = levels[0].groupBy("language", F.substring("ngram", 2, n).alias("ngram")).agg(F.count("*").alias("n"))
        levels.insert(0, stored(shorter) if n == ORDER - 1 else shorter)
    taken_off = broadcast_if_small(discounts(levels))
    below = None
    for n, level in enumerate(levels, 1):
        context = Window.partitionBy("language", F.substring("ngram", 1, n - 1))
        taken = level.join(taken_off.where(F.col("level") == n).drop("level"), "language").withColumn("d", F.col("d")[F.least(F.col("n"), F.lit(3)).cast("int") - 1])
        summed = taken.withColumn("total", F.sum("n").over(context)).withColumn("mass", F.sum("d").over(context))
        if below is None:
            summed = summed.withColumn("below", 1 / (F.count("*").over(context) + 1))
        else:
            summed = summed.withColumn("tail", F.substring("ngram", 2, n - 1)).join(below.select("language", F.col("ngram").alias("tail"), F.col("p").alias("below")), ["language", "tail"])
        below = summed.select("language", "ngram", "n", ((F.col("n") - F.col("d") + F.col("mass") * F.col("below")) / F.col("total")).alias("p"))
    return below


def hashed(model: DataFrame) -> DataFrame:
    """key, n, surprise: the model by the hashes of its n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = np.frombuffer("".join(batch.column("ngram").to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
            seeds = {x: language_seed(x) for x in batch.column("language").unique().to_pylist()}
            keys = gram_hashes(list(points.T), np.array([seeds[x] for x in batch.column("language").to_pylist()], _U))
            surprise = -np.log(batch.column("p").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("n"), pa.array(surprise)], names=["key", "n", "surprise"])

    return model.mapInArrow(tidied(run), "key long, n long, surprise double")


class SortedHashes:
    """Values by hash: sorted arrays, entered by the hash's first bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = np.append(keys[order], ~_U(0)), np.append(values[order], 0.0)
        self.shift = _U(64 - max(1, int(len(keys)).bit_length() + 1))
        self.starts = np.searchsorted(self.keys[:-1], np.arange(1 << 64 - int(self.shift), dtype=_U) << self.shift).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the hashes, and which are known."""
        at = self.starts[wanted >> self.shift]
        behind = np.flatnonzero(self.keys[at] < wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < wanted[behind]]
        hit = (self.keys[at] == wanted) & (at < len(self.keys) - 1)
        return np.where(hit, self.values[at], 0.0), hit


# ---- scoring --------------------------------------------------------------------------------


def _repeated_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return len(lines) - len(set(lines))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, dict[str, str]]:
    """docs without its text, with the base counts, log_ppl (the mean surprise of a word;
    null where there is no word) and the row's number; and the new columns' names. Texts are read twice and never shuffled."""
    model = stored(hashed(kneser_ney(stored(ngram_counts(docs, text, lang)))))
    head, rest = frequent(model, HEAD)
    table = head.select("key", "surprise").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(SortedHashes(table.column("key").to_numpy().view(_U), table.column("surprise").to_numpy()))
    names = {c: fresh(docs, c) for c in (*MEASURES, "log_ppl", "row", "language", "known", "others")}
    slim = docs.withColumns({names["row"]: F.monotonically_increasing_id(), names["language"]: language_of(lang)})

    def make():
        arrays, seeds = shared.value, {}

        def compute(column, languages):
            texts, own = column.to_pylist(), languages.to_pylist()
            seeds.update({x: language_seed(x) for x in set(own).difference(seeds)})
            characters = Characters(texts)
            keys = characters.hashes(np.array([seeds[x] for x in own], _U))
            value, hit = arrays.find(keys)
            known = np.bincount(characters.doc, value, len(texts))
            miss = np.flatnonzero(~hit)
            ends = np.cumsum(np.bincount(characters.doc[miss], minlength=len(texts)))
            others = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(keys[miss].view(np.int64)))
            lines = np.fromiter(map(_repeated_lines, texts), np.int64, len(texts))
            return [characters.n_words, characters.size - characters.n_words, characters.n_symbols, lines, characters.repeated_words(), known, others]

        return compute

    fields = [pa.field(names[c], pa.int64()) for c in MEASURES] + [pa.field(names["known"], pa.float64()), pa.field(names["others"], pa.list_(pa.int64()))]
    rows = stored(with_arrow_columns(slim, [text, names["language"]], fields, make, drop=[text, names["language"]], most=_SLICE))
    others = rows.select(F.col(names["row"]).alias("row"), F.explode(names["others"]).alias("key")).join(rest.select("key", "surprise"), "key")
    more = others.groupBy(F.col("row").alias(fresh(rows, "more_row"))).agg(F.sum("surprise").alias(fresh(rows, "more")))
    joined = rows.join(more, rows[names["row"]] == more[more.columns[0]], "left")
    n_words = F.col(names["n_words"])
    ppl = F.when(n_words > 0, (F.col(names["known"]) + F.coalesce(F.col(more.columns[1]), F.lit(0.0))) / n_words)
    scored = joined.withColumn(names["log_ppl"], ppl).drop(names["known"], names["others"], *more.columns)
    return stored(scored), {c: n for c, n in names.items() if c in (*MEASURES, "log_ppl", "row")}


def bands(scores: DataFrame, lang: str, n_words: str, log_ppl: str) -> DataFrame:
    """band_lang, centre and spread of every language, over the given documents.

    A mean over n words varies as 1 / sqrt(n), so the spread is that of the distance from the
    language's median times sqrt(n), taken robustly from the quartiles.
    """
    known = scores.where(F.col(log_ppl).isNotNull()).select(language_of(lang).alias("band_lang"), F.col(n_words).alias("n"), F.col(log_ppl).alias("x"))
    centres = broadcast_if_small(known.groupBy("band_lang").agg(F.percentile_approx("x", F.lit(0.5), F.lit(10_000)).alias("centre")))
    z = (F.col("x") - F.col("centre")) * F.sqrt(F.col("n").cast("double"))
    cuts = known.join(centres, "band_lang").groupBy("band_lang", "centre").agg(F.percentile_approx(z, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias("q"))
    return cuts.select("band_lang", "centre", ((F.col("q")[1] - F.col("q")[0]) / 1.349).alias("spread"))


def base_failed_by(names: dict[str, str]) -> Column:
    words, repeats = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (words < MIN_WORDS) | (100 * repeats > 30 * words)


def judged(scored: DataFrame, limits: DataFrame, names: dict[str, str], lang: str = "lang") -> tuple[DataFrame, dict[str, str]]:
    """scored with base_failed and kept; and all new columns' names. A document of a language without a band is not kept."""
    base_failed, kept = fresh(scored, "base_failed"), fresh(scored, "kept")
    b = {c: fresh(scored, c) for c in ("band_lang", "centre", "spread")}
    words, ppl = F.col(names["n_words"]), F.col(names["log_ppl"])
    limits = broadcast_if_small(limits.withColumnsRenamed(b))
    joined = scored.join(limits, language_of(lang) == F.col(b["band_lang"]), "left")
    half_width = F.lit(SPREADS) * F.col(b["spread"]) / F.sqrt(F.greatest(words, F.lit(1)).cast("double")) + F.lit(MARGIN)
    inside = F.coalesce(F.abs(ppl - F.col(b["centre"])) <= half_width, F.lit(False))
    failed = base_failed_by(names)
    return joined.withColumns({base_failed: failed, kept: ~failed & inside}).drop(*b.values()), names | {"base_failed": base_failed, "kept": kept}


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, dict[str, str]]:
    """docs without its text, with the base counts, log_ppl, base_failed, kept and the row's number; and the new columns' names."""
    scored, names = measured(docs, text, lang)
    return judged(scored, bands(scored.where(~base_failed_by(names)), lang, names["n_words"], names["log_ppl"]), names, lang)


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, whole. A verdict depends on text and language alone, so rejected documents are
    known by a key of these; texts are shuffled only where too many are rejected to broadcast their keys."""
    given = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), content_key(text, lang).alias("key"))
    verdicts, names = quality_rules(given)
    return without(docs, content_key(text, lang), verdicts.where(~F.col(names["kept"])).select("key"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return quality_rules(docs)[0].drop("lang", "row")
