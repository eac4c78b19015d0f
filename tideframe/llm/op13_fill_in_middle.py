"""Fill-in-the-middle documents, cut at token boundaries that a wavelet matrix finds.

A token is a run of ASCII letters or any other single character. Every code point has a class: a letter
that continues a run, a letter that opens one, a digit, white space, or any other sign. A wavelet
matrix over the classes of a batch of texts answers rank(class, i), how often a class occurs before
place i, in one step for each of its three levels. As every token begins at exactly one code point that
is not a continuing letter, the tokens begun before i are the sum of the ranks of the other classes, and
bisection on that sum finds where the k-th token ends; all documents of a batch are searched at once.

Cuts and forms come from the sha256 of `1:` and the document's id, so they are the same however the
table is dealt. The output has the sentinels <P>, <S> and <M>; a text that is empty or holds one of
them stays plain. restore() rebuilds the exact text from the output and the form.

Nulls: a null text is an empty one; a null id is hashed as `1:`. Texts of any length are whole: a
batch holds about a megabyte of them, a longer text comes alone. Repeated rows each give a row, the same
for equal rows. Other columns are not looked at, so their names may be any. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.llm.common import documents, with_arrow_columns

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, how many are cut, and how many of those have their suffix first.
CUT, SUFFIX_FIRST = 90, 20
INSIDE, OPENS, DIGIT, SPACE, OTHER = range(5)
_LEVELS = 3
_ASCII = np.full(128, OTHER, np.uint8)
_ASCII[ord("A") : ord("Z") + 1] = _ASCII[ord("a") : ord("z") + 1] = OPENS
_ASCII[ord("0") : ord("9") + 1] = DIGIT
_ASCII[[9, 10, 11, 12, 13, 32]] = SPACE


class WaveletMatrix:
    """rank() over a sequence of small integers: a bit vector for each level, with counts of ones before each word of 64 bits."""

    def __init__(self, values: np.ndarray, levels: int = _LEVELS):
        self.levels, self.n = levels, len(values)
        self.words, self.ones, self.zeros = [], [], []
        for level in reversed(range(levels)):
            bits = (values >> level & 1).astype(bool)
            packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little").view("<u8")
            self.words.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(len(bits) - int(self.ones[-1][-1]))
            values = np.concatenate([values[~bits], values[bits]])

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.ones[level][word] + np.bitwise_count(below)

    def rank(self, value: int, i: np.ndarray) -> np.ndarray:
        """How often value occurs before each place i."""
        low, high = np.zeros_like(i), i
        for level in range(self.levels):
            low1, high1 = self._rank1(level, low), self._rank1(level, high)
            if value >> (self.levels - 1 - level) & 1:
                low, high = self.zeros[level] + low1, self.zeros[level] + high1
            else:
                low, high = low - low1, high - high1
        return high - low


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each code point of texts that begin at some places."""
    found = np.where(points < 128, _ASCII[np.minimum(points, 127)], OTHER).astype(np.uint8)
    letters = found == OPENS
    follows = np.concatenate([[False], letters[:-1]])
    follows[starts[starts < len(points)]] = False
    found[letters & follows] = INSIDE
    return found


class Tokens:
    """The tokens of a batch of texts: their numbers, and where the first k of each end."""

    def __init__(self, texts: list[str]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.matrix = WaveletMatrix(classes(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), self.starts))
        self.before = self.begun(self.starts)
        self.counts = self.begun(self.ends) - self.before

    def begun(self, i: np.ndarray) -> np.ndarray:
        """The tokens of the whole batch that begin before place i."""
        return sum(self.matrix.rank(c, i) for c in (OPENS, DIGIT, SPACE, OTHER))

    def cut(self, k: np.ndarray) -> np.ndarray:
        """For each text, the code points that its first k tokens take: the next token's place, by bisection on ranks."""
        low, high = self.starts.copy(), self.ends.copy()
        wanted = self.before + k
        while (open_ := low < high).any():  # the first place by which more tokens have begun than wanted, less one
            middle = (low + high) // 2
            enough = self.begun(np.minimum(middle + 1, self.matrix.n)) > wanted
            low, high = np.where(open_ & ~enough, middle + 1, low), np.where(open_ & enough, middle, high)
        return low - self.starts


def arranged(form: str, text: str, a: int, b: int) -> str:
    if form == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}" if form == "psm" else f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restore(form: str, output: str) -> str:
    """The text that an output was made of; no part holds a sentinel, and none can arise where parts meet."""
    if form == "plain":
        return output
    rest, middle = output.split(MIDDLE)
    first, second = rest.removeprefix(PREFIX if form == "psm" else SUFFIX).split(SUFFIX if form == "psm" else PREFIX)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


FIELDS = [pa.field("n", pa.int64()), pa.field("form", pa.string()), pa.field("prefix_chars", pa.int64()), pa.field("middle_chars", pa.int64()), pa.field("output", pa.large_string())]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars, output: a row for each document."""

    def make():
        def compute(column: pa.Array, *hashes: pa.Array) -> list:
            texts = column.to_pylist()
            h1, h2, h3, h4 = (h.to_numpy() for h in hashes)
            tokens = Tokens(texts)
            cuts = h1 % (tokens.counts + 1), h2 % (tokens.counts + 1)
            ends = tokens.cut(np.minimum(*cuts)), tokens.cut(np.maximum(*cuts))
            forms, outputs = [], []
            for i, t in enumerate(texts):
                plain = not t or h3[i] % 100 >= CUT or any(s in t for s in (PREFIX, SUFFIX, MIDDLE))
                forms.append("plain" if plain else "spm" if h4[i] % 100 < SUFFIX_FIRST else "psm")
                outputs.append(arranged(forms[-1], t, int(ends[0][i]), int(ends[1][i])))
            told = np.array([f == "plain" for f in forms])
            return [pa.array(tokens.counts), forms, pa.array(ends[0], mask=told), pa.array(ends[1] - ends[0], mask=told), outputs]

        return compute

    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), digest.alias("digest"))
    words = {f"h{k + 1}": F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)}
    given = given.withColumns(words).drop("digest")
    return with_arrow_columns(given, ["text", *words], FIELDS, make, drop=list(words))


def restored(made: DataFrame) -> DataFrame:
    """made with restored: the text that its output and form give."""
    field = pa.field("restored", pa.large_string())
    return with_arrow_columns(made, ["output", "form"], [field], lambda: lambda output, form: [[restore(f, o) for f, o in zip(form.to_pylist(), output.to_pylist(), strict=True)]])


def digests(docs: DataFrame) -> DataFrame:
    """The columns of transform(), with the digests of outputs and of what they restore to in place of texts."""

    def make():
        def compute(output: pa.Array, form: pa.Array) -> list:
            sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
            pairs = list(zip(form.to_pylist(), output.to_pylist(), strict=True))
            return [[sha(o) for _, o in pairs], [sha(restore(f, o)) for f, o in pairs]]

        return compute

    fields = [pa.field("output_sha256", pa.string()), pa.field("restored_sha256", pa.string())]
    return with_arrow_columns(transform(docs).drop("text"), ["output", "form"], fields, make, drop=["output"]).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))


ORACLE_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t FROM documents),
  k AS (SELECT *, len(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
  c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
  p AS (SELECT doc_id, n, form, text, coalesce(array_to_string(list_slice(t, 1, a), ''), '') AS prefix, coalesce(array_to_string(list_slice(t, a + 1, b), ''), '') AS middle, coalesce(array_to_string(list_slice(t, b + 1, n), ''), '') AS suffix FROM c)
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(CASE WHEN form = 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256 FROM p"""
