"""Small frames with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word" * 2000 + " " + "the quick brown fox jumps over a lazy dog again and again. " * 400


def awkward(spark):
    rows = [
        (1, None, "en", "src1", 0), (2, "", "en", "src1", 0), (3, " \n\t ", None, None, 3), (4, LONG, "en", "src2", len(LONG)), (5, "x", "de", "src3", 1),
        (6, "a b c d e f", "fr", "src4", 11), (6, "a b c d e f", "fr", "src4", 11), (None, "no id here but words enough to count", "en", None, 1),
        (7, "\x00nul and ퟿ high İ dotted ÀÉ <|endoftext|> end", "xx", "odd source", 9), (8, "!!! ### $$$", "en", "src1", 11),
    ]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """df with columns named like those that the operators add."""
    from pyspark.sql import functions as F

    names = ["score", "kept", "base_failed", "log_ppl", "n_words", "class", "component", "key", "row", "epoch", "domain", "host", "path", "rule", "verdict", "lang_pred"]
    return df.withColumns({c: F.lit(f"own {c}") for c in names if c not in df.columns})


def written(df, folder, name="documents"):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
