"""Gold features of candles, for all series at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType
from pyspark.sql.window import Window

from tideframe.functions.timeframes import YEARLY, YEARLY_DEFAULT, lookup
from tideframe.operators.resample import KEY

ROLLING, LEAST = 20, 5
FEATURES = ["log_return", "return_1", "volatility_20", "vwap", "high_low_spread", "volume_z", "price_range_pct", "body_pct", "is_suspect"]


def _series():
    return Window.partitionBy(*KEY).orderBy("timestamp")


def rolling(value: Column, aggregate, rows: int = ROLLING, least: int = LEAST) -> Column:
    """An aggregate of the last rows, null unless so many of them have a value."""
    frame = _series().rowsBetween(1 - rows, 0)
    return F.when(F.count(value).over(frame) >= least, aggregate(value).over(frame))


def _nonzero(c: str | Column) -> Column:
    return F.nullif(c if isinstance(c, Column) else F.col(c), F.lit(0.0))


def log_return() -> Column:
    return F.ln(F.try_divide(_nonzero("close"), F.lag(_nonzero("close")).over(_series())))


def return_1() -> Column:
    return F.try_divide(F.col("close"), F.lag("close").over(_series())) - 1


def volatility() -> Column:
    return rolling(F.col("log_return"), F.stddev_samp) * F.sqrt(lookup(YEARLY, F.col("timeframe"), YEARLY_DEFAULT).cast("double"))


def vwap() -> Column:
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    volume = _nonzero("volume")
    return F.try_divide(rolling(typical * volume, F.sum), rolling(volume, F.sum))


def volume_z() -> Column:
    v = F.col("volume")
    return F.try_divide(v - rolling(v, F.avg), _nonzero(rolling(v, F.stddev_samp)))


def sanitized(df: DataFrame) -> DataFrame:
    """Infinite values of all floating columns become null."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(F.abs(F.col(c)) == float("inf"), None).otherwise(F.col(c)) for c in doubles})


def without_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns})


def gold_features(candles: DataFrame) -> DataFrame:
    """All input columns and the nine features. One shuffle by series serves every window."""
    flag = F.col("quality_flag") if "quality_flag" in candles.columns else F.lit(None).cast("string")
    df = candles.withColumns({"log_return": log_return(), "return_1": return_1()})
    df = df.withColumns({
        "volatility_20": volatility(),
        "vwap": vwap(),
        "high_low_spread": F.try_divide(F.col("high") - F.col("low"), _nonzero("close")),
        "volume_z": volume_z(),
        "price_range_pct": F.try_divide(F.col("high") - F.col("low"), _nonzero("open")),
        "body_pct": F.try_divide(F.abs(F.col("close") - F.col("open")), _nonzero("open")),
        "is_suspect": F.coalesce(flag == "suspect", F.lit(False)),
    })
    return sanitized(df)


def build_all(lake, candles: DataFrame, wanted: DataFrame, commit_id: int, now_ms: int, run_id: str, version: str) -> DataFrame:
    """SNK4: Gold of all wanted series in one job, and how it went: done and rows for each wanted series.

    A wanted series without a candle fails; the others are replaced under one commit.
    """
    from tideframe.sources.snapshots import gold_rows

    some = candles.join(wanted.select(*KEY).distinct(), KEY, "left_semi")
    lake.commit(gold_rows(gold_features(some), run_id, version, commit_id), "gold", commit_id, now_ms, "replace", run_id, version, commit_id)
    built = lake.snapshots("gold").where(F.col("commit_id") == commit_id).select(*KEY, F.col("added_rows").alias("rows"))
    told = wanted.select(*KEY).distinct().join(built, KEY, "left")
    return told.select(*KEY, F.col("rows").isNotNull().alias("done"), F.coalesce("rows", F.lit(0)).alias("rows"))
