"""Resampling: trades or finer candles to coarser candles, over all series in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.functions.timeframes import MS, floor_ms, floor_time, to_ms

SERIES = ["exchange", "market_type", "symbol"]
KEY = [*SERIES, "timeframe"]
OHLCV = ["open", "high", "low", "close", "volume"]


def _ohlcv(order: Column) -> list[Column]:
    """First, highest, lowest, last and sum of candles in a group; order makes first and last definite."""
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def candles_from_trades(trades: DataFrame, timeframe: str) -> DataFrame:
    """Candles of trades: epoch-aligned buckets, first and last by (timestamp, trade_id)."""
    start = floor_time(F.col("timestamp"), F.lit(to_ms(timeframe)))
    rows = trades.select(*SERIES, F.lit(timeframe).alias("timeframe"), start.alias("bucket"), "timestamp", "trade_id", "price", "amount")
    order = F.struct("timestamp", "trade_id")
    candles = rows.groupBy(*KEY, "bucket").agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("amount").alias("volume"))
    return candles.withColumnRenamed("bucket", "timestamp")


def align_to_grid(candles: DataFrame, seq: str = "seq") -> DataFrame:
    """AGG1: candles moved to their timeframe's grid and merged; with AGG2's drift and collision marks.

    drifted counts the rows of a bucket that were moved, collided those that share it with another.
    """
    step = F.lit(None).cast("long")
    for name, ms in MS.items():
        step = F.when(F.col("timeframe") == name, F.lit(ms)).otherwise(step)
    rows = candles.withColumn("bucket", floor_time(F.col("timestamp"), step))
    order = F.struct("timestamp", seq)
    merged = rows.groupBy(*KEY, "bucket").agg(*_ohlcv(order), F.count_if(F.col("bucket") != F.col("timestamp")).alias("drifted"), F.count("*").alias("n"))
    return merged.withColumn("collided", F.when(F.col("n") > 1, F.col("n")).otherwise(0)).drop("n").withColumnRenamed("bucket", "timestamp")


def resample(candles: DataFrame, targets: list[str], now_ms: int | None = None) -> DataFrame:
    """AGG3 and AGG5: candles of one finer timeframe to all targets, in one pass.

    The last bucket of each series is incomplete and dropped; with now_ms it is kept once it is over.
    Each row is repeated for each target before one shuffle, which partial sums keep small.
    """
    steps = F.array(*(F.struct(F.lit(t).alias("timeframe"), F.lit(to_ms(t)).alias("ms")) for t in targets))
    rows = candles.drop("timeframe").withColumn("target", F.explode(steps))
    rows = rows.withColumn("timeframe", F.col("target.timeframe")).withColumn("bucket_ms", floor_ms(F.unix_millis("timestamp"), F.col("target.ms")))
    merged = rows.groupBy(*KEY, "bucket_ms", F.col("target.ms").alias("ms")).agg(*_ohlcv(F.col("timestamp")), F.count("*").alias("n_source"))
    last = F.max("bucket_ms").over(Window.partitionBy(*KEY))
    done = F.col("bucket_ms") < last
    if now_ms is not None:
        done = done | (F.col("bucket_ms") + F.col("ms") <= now_ms)
    kept = merged.withColumn("done", done).where("done")
    return kept.select(*KEY, F.timestamp_millis("bucket_ms").alias("timestamp"), *OHLCV, "n_source")


def lookback(candles: DataFrame, target: str, now_ms: int, periods: int = 2, least: int = 2) -> DataFrame:
    """AGG4: the source candles of the last target periods, from a grid point; series with too few are skipped."""
    ms = to_ms(target)
    start = now_ms - periods * ms
    start -= start % ms
    recent = candles.where((F.col("timestamp") >= F.timestamp_millis(F.lit(start))) & (F.col("timestamp") < F.timestamp_millis(F.lit(now_ms))))
    return recent.withColumn("n", F.count("*").over(Window.partitionBy(*KEY))).where(F.col("n") >= least).drop("n")


def run_summary(resampled: DataFrame, expected: DataFrame) -> DataFrame:
    """AGG5: for each target, series made against series expected, as ok, partial or failed."""
    made = resampled.groupBy("timeframe").agg(F.count_distinct(*SERIES).alias("made"), F.count("*").alias("rows"))
    both = expected.groupBy("timeframe").agg(F.count("*").alias("wanted")).join(made, "timeframe", "left").fillna(0, ["made", "rows"])
    return both.withColumn("status", F.when(F.col("made") == F.col("wanted"), "ok").when(F.col("made") > 0, "partial").otherwise("failed"))
