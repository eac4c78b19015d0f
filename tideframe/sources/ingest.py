"""Incremental ingest as one job over all series: what is new is judged, published and only then left behind by the cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.operators import gaps, quality
from tideframe.operators.resample import KEY
from tideframe.sources.landed import candle_messages, exploded_bars, parsed
from tideframe.sources.log_source import publish


def incremental(candles: DataFrame, cursors: DataFrame, log: str, run_id: str, now_ms: int, policy: quality.Policy | None = None) -> tuple[DataFrame, DataFrame]:
    """GAP14: how the run went for each series of cursors, and the cursors after it.

    Rows past a series' cursor go through the quality checks; those of series that are not rejected are published as the log's next
    batch; the cursors then advance to the last candle that this batch has, as it is read back. A series without new rows, or rejected, is skipped
    and keeps its cursor. If publishing fails, so does the run, and no cursor moves; a run that is repeated sends the same event ids.
    """
    spark = candles.sparkSession
    fresh = gaps.newer(candles.join(cursors.select(*KEY), KEY, "left_semi"), cursors).persist()
    told = quality.decisions(quality.checks(fresh, now_ms), policy=policy).persist()
    seq = publish(candle_messages(quality.accepted(fresh, told), run_id, "live", strict=False), log)
    events = parsed(spark.read.text(f"{log}/seq={seq:012d}").select(F.get_json_object("value", "$.value").alias("value")), "ohlcv")
    sent = exploded_bars(events).groupBy("exchange", "symbol", "timeframe").agg(F.max(F.unix_millis("timestamp")).alias("cursor_ms"), F.count("*").alias("sent"))
    report = cursors.select(*KEY).join(told.select(*KEY, "rows", "tier", "score"), KEY, "left").join(sent.drop("cursor_ms"), ["exchange", "symbol", "timeframe"], "left")
    status = F.when(F.col("rows").isNull(), "skipped").when(F.col("tier") == "rejected", "rejected").otherwise("published")
    report = report.select(*KEY, status.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("sent", F.lit(0)).alias("sent"), "tier", "score")
    moved = gaps.advanced(cursors, cursors.select(*KEY).join(sent, ["exchange", "symbol", "timeframe"]))
    return report, moved
