"""Lineage, runs, anomalies, metrics and health, as append-only tables and views of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def run_summary(results: DataFrame) -> DataFrame:
    """AGG9: for each run how its pairs went, its rows and gaps, throughput and status."""
    failed, skipped = F.col("error").isNotNull(), F.col("skipped")
    df = results.groupBy("run_id").agg(
        F.count("*").alias("total"), F.count_if(~failed & ~skipped).alias("succeeded"), F.count_if(skipped).alias("skipped"), F.count_if(failed).alias("failed"),
        F.sum("rows").alias("rows"), F.sum("gaps_found").alias("gaps_found"), F.sum("gaps_healed").alias("gaps_healed"), F.max("duration_ms").alias("duration_ms"),
    )
    status = F.when(F.col("failed") == 0, "ok").when(F.col("failed") < F.col("total"), "degraded").otherwise("failed")
    return df.withColumns({"rows_per_s": F.coalesce(F.round(F.try_divide("rows", F.col("duration_ms") / 1000), 2), F.lit(0.0)), "status": status})


def anomaly_counts(log: DataFrame) -> DataFrame:
    """AGG11/SRT4: first and last time and count of each anomaly."""
    return log.groupBy("exchange", "symbol", "timeframe", "reason").agg(F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"), F.count("*").alias("n"))


def novel(anomalies: DataFrame, log: DataFrame) -> DataFrame:
    """DQ13: anomalies whose series and reason, up to a bracket, the log does not have."""
    prefix = lambda df: df.withColumn("reason", F.trim(F.substring_index("reason", "(", 1)))
    key = ["exchange", "symbol", "timeframe", "reason"]
    return prefix(anomalies).join(prefix(log).select(*key).distinct(), key, "left_anti").dropDuplicates(key)


# What a dataset's manifest must say, besides its parts.
MANIFEST_FIELDS = ["symbol", "timeframe", "exchange", "version"]


def manifest_problems(datasets: DataFrame, parts: DataFrame, by: str = "symbol") -> DataFrame:
    """AGG15: what is wrong with each dataset's manifest: fields that are null, no part at all, and of its parts (min_ms, max_ms, rows)
    those that do not begin before they end, that overlap the next, or have no row."""
    w = Window.partitionBy(by).orderBy("min_ms", "max_ms")
    df = parts.withColumn("next_ms", F.lead("min_ms").over(w))
    told = df.groupBy(by).agg(F.count("*").alias("parts"), F.count_if(F.col("next_ms") < F.col("max_ms")).alias("overlaps"), F.count_if(F.col("min_ms") >= F.col("max_ms")).alias("inverted"), F.count_if(F.col("rows") < 1).alias("empty"))
    missing = F.concat_ws(",", *(F.when(F.col(c).isNull(), c) for c in sorted(MANIFEST_FIELDS)))
    known = datasets.select(by, missing.alias("missing")).join(told, by, "left").fillna(0)
    return known.withColumn("ok", (F.col("missing") == "") & (F.col("parts") > 0) & (F.col("overlaps") + F.col("inverted") + F.col("empty") == 0))


def with_loss(lineage: DataFrame) -> DataFrame:
    """AGG17: the share of rows that a step lost."""
    return lineage.withColumn("loss_rate", F.coalesce(F.try_divide(F.col("rows_in") - F.col("rows_out"), F.col("rows_in")), F.lit(0.0)))


def latest_runs(runs: DataFrame) -> DataFrame:
    """LIN3: the last record of each run."""
    rest = [c for c in runs.columns if c != "run_id"]
    return runs.groupBy("run_id").agg(F.max_by(F.struct(*rest), "ts_ms").alias("r")).select("run_id", *(F.col(f"r.{c}").alias(c) for c in rest))


def cursor_lag(cursors: DataFrame, now_ms: int) -> DataFrame:
    """AGG19: series and mean lag of each venue."""
    return cursors.groupBy("exchange").agg(F.count("*").alias("series"), F.avg(now_ms - F.col("cursor_ms")).alias("mean_lag_ms"))


def stream_metrics(events: DataFrame, bounds: list[float]) -> DataFrame:
    """AGG20: events by topic, venue and outcome, and a histogram of a value by upper bounds."""
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("value")))
    return events.groupBy("topic", "exchange", "outcome", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def failure_rate(events: DataFrame, limit: float, minutes: int = 5) -> DataFrame:
    """AGG21: failed events a second in each window, and whether that is an alarm."""
    df = events.groupBy(F.window("timestamp", f"{minutes} minutes").alias("w")).agg(F.count_if("failed").alias("failed"))
    rate = F.col("failed") / (60.0 * minutes)
    return df.select(F.unix_millis("w.start").alias("window_ms"), "failed", (rate > limit).alias("alarm"))


# The limits of the health rules.
STALE_S, FETCH_ERRORS_PER_S, FAILED_EVENTS_PER_S, WINDOW_S = 600, 0.1, 1.0, 300


def health(metrics: DataFrame, venues: DataFrame, now_ms: int) -> DataFrame:
    """AGG21: four rules for each venue, each with its value and whether that is an alarm.

    metrics: exchange, metric (last_run, fetch_errors, events_failed, circuit_open), ts_ms, value. The
    pipeline is stale when its last run is absent or older than ten minutes; errors are rates of the last
    five minutes; any circuit open is an alarm.
    """
    of = lambda name, when=None: F.when((F.col("metric") == name) if when is None else (F.col("metric") == name) & when, F.col("value"))
    recent = F.col("ts_ms") > now_ms - WINDOW_S * 1000
    totals = metrics.where(F.col("ts_ms") <= now_ms).groupBy("exchange").agg(
        F.max(F.when(F.col("metric") == "last_run", F.col("ts_ms"))).alias("last_run"), F.sum(of("fetch_errors", recent)).alias("fetch"), F.sum(of("events_failed", recent)).alias("failed"),
        F.max_by(of("circuit_open"), F.when(F.col("metric") == "circuit_open", F.col("ts_ms"))).alias("circuit"),
    )
    df = venues.select("exchange").distinct().join(totals, "exchange", "left")
    age, zero = (now_ms - F.col("last_run")) / 1000.0, F.lit(0.0)
    rate = lambda c: F.coalesce(F.col(c) / float(WINDOW_S), zero)
    one = lambda rule, value, alarm: F.struct(F.lit(rule).alias("rule"), value.alias("value"), alarm.alias("alarm"))
    told = F.array(
        one("stale", age, F.coalesce(age > STALE_S, F.lit(True))), one("fetch_errors", rate("fetch"), rate("fetch") > FETCH_ERRORS_PER_S),
        one("events_failed", rate("failed"), rate("failed") > FAILED_EVENTS_PER_S), one("circuit_open", F.coalesce("circuit", zero), F.coalesce(F.col("circuit") > 0, F.lit(False))),
    )
    return df.select("exchange", F.inline(told))


LINEAGE = "run_id string, layer string, exchange string, symbol string, timeframe string, rows_in long, rows_out long, status string, quality_score double, params string, ts_ms long"


def record(lineage: DataFrame, folder: str) -> None:
    """LIN1: append steps to the lineage table."""
    types = dict(part.split() for part in LINEAGE.split(", "))
    lineage.select(*((F.col(c) if c in lineage.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items())).write.mode("append").parquet(f"{folder}/lineage")


def lineage_of(spark, folder: str) -> DataFrame:
    """LIN1/LIN2: the lineage table, with the share of rows that each step lost."""
    return with_loss(spark.read.schema(LINEAGE).parquet(f"{folder}/lineage"))


def run_events(lineage: DataFrame, run_id: str) -> DataFrame:
    """LIN2/SRT4: the steps of a run, the first first."""
    return lineage.where(F.col("run_id") == run_id).orderBy("ts_ms", "symbol", "layer")


def series_history(lineage: DataFrame, symbol: str, exchange: str, limit: int = 100) -> DataFrame:
    """LIN2/SRT4: the newest steps of a series; a limit, as it is a report."""
    return lineage.where((F.col("symbol") == symbol) & (F.col("exchange") == exchange)).orderBy(F.desc("ts_ms"), "layer", "run_id").limit(limit)


def runs_by_time(runs: DataFrame, limit: int, env: str | None = None, result: str | None = None) -> DataFrame:
    """SRT4/LIN3: the newest runs of an environment or result, if given; a limit, as it is a report."""
    df = latest_runs(runs)
    for c, v in (("env", env), ("result", result)):
        df = df if v is None else df.where(F.col(c) == v)
    return df.orderBy(F.desc("ts_ms"), "run_id").limit(limit)


def run_id(at: Column, noise: Column) -> Column:
    """PRJ26: an id of a time and eight hexadecimal digits."""
    return F.concat(F.date_format(at, "yyyyMMdd'T'HHmmss"), F.lit("-"), F.substring(F.md5(noise.cast("string").cast("binary")), 1, 8))


def checkpoints(rows: DataFrame) -> DataFrame:
    """STR14: the newest time of each external source."""
    return rows.groupBy("source_id").agg(F.max("timestamp_ms").alias("checkpoint"))


def past_checkpoints(rows: DataFrame, known: DataFrame) -> DataFrame:
    """STR14: the rows of each source that are newer than its checkpoint; all of a source without one."""
    k = known.select(F.col("source_id").alias("_source"), "checkpoint")
    return rows.join(k, F.col("source_id") == F.col("_source"), "left").where(F.col("checkpoint").isNull() | (F.col("timestamp_ms") > F.col("checkpoint"))).drop("_source", "checkpoint")
