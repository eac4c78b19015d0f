"""Time gaps: scan, registry, repair, and the planning of incremental and backfill reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.functions.timeframes import lookup, ms_of
from tideframe.operators.resample import KEY

# Arrivals that may still correct a candle, by venue, and in how many bars at least, by timeframe.
LATENESS_MS = {"bybit": 600_000, "kucoin": 900_000, "kucoinfutures": 900_000}
LATENESS_DEFAULT_MS = 900_000
LEAST_OVERLAP = {"1m": 1, "3m": 1, "5m": 1, "15m": 1, "30m": 1, "1h": 2, "2h": 2, "4h": 2, "6h": 2, "8h": 2, "12h": 2, "1d": 1, "1w": 1}
# First days of trading, by venue.
ORIGINS = {"kucoin": "2018-01-01", "kucoinfutures": "2020-01-01", "bybit": "2021-04-01", "bybit_futures": "2019-10-01"}
ORIGIN_DEFAULT = "2017-01-01"

FACTOR, LARGEST_REPAIR, FULL_RATIO, PAGE, MONTH_MS = 2, 43_200, 0.95, 500, 2_592_000_000
GAP = [*KEY, "start_ms", "end_ms"]


def scan_gaps(candles: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """WIN12/WIN13: neighbours at least (2 + tolerance) timeframes apart, with the candles missing between and a severity."""
    ms, step = F.unix_millis("timestamp"), ms_of(F.col("timeframe"))
    df = candles.select(*KEY, ms.alias("end_ms"), F.lag(ms).over(Window.partitionBy(*KEY).orderBy("timestamp")).alias("start_ms"), step.alias("step"))
    df = df.where(F.col("end_ms") - F.col("start_ms") >= F.col("step") * (FACTOR + tolerance))
    df = df.withColumn("expected", F.floor((F.col("end_ms") - F.col("start_ms")) / F.col("step")) - 1)
    return df.select(*GAP, "expected", severity(F.col("expected")).alias("severity"), (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"))


def severity(expected: Column) -> Column:
    return F.when(expected <= 2, "low").when(expected <= 10, "medium").otherwise("high")


def severity_counts(gaps: DataFrame, rows_removed: int = 0) -> DataFrame:
    """DQ12: gaps of each severity, without each series' first rows_removed gaps."""
    n = F.row_number().over(Window.partitionBy(*KEY).orderBy("start_ms"))
    return gaps.withColumn("_n", n).where(F.col("_n") > rows_removed).groupBy(*KEY, "severity").agg(F.count("*").alias("gaps"))


def healed(gaps: DataFrame, candidates: DataFrame) -> DataFrame:
    """JN6, DED6, GAP6: the latest candidate of each timestamp strictly inside a gap, and the gap's fill ratio.

    A range join within a series needs an equal key to scale: both sides are dealt by the months
    that they touch, so a candle meets only the gaps of its own month.
    """
    months = F.explode(F.sequence(F.floor(F.col("start_ms") / MONTH_MS), F.floor(F.col("end_ms") / MONTH_MS)))
    g = gaps.select(*GAP, "expected", months.alias("month"))
    c = candidates.withColumn("ts_ms", F.unix_millis("timestamp")).withColumn("month", F.floor(F.col("ts_ms") / MONTH_MS))
    inside = c.join(g, [*KEY, "month"]).where((F.col("ts_ms") > F.col("start_ms")) & (F.col("ts_ms") < F.col("end_ms")))
    newest = inside.groupBy(*GAP, "expected", "ts_ms").agg(F.max_by(F.struct("open", "high", "low", "close", "volume"), "seq").alias("bar"))
    return newest.select(*GAP, "expected", "ts_ms", "bar.*")


def repair_outcome(gaps: DataFrame, rows: DataFrame, irrecoverable: DataFrame | None = None) -> DataFrame:
    """GAP5/JN7: what became of each gap: skipped, failed, partial or full."""
    filled = rows.groupBy(*GAP).agg(F.count("*").alias("filled"))
    df = gaps.join(filled, GAP, "left").fillna(0, ["filled"])
    if irrecoverable is not None:
        df = df.join(irrecoverable.select(*GAP).distinct(), GAP, "left_anti")
    ratio = F.try_divide("filled", "expected")
    outcome = F.when(F.col("expected") > LARGEST_REPAIR, "skipped").when(F.col("filled") == 0, "failed").when(ratio >= FULL_RATIO, "full").otherwise("partial")
    return df.select(*GAP, "expected", "filled", ratio.alias("fill_ratio"), outcome.alias("outcome"))


def lifecycle(outcomes: DataFrame) -> DataFrame:
    """GAP7: detected, healed and failed events of gaps, keyed by series and start."""
    key = F.concat_ws(":", "exchange", "symbol", "timeframe", F.col("start_ms").cast("string"))
    event = F.explode(F.array(F.lit("gap_detected"), F.when(F.col("outcome").isin("full", "partial"), "gap_healed").when(F.col("outcome") == "failed", "gap_heal_failed")))
    return outcomes.select(key.alias("event_key"), event.alias("event_type"), "expected", "filled").where("event_type IS NOT NULL")


# ---- registry -----------------------------------------------------------------------------------


def register(registry: DataFrame, gaps: DataFrame, now_ms: int) -> DataFrame:
    """GAP1: the registry with gaps it has not seen, as pending with no attempt; the first registration stays."""
    new = gaps.select(*GAP, "expected").join(registry.select(*GAP), GAP, "left_anti").dropDuplicates(GAP)
    new = new.select("*", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(now_ms).cast("long").alias("detected_ms"))
    return registry.unionByName(new)


def resolve(registry: DataFrame, outcomes: DataFrame, most_attempts: int = 3) -> DataFrame:
    """GAP2/GAP3: attempts counted up; gaps filled become healed, those tried too often irrecoverable."""
    told = registry.join(outcomes.select(*GAP, "outcome"), GAP, "left")
    attempts = F.col("attempts") + F.col("outcome").isNotNull().cast("int")
    status = F.when(F.col("outcome") == "full", "healed").when(F.col("outcome").isNotNull() & (attempts >= most_attempts), "irrecoverable").otherwise(F.col("status"))
    return told.withColumns({"status": status, "attempts": attempts}).drop("outcome")


def pending(registry: DataFrame, now_ms: int, ttl_days: int = 90) -> DataFrame:
    """GAP4: gaps still to be repaired, within their time to live."""
    return registry.where((F.col("status") == "pending") & (F.col("detected_ms") > now_ms - ttl_days * 86_400_000))


# ---- planning -----------------------------------------------------------------------------------


def overlap_bars(timeframe: Column, exchange: Column, calibrated_ms: Column | None = None) -> Column:
    """GAP8: bars to read again: the timeframe's least, or what the venue's lateness covers."""
    late = F.coalesce(*([calibrated_ms] if calibrated_ms is not None else []), lookup(LATENESS_MS, exchange), F.lit(LATENESS_DEFAULT_MS))
    return F.greatest(lookup(LEAST_OVERLAP, timeframe, 1), F.ceil(late / ms_of(timeframe)))


def incremental_start(cursors: DataFrame, now_ms: int, days: int = 30) -> DataFrame:
    """GAP9: from which time each series is read: its cursor less the overlap, else its start, else some days back."""
    back = F.col("cursor_ms") - overlap_bars(F.col("timeframe"), F.col("exchange")) * ms_of(F.col("timeframe"))
    return cursors.withColumn("since_ms", F.coalesce(back, F.col("start_ms"), F.lit(now_ms - days * 86_400_000)))


def newer(rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """GAP10/GAP14/DED9: rows of each series past its cursor; all rows of a series without one."""
    c = cursors.select(*KEY, "cursor_ms")
    return rows.join(c, KEY, "left").where(F.col("cursor_ms").isNull() | (F.unix_millis("timestamp") > F.col("cursor_ms"))).drop("cursor_ms")


def backfill_pages(series: DataFrame, page: int = PAGE) -> DataFrame:
    """GAP11: windows of page candles from origin_ms to oldest_ms, newest first."""
    width = ms_of(F.col("timeframe")) * page
    steps = F.sequence(F.lit(0), F.ceil((F.col("oldest_ms") - F.col("origin_ms")) / width) - 1)
    df = series.where("oldest_ms > origin_ms").withColumn("width", width).withColumn("page", F.explode(steps))
    end = F.col("oldest_ms") - F.col("page") * F.col("width")
    return df.select(*KEY, "page", F.greatest("origin_ms", end - F.col("width")).alias("from_ms"), end.alias("to_ms"))


def origins(candles: DataFrame, now_ms: int) -> DataFrame:
    """GAP13/PRJ29: each series' first time; the venue's first day where that is within a day of now."""
    first = candles.groupBy(*KEY).agg(F.min(F.unix_millis("timestamp")).alias("first_ms"))
    day = lookup(ORIGINS, F.col("exchange"), ORIGIN_DEFAULT)
    return first.withColumn("origin_ms", F.when(F.col("first_ms") > now_ms - 86_400_000, F.unix_millis(day.cast("timestamp"))).otherwise(F.col("first_ms")))


def advanced(old: DataFrame, new: DataFrame, forward: bool = True) -> DataFrame:
    """AGG18/GAP12: cursors merged with newer ones; forward cursors only grow, backfill cursors only shrink."""
    best = F.max if forward else F.min
    return old.select(*KEY, "cursor_ms").unionByName(new.select(*KEY, "cursor_ms")).groupBy(*KEY).agg(best("cursor_ms").alias("cursor_ms"))


def replayed(bronze: DataFrame, requests: DataFrame) -> DataFrame:
    """GAP15: landed rows that are asked for again, marked as a replay, with the request's id.

    requests: request_id, symbol, from_ms (inclusive) and to_ms (exclusive); a null bound is open. A row that
    several ask for comes once for each. The join is by symbol, so AQE broadcasts a small table of requests.
    """
    ms = F.unix_millis("timestamp")
    r = requests.select("request_id", F.col("symbol").alias("_symbol"), "from_ms", "to_ms")
    inside = (ms >= F.coalesce("from_ms", F.lit(0))) & (F.col("to_ms").isNull() | (ms < F.col("to_ms")))
    return bronze.join(r, (F.col("symbol") == F.col("_symbol")) & inside).drop("_symbol", "from_ms", "to_ms").withColumn("source", F.lit("replay"))
