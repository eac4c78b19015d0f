"""Data quality of candles: checks to issues, issues to a score, a score to a decision."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.functions.timeframes import FLAT, FLAT_DEFAULT, lookup, ms_of
from tideframe.operators.resample import KEY, OHLCV

# What a share of affected rows costs, by check; and the limits of the decision.
WEIGHTS = {"future_timestamps": 1.0, "ohlc_inconsistencies": 0.9, "temporal_gaps": 0.5, "price_outliers_mad": 0.3, "price_outliers_zscore": 0.2, "flatline_candles": 0.1, "empty_dataset": 1.0}
WEIGHT_DEFAULT, REJECT_BELOW, FLAG_BELOW, CRITICAL_SHARE = 0.3, 40.0, 99.0, 0.10
GAP_FACTOR, GAP_CRITICAL, MAD_LIMIT, Z_LIMIT, Z_ROWS, Z_LEAST = 1.5, 0.05, 3.5, 4.0, 20, 10
GAP_TIMEFRAMES = ("1m", "5m", "15m", "1h", "4h", "1d")


def _order(by: list[str] = KEY):
    return Window.partitionBy(*by).orderBy("timestamp")


def _known_order(by: list[str] = KEY):
    """A series' rows that have a close, in their order; those that have none are apart."""
    return Window.partitionBy(*by, F.isnull("close")).orderBy("timestamp")


def with_zscore(candles: DataFrame, by: list[str] = KEY) -> DataFrame:
    """WIN14: distance of the close from its rolling mean in rolling deviations; 0 where that is not defined.

    Rows without a close are in no frame.
    """
    frame = _known_order(by).rowsBetween(1 - Z_ROWS, 0)
    enough = F.count("close").over(frame) >= Z_LEAST
    deviation = F.nullif(F.when(enough, F.stddev_samp("close").over(frame)), F.lit(0.0))
    z = F.abs(F.try_divide(F.col("close") - F.when(enough, F.avg("close").over(frame)), deviation))
    return candles.withColumn("z", F.coalesce(z, F.lit(0.0)))


def _median(values: Column) -> Column:
    s, n = F.array_sort(values), F.size(values)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def with_mad(candles: DataFrame, by: list[str] = KEY) -> DataFrame:
    """WIN15: modified z-score of the close, in a centred frame whose width follows the series' length.

    Frames hold 101 rows at most, so arrays stay small; the deviation is around the current row's median.
    Rows without a close are in no frame.
    """
    df = candles.withColumn("_n", F.count("close").over(Window.partitionBy(*by, F.isnull("close")))).withColumn("_i", F.row_number().over(_known_order(by)))
    half = F.floor(F.least(F.lit(100), F.greatest(F.lit(10), F.floor(F.col("_n") / 5))) / 2)
    near = F.collect_list(F.struct("_i", "close")).over(_known_order(by).rowsBetween(-50, 50))
    df = df.withColumn("_half", half).withColumn("_near", near)
    values = F.transform(F.filter("_near", lambda x: (F.abs(x["_i"] - F.col("_i")) <= F.col("_half")) & x["close"].isNotNull()), lambda x: x["close"])
    df = df.withColumn("_values", values).withColumn("_median", _median(F.col("_values")))
    df = df.withColumn("_mad", _median(F.transform("_values", lambda v: F.abs(v - F.col("_median")))))
    score = F.try_divide(0.6745 * F.abs(F.col("close") - F.col("_median")), F.nullif(F.col("_mad"), F.lit(0.0)))
    return df.withColumn("mad_score", F.when(F.col("_n") >= 5, F.coalesce(score, F.lit(0.0))).otherwise(0.0)).drop("_n", "_i", "_half", "_near", "_values", "_median", "_mad")


def checks(candles: DataFrame, now_ms: int, by: list[str] = KEY) -> DataFrame:
    """DQ1-DQ7: the counts behind every check, one row for each series (or what else is judged by itself), in one pass over scored rows: one shuffle by series serves every window and the counts."""
    candles = candles.repartition(*by)
    ms = F.unix_millis("timestamp")
    step = F.when(F.col("timeframe").isin(*GAP_TIMEFRAMES), ms_of(F.col("timeframe")))
    df = with_mad(with_zscore(candles, by), by).withColumn("_delta", ms - F.lag(ms).over(_order(by))).withColumn("_step", step)
    gap = F.col("_delta") > F.col("_step") * GAP_FACTOR
    h, lo, c, o = (F.col(x) for x in ("high", "low", "close", "open"))
    rows = F.count("*")
    return df.groupBy(*by).agg(
        rows.alias("rows"),
        F.count_if(ms > now_ms).alias("future"),
        F.count_if(gap).alias("gaps"),
        F.coalesce(F.floor(F.sum(F.when(gap, F.col("_delta") / F.col("_step") - 1))), F.lit(0)).alias("missing_bars"),
        F.coalesce(F.max(F.when(gap, F.col("_delta"))) / 1000, F.lit(0.0)).alias("largest_gap_s"),
        (F.count_if(h < lo) + F.count_if(c > h) + F.count_if(c < lo) + F.count_if(o > h) + F.count_if(o < lo)).alias("inconsistent"),
        F.count_if(F.col("mad_score") > MAD_LIMIT).alias("mad_outliers"),
        F.max("mad_score").alias("max_mad"),
        F.when(F.count("close") > Z_ROWS, F.count_if(F.col("z") > Z_LIMIT)).otherwise(0).alias("z_outliers"),
        F.max("z").alias("max_z"),
        F.count_if(h - lo < c * lookup(FLAT, F.col("timeframe"), FLAT_DEFAULT)).alias("flat"),
    )


def with_expected(found: DataFrame, expected: DataFrame) -> DataFrame:
    """DQ2: the checks with a row of zeros for each expected series that has no candle at all."""
    numbers = [c for c in found.columns if c not in KEY]
    return expected.select(*KEY).distinct().join(found, KEY, "full").fillna(0, numbers)


def issue_array(found: DataFrame, rows_removed: int = 0) -> Column:
    """DQ2, DQ16: the issues of each row of checks: check, severity, affected rows."""
    gaps = F.greatest(F.lit(0), F.col("gaps") - rows_removed)
    one = lambda check, severity, n: F.struct(F.lit(check).alias("check"), severity.alias("severity"), n.cast("long").alias("affected"))
    critical, warning = F.lit("critical"), F.lit("warning")
    every = F.array(
        one("empty_dataset", critical, (F.col("rows") == 0).cast("long")),
        one("future_timestamps", critical, F.col("future")),
        one("temporal_gaps", F.when(F.try_divide(gaps, F.col("rows")) >= GAP_CRITICAL, "critical").otherwise("warning"), gaps),
        one("ohlc_inconsistencies", critical, F.col("inconsistent")),
        one("price_outliers_mad", warning, F.col("mad_outliers")),
        one("price_outliers_zscore", warning, F.col("z_outliers")),
        one("flatline_candles", warning, F.col("flat")),
    )
    return F.filter(every, lambda i: i["affected"] > 0)


def issues(found: DataFrame, rows_removed: int = 0) -> DataFrame:
    """DQ16: a row for each check that a series fails: check, severity, affected rows, all rows."""
    return found.select(*KEY, "rows", F.explode(issue_array(found, rows_removed)).alias("i")).select(*KEY, "rows", "i.*")


@dataclass(frozen=True)
class Policy:
    """UDF6: what issues cost, and where scores are rejected or flagged."""

    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    weight_default: float = WEIGHT_DEFAULT
    reject_below: float = REJECT_BELOW
    flag_below: float = FLAG_BELOW
    critical_share: float = CRITICAL_SHARE


def decisions(found: DataFrame, issue_rows: DataFrame | None = None, policy: Policy | None = None, by: list[str] = KEY) -> DataFrame:
    """DQ8-DQ11: score, decision, tier and reasons of every series, those without an issue too.

    Issues are those of the checks, told within each row, or given ones, joined by series.
    """
    policy = policy or Policy()
    if issue_rows is None:
        df = found.select(*by, "rows", issue_array(found).alias("_issues"))
    else:
        given = issue_rows.groupBy(*by).agg(F.collect_list(F.struct("check", "severity", "affected")).alias("_issues"))
        df = found.select(*by, "rows").join(given, by, "left").withColumn("_issues", F.coalesce("_issues", F.array().cast("array<struct<check:string,severity:string,affected:bigint>>")))
    costs = lambda i: lookup(policy.weights, i["check"], policy.weight_default) * i["affected"] / F.greatest("rows", F.lit(1)) * F.when(i["severity"] == "critical", 2.0).otherwise(1.0) * 100
    total = lambda values, zero: F.aggregate(values, zero, lambda a, x: a + x)
    penalty = total(F.transform("_issues", costs), F.lit(0.0))
    critical = total(F.transform(F.filter("_issues", lambda i: i["severity"] == "critical"), lambda i: i["affected"]), F.lit(0).cast("long"))
    reasons = F.array_sort(F.transform("_issues", lambda i: F.concat(i["check"], F.lit("("), i["severity"], F.lit("): "), i["affected"].cast("string"), F.lit(" rows"))))
    df = df.withColumns({"score": F.when(F.col("rows") == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 100 - penalty)), "_critical": critical, "reasons": reasons})
    reject = (F.col("rows") == 0) | (F.col("score") < policy.reject_below) | (F.coalesce(F.try_divide("_critical", "rows"), F.lit(0.0)) > policy.critical_share)
    df = df.withColumn("decision", F.when(reject, "reject").when(F.col("score") < policy.flag_below, "accept_with_flags").otherwise("accept"))
    tier = F.when(F.col("decision") == "reject", "rejected").when(F.col("decision") == "accept", "clean").otherwise("flagged")
    return df.select(*by, "rows", "score", "decision", tier.alias("tier"), "reasons")


def accepted(candles: DataFrame, decided: DataFrame) -> DataFrame:
    """DQ11: candles of the series that are not rejected, with their tier."""
    return candles.join(decided.where("tier != 'rejected'").select(*KEY, "tier"), KEY)


# ---- expectations -------------------------------------------------------------------------------

_RULES: dict[str, tuple[str, str]] = {
    "close_not_null": ("close IS NULL", "critical"),
    "open_not_null": ("open IS NULL", "critical"),
    "prices_positive": ("NOT (open > 0 AND high > 0 AND low > 0 AND close > 0)", "critical"),
    "high_ge_low": ("high < low", "critical"),
    "high_ge_open": ("high < open", "critical"),
    "high_ge_close": ("high < close", "critical"),
    "open_ge_low": ("open < low", "critical"),
    "close_ge_low": ("close < low", "critical"),
    "volume_not_negative": ("volume < 0", "critical"),
    "timestamp_unique": ("_same > 1", "critical"),
    "timestamp_increasing": ("_delta <= 0", "warning"),
}


def expectations(candles: DataFrame, rules: dict[str, tuple[str, str]] | None = None, seq: str = "seq") -> DataFrame:
    """DQ14/DQ15/UDF2: generic rules, as SQL for a bad row and a severity, counted for each series.

    Rules may use _same, the rows with a row's timestamp, and _delta, the time since the row before in arrival order.
    """
    rules = rules or _RULES
    ms = F.unix_millis("timestamp")
    df = candles.withColumn("_same", F.count("*").over(Window.partitionBy(*KEY, "timestamp"))).withColumn("_delta", ms - F.lag(ms).over(Window.partitionBy(*KEY).orderBy(seq, "timestamp")))
    counts = df.groupBy(*KEY).agg(F.count("*").alias("rows"), *(F.count_if(F.expr(bad)).alias(name) for name, (bad, _) in rules.items()))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("expectation"), F.lit(s).alias("severity"), F.col(n).alias("unexpected")) for n, (_, s) in rules.items())))
    return counts.select(*KEY, "rows", each.alias("e")).select(*KEY, "rows", "e.*").withColumn("success", F.col("unexpected") == 0)


def table_expectations(candles: DataFrame) -> DataFrame:
    """DQ14: what the table as a whole must have: its columns, doubles where numbers belong, and a row. One row for each expectation."""
    kinds = dict(candles.dtypes)
    told = [(f"column_exists:{c}", "critical", c in kinds) for c in ("timestamp", *OHLCV)] + [(f"type_double:{c}", "warning", kinds.get(c) == "double") for c in OHLCV]
    told.append(("row_count_positive", "warning", not candles.isEmpty()))
    return candles.sparkSession.createDataFrame(told, "expectation string, severity string, success boolean")


def expectation_issues(results: DataFrame) -> DataFrame:
    """DQ15: failed expectations as issues: check, severity, affected rows, all rows."""
    return results.where("NOT success").select(*KEY, "rows", F.col("expectation").alias("check"), "severity", F.col("unexpected").alias("affected"))


def judged_expectations(candles: DataFrame, rules: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """DQ15: issues of the expectations; where they cannot be evaluated at all, one warning for each series says so (the degraded report)."""
    from pyspark.errors import AnalysisException

    try:
        return expectation_issues(expectations(candles, rules))
    except AnalysisException:
        rows = candles.groupBy(*KEY).agg(F.count("*").alias("rows"))
        return rows.select(*KEY, "rows", F.lit("expectations_failed").alias("check"), F.lit("warning").alias("severity"), F.col("rows").alias("affected"))


# ---- two venues ---------------------------------------------------------------------------------

PRICE_LIMIT, VOLUME_LIMIT, CRITICAL_ROWS, LEAST_COMMON = 0.005, 0.5, 0.05, 10


def _side(df: DataFrame, x: str) -> DataFrame:
    return df.select("symbol", "timeframe", F.date_trunc("minute", "timestamp").alias("minute"), *(F.col(c).alias(f"{c}_{x}") for c in OHLCV))


def aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """JN1: candles of two venues of the same minute side by side; equal keys, so sort-merge or broadcast as sizes tell."""
    return _side(a, "a").join(_side(b, "b"), ["symbol", "timeframe", "minute"])


def venue_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """JN2-JN5, DQ17: for each series of both venues the divergences, the minutes of one venue only, and a verdict."""
    mid = lambda x: (F.col(f"high_{x}") + F.col(f"low_{x}")) / 2
    apart = lambda x, y: F.try_divide(F.abs(x - y), F.nullif((x + y) / 2, F.lit(0.0)))
    price, volume = apart(mid("a"), mid("b")), apart(F.col("volume_a"), F.col("volume_b"))
    key, common = ["symbol", "timeframe", "minute"], F.col("in_a") & F.col("in_b")
    # one full join of both sides by minute tells all: rows of a minute are counted where they meet, then those of a series
    both = _side(a, "a").withColumn("in_a", F.lit(True)).join(_side(b, "b").withColumn("in_b", F.lit(True)), key, "full")
    minutes = both.groupBy(*key).agg(
        F.count_if(common).alias("common"), F.count_if(common & (price > PRICE_LIMIT)).alias("price_diverges"), F.max(F.when(common, price)).alias("max_price_gap"), F.count_if(common & (volume > VOLUME_LIMIT)).alias("volume_diverges"),
        F.count("in_a").alias("_a"), F.count("in_b").alias("_b"),
    )
    total = lambda c: F.sum(c).alias(c)
    df = minutes.groupBy("symbol", "timeframe").agg(F.count_if(F.col("_b") == 0).alias("only_a"), F.count_if(F.col("_a") == 0).alias("only_b"), total("common"), total("price_diverges"), F.max("max_price_gap").alias("max_price_gap"), total("volume_diverges"))
    verdict = F.when(F.col("common") < LEAST_COMMON, "no_overlap").when(F.try_divide("price_diverges", "common") > CRITICAL_ROWS, "critical").when((F.col("price_diverges") + F.col("volume_diverges") + F.col("only_a") + F.col("only_b")) > 0, "warning").otherwise("clean")
    return df.withColumn("verdict", verdict)
