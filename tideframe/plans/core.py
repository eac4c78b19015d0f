"""Queries of candles: resampling, features, Silver, gaps, quality and two venues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tideframe.functions.timeframes import FLAT, MS, YEARLY
from tideframe.operators import features, gaps, quality, resample, rules, silver
from tideframe.operators.resample import KEY, OHLCV
from tideframe.plans.register import long, query, rounded, ts_ms
from tideframe.sources import landed
from tideframe.sources import mappings as m
from tideframe.sources.snapshots import Lake, new_folder

K = "exchange, market_type, symbol, timeframe"
HOUR = MS["1h"]
W = f"WINDOW w AS (PARTITION BY {K} ORDER BY ts_ms)"
R20 = "OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


def r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


# ---- resampling ---------------------------------------------------------------------------------


def _candle_query(timeframe: str):
    ms = MS[timeframe]
    sql = f"WITH {m.TRADES_SQL}, {m.candles_sql(ms, timeframe)} SELECT * FROM candles"
    query(f"agg1_candles_{timeframe}", sql)(lambda spark, sf: ts_ms(m.candles(spark, sf, timeframe)))


for _tf in ("15m", "1h", "4h", "1d", "1w"):
    _candle_query(_tf)


@query("agg1_candles_shipments_1d", f"WITH {m.SHIPMENTS_SQL}, {m.candles_sql(MS['1d'], '1d')} SELECT {K}, ts_ms, round(open, 9) AS open, round(high, 9) AS high, round(low, 9) AS low, round(close, 9) AS close, volume FROM candles")
def agg1_shipments(spark, sf):
    return rounded(ts_ms(resample.candles_from_trades(m.shipments(spark, sf), "1d")), "open", "high", "low", "close", places=9)


@query("agg2_grid_drift", f"""{m.PLANTED_SQL} SELECT {K}, ts_ms - ts_ms % {HOUR} AS ts_ms, count(*) FILTER (ts_ms % {HOUR} <> 0) AS drifted, CASE WHEN count(*) > 1 THEN count(*) ELSE 0 END AS collided,
  max(high) AS high, min(low) AS low FROM planted GROUP BY {K}, ts_ms - ts_ms % {HOUR}""")
def agg2_grid(spark, sf):
    return ts_ms(resample.align_to_grid(m.planted(spark, sf))).select(*KEY, "ts_ms", "drifted", long("collided").alias("collided"), "high", "low")


_TARGETS = ["4h", "1d", "1w"]
_TARGET_ROWS = ", ".join(f"('{t}', {MS[t]})" for t in _TARGETS)
RESAMPLED_SQL = f"""{m.BASE_SQL}, targets(target, ms) AS (VALUES {_TARGET_ROWS}),
resampled AS (SELECT exchange, market_type, symbol, target AS timeframe, c.ts_ms - c.ts_ms % ms AS ts_ms, ms, arg_min(open, c.ts_ms) AS open, max(high) AS high, min(low) AS low, arg_max(close, c.ts_ms) AS close,
  sum(volume) AS volume, count(*) AS n_source FROM candles c, targets GROUP BY exchange, market_type, symbol, target, ms, c.ts_ms - c.ts_ms % ms)"""


@query("agg3_resample", f"{RESAMPLED_SQL} SELECT {K}, ts_ms, open, high, low, close, volume, n_source FROM resampled QUALIFY ts_ms < max(ts_ms) OVER (PARTITION BY {K})")
def agg3_resample(spark, sf):
    return ts_ms(resample.resample(m.candles(spark, sf), _TARGETS))


@query("agg3_resample_complete", f"{RESAMPLED_SQL} SELECT {K}, ts_ms, open, high, low, close, volume, n_source FROM resampled QUALIFY ts_ms < max(ts_ms) OVER (PARTITION BY {K}) OR ts_ms + ms <= {m.NOW_MS}")
def agg3_complete(spark, sf):
    return ts_ms(resample.resample(m.candles(spark, sf), _TARGETS, m.NOW_MS))


_START = m.NOW_MS - 2 * MS["1d"]
_START -= _START % MS["1d"]


@query("agg4_lookback", f"{m.BASE_SQL} SELECT * FROM candles WHERE ts_ms >= {_START} AND ts_ms < {m.NOW_MS} QUALIFY count(*) OVER (PARTITION BY {K}) >= 2")
def agg4_lookback(spark, sf):
    return ts_ms(resample.lookback(m.candles(spark, sf), "1d", m.NOW_MS))


@query("agg5_resample_summary", f"""{RESAMPLED_SQL}, kept AS (SELECT * FROM resampled QUALIFY ts_ms < max(ts_ms) OVER (PARTITION BY {K})),
  wanted AS (SELECT target AS timeframe, count(*) AS wanted FROM (SELECT DISTINCT exchange, market_type, symbol FROM candles), targets GROUP BY target),
  made AS (SELECT timeframe, count(DISTINCT (exchange, market_type, symbol)) AS made, count(*) AS rows FROM kept GROUP BY timeframe)
  SELECT timeframe, wanted, coalesce(made, 0) AS made, coalesce(rows, 0) AS rows, CASE WHEN coalesce(made, 0) = wanted THEN 'ok' WHEN coalesce(made, 0) > 0 THEN 'partial' ELSE 'failed' END AS status FROM wanted LEFT JOIN made USING (timeframe)""")
def agg5_summary(spark, sf):
    c = m.candles(spark, sf)
    wanted = c.select(*resample.SERIES).distinct().withColumn("timeframe", F.explode(F.array(*map(F.lit, _TARGETS))))
    return resample.run_summary(resample.resample(c, _TARGETS), wanted)


# ---- features -----------------------------------------------------------------------------------

_YEARLY = "CASE timeframe " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in YEARLY.items()) + " ELSE 365 END"
FEATURES_SQL = f"""{m.BASE_SQL}, f1 AS (SELECT *, ln(nullif(close, 0) / lag(nullif(close, 0)) OVER w) AS log_return, close / nullif(lag(close) OVER w, 0) - 1 AS return_1 FROM candles {W}),
f2 AS (SELECT *, CASE WHEN count(log_return) {R20} >= 5 THEN stddev_samp(log_return) {R20} END * sqrt({_YEARLY}) AS volatility_20,
  CASE WHEN count(nullif(volume, 0)) {R20} >= 5 THEN sum((high + low + close) / 3 * nullif(volume, 0)) {R20} / nullif(sum(nullif(volume, 0)) {R20}, 0) END AS vwap,
  (high - low) / nullif(close, 0) AS high_low_spread,
  (volume - CASE WHEN count(volume) {R20} >= 5 THEN avg(volume) {R20} END) / nullif(CASE WHEN count(volume) {R20} >= 5 THEN stddev_samp(volume) {R20} END, 0) AS volume_z,
  (high - low) / nullif(open, 0) AS price_range_pct, abs(close - open) / nullif(open, 0) AS body_pct, false AS is_suspect FROM f1 {W})"""
_FEATURES = [f for f in features.FEATURES if f != "is_suspect"]


@query("win11_gold_features", f"{FEATURES_SQL} SELECT {K}, ts_ms, open, high, low, close, volume, {', '.join(r(f, f) for f in _FEATURES)}, is_suspect FROM f2")
def win11_features(spark, sf):
    return rounded(ts_ms(features.gold_features(m.candles(spark, sf))), *_FEATURES)


def _feature_query(number: int, name: str):
    query(f"win{number}_{name}", f"{FEATURES_SQL} SELECT {K}, ts_ms, {r(name, name)} FROM f2")(lambda spark, sf: rounded(ts_ms(features.gold_features(m.candles(spark, sf))).select(*KEY, "ts_ms", name), name))


for _n, _name in enumerate(_FEATURES, 1):
    _feature_query(_n, _name)


@query("win9_is_suspect", f"{m.BASE_SQL} SELECT {K}, ts_ms, high = low OR volume = 0 OR coalesce(abs(ts_ms - lag(ts_ms) OVER w - {HOUR}) > 1, false) AS is_suspect FROM candles {W}")
def win9_suspect(spark, sf):
    return ts_ms(features.gold_features(silver.silver_candles(m.candles(spark, sf).withColumn("seq", F.lit(0))))).select(*KEY, "ts_ms", "is_suspect")


@query("win10_no_infinity", f"{m.BASE_SQL} SELECT {K}, ts_ms, CASE WHEN ts_ms // {HOUR} % 7 = 0 THEN NULL ELSE close END AS close FROM candles")
def win10_infinity(spark, sf):
    c = m.candles(spark, sf).withColumn("close", F.when(F.floor(F.unix_millis("timestamp") / HOUR) % 7 == 0, float("inf")).otherwise(F.col("close")))
    return ts_ms(features.sanitized(c)).select(*KEY, "ts_ms", "close")


# ---- Silver -------------------------------------------------------------------------------------

_CORRUPT = """CASE WHEN ts_ms IS NULL OR ts_ms <= 0 THEN 'C1' WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR isnan(open) OR isnan(high) OR isnan(low) OR isnan(close) OR isnan(volume) THEN 'C2'
 WHEN high < low THEN 'C3' WHEN NOT close BETWEEN low AND high THEN 'C4' WHEN NOT open BETWEEN low AND high THEN 'C5' WHEN volume < 0 THEN 'C6' END"""
CLASSIFIED_SQL = f"""{m.PLANTED_SQL}, coded AS (SELECT *, {_CORRUPT} AS corrupt FROM planted),
prev AS (SELECT *, last_value(CASE WHEN corrupt IS NULL THEN ts_ms END IGNORE NULLS) OVER (PARTITION BY {K} ORDER BY ts_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_ms FROM coded),
viol AS (SELECT *, CASE WHEN corrupt IS NOT NULL THEN corrupt ELSE concat_ws(',', CASE WHEN volume = 0 THEN 'S1' END, CASE WHEN high = low THEN 'S2' END, CASE WHEN abs(ts_ms - previous_ms - {HOUR}) > 1 THEN 'S3' END) END AS violations FROM prev),
classified AS (SELECT *, CASE WHEN corrupt IS NOT NULL THEN 'corrupt' WHEN violations <> '' THEN 'suspect' ELSE 'clean' END AS label FROM viol)"""


@query("flt1_flt4_classify", f"{CLASSIFIED_SQL} SELECT {K}, ts_ms, seq, corrupt, violations, label FROM classified")
def flt1_classify(spark, sf):
    df = ts_ms(silver.classified(m.planted(spark, sf)))
    return df.select(*KEY, "ts_ms", "seq", "corrupt", F.array_join("violations", ",").alias("violations"), "label")


@query("flt5_drop_corrupt", f"{CLASSIFIED_SQL} SELECT {K}, ts_ms, close, label AS quality_flag FROM classified WHERE label <> 'corrupt'")
def flt5_drop(spark, sf):
    return ts_ms(silver.classified(m.planted(spark, sf)).where("label != 'corrupt'")).select(*KEY, "ts_ms", "close", F.col("label").alias("quality_flag"))


@query("flt6_drop_nulls", f"{m.PLANTED_SQL} SELECT {K}, ts_ms, seq FROM planted WHERE close IS NOT NULL AND NOT isnan(volume)")
def flt6_nulls(spark, sf):
    df = features.without_nan(m.planted(spark, sf), OHLCV).dropna(subset=silver.REQUIRED)
    return ts_ms(df).select(*KEY, "ts_ms", "seq")


@query("agg7_validation_summary", f"""{CLASSIFIED_SQL} SELECT {K}, count(*) AS total, count(*) FILTER (label = 'clean') AS clean, count(*) FILTER (label = 'suspect') AS suspect, count(*) FILTER (label = 'corrupt') AS corrupt,
  round(count(*) FILTER (label = 'clean') / count(*), 6) AS quality_ratio, count(*) FILTER (label = 'corrupt') / count(*) > 0.1 AS too_corrupt FROM classified GROUP BY {K}""")
def agg7_summary(spark, sf):
    return rounded(silver.validation_summary(silver.classified(m.planted(spark, sf))), "quality_ratio")


@query("agg8_flag_counts", f"{CLASSIFIED_SQL} SELECT label AS quality_flag, count(*) AS n FROM classified GROUP BY label")
def agg8_flags(spark, sf):
    return silver.classified(m.planted(spark, sf)).groupBy(F.col("label").alias("quality_flag")).agg(F.count("*").alias("n"))


@query("flt7_silver", f"""{m.PLANTED_SQL}, clean0 AS (SELECT {K}, ts_ms, open, high, low, close, CASE WHEN isnan(volume) THEN NULL ELSE volume END AS volume, seq FROM planted),
  once AS (SELECT * FROM clean0 QUALIFY row_number() OVER (PARTITION BY {K}, ts_ms ORDER BY seq) = 1),
  grid AS (SELECT {K}, ts_ms - ts_ms % {HOUR} AS ts_ms, arg_min(open, (ts_ms, seq)) AS open, max(high) AS high, min(low) AS low, arg_max(close, (ts_ms, seq)) AS close, sum(volume) AS volume FROM once GROUP BY {K}, ts_ms - ts_ms % {HOUR}),
  coded AS (SELECT *, {_CORRUPT} AS corrupt FROM grid),
  good AS (SELECT *, abs(ts_ms - lag(ts_ms) OVER w - {HOUR}) > 1 AS jump FROM coded WHERE corrupt IS NULL {W})
  SELECT {K}, ts_ms, open, high, low, close, volume, CASE WHEN volume = 0 OR high = low OR coalesce(jump, false) THEN 'suspect' ELSE 'clean' END AS quality_flag FROM good""")
def flt7_silver(spark, sf):
    return ts_ms(silver.silver_candles(m.planted(spark, sf)))


@query("flt7_udf4_observed", f"""{m.PLANTED_SQL}, clean0 AS (SELECT * REPLACE (CASE WHEN isnan(volume) THEN NULL ELSE volume END AS volume) FROM planted), once AS (SELECT * FROM clean0 QUALIFY row_number() OVER (PARTITION BY {K}, ts_ms ORDER BY seq) = 1),
  grid AS (SELECT {K}, ts_ms - ts_ms % {HOUR} AS ts_ms, arg_min(open, (ts_ms, seq)) AS open, max(high) AS high, min(low) AS low, arg_max(close, (ts_ms, seq)) AS close, sum(volume) AS volume, count(*) FILTER (ts_ms % {HOUR} <> 0) AS drifted, count(*) AS n FROM once GROUP BY {K}, ts_ms - ts_ms % {HOUR}),
  coded AS (SELECT *, {_CORRUPT} AS corrupt FROM grid), good AS (SELECT * FROM coded WHERE corrupt IS NULL), q AS (SELECT *, abs(ts_ms - lag(ts_ms) OVER w - {HOUR}) > 1 AS jump FROM good {W})
  SELECT count(*) AS rows, sum(drifted)::BIGINT AS drifted, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS collided, count(*) FILTER (coalesce(ts_ms < 1230940800000, true)) AS before_genesis, count(*) FILTER (coalesce(open <= 0 OR high <= 0 OR low <= 0 OR close <= 0, true)) AS price_not_positive,
  count(*) FILTER (coalesce(volume < 0, true)) AS volume_negative, count(*) FILTER (coalesce(low > open OR low > close OR low > high, true)) AS low_not_lowest, count(*) FILTER (coalesce(high < open OR high < close OR high < low, true)) AS high_not_highest,
  (SELECT count(*) FROM q WHERE NOT (volume = 0 OR high = low OR coalesce(jump, false))) AS clean, (SELECT count(*) FROM q WHERE volume = 0 OR high = low OR coalesce(jump, false)) AS suspect, count(*) FILTER (corrupt IS NOT NULL) AS corrupt, (SELECT count(*) FROM good) AS added_rows FROM coded""")
def flt7_observed(spark, sf):
    """Silver into its table, with what the writing pass itself counted, next to what the log says was added."""
    lake, told = Lake(spark, new_folder(spark)), Observation("silver")
    lake.commit(silver.silver_candles(m.planted(spark, sf), told=told), "silver", 1, 1_000)
    added = lake.versions("silver").agg(F.sum("added_rows").alias("added_rows"))
    return added.select(*(F.lit(v).cast("long").alias(k) for k, v in told.get.items()), "added_rows")


@query("flt8_schema_rules", f"""{m.PLANTED_SQL}, x AS (SELECT * REPLACE (CASE WHEN isnan(volume) THEN NULL ELSE volume END AS volume), count(*) OVER (PARTITION BY {K}, ts_ms) AS same FROM planted)
  SELECT {K}, count(*) FILTER (coalesce(ts_ms < 1230940800000, true)) AS before_genesis, count(*) FILTER (coalesce(open <= 0 OR high <= 0 OR low <= 0 OR close <= 0, true)) AS price_not_positive,
  count(*) FILTER (coalesce(volume < 0, true)) AS volume_negative, count(*) FILTER (coalesce(low > open OR low > close OR low > high, true)) AS low_not_lowest, count(*) FILTER (coalesce(high < open OR high < close OR high < low, true)) AS high_not_highest,
  count(*) FILTER (same > 1) AS timestamp_repeated, count(*) FILTER (ts_ms % {HOUR} <> 0) AS off_grid FROM x GROUP BY {K}""")
def flt8_schema(spark, sf):
    return silver.schema_report(features.without_nan(m.planted(spark, sf), OHLCV))


@query("flt11_time_range", f"{m.BASE_SQL} SELECT * FROM candles WHERE ts_ms >= {_START} AND ts_ms <= {_START + MS['1d']}")
def flt11_range(spark, sf):
    return ts_ms(m.candles(spark, sf).where(F.unix_millis("timestamp").between(_START, _START + MS["1d"])))


@query("ded1_first", f"{m.PLANTED_SQL} SELECT {K}, ts_ms, seq, close FROM planted QUALIFY row_number() OVER (PARTITION BY {K}, ts_ms ORDER BY seq) = 1")
def ded1_first(spark, sf):
    return ts_ms(silver.first_by_arrival(m.planted(spark, sf))).select(*KEY, "ts_ms", "seq", "close")


@query("ded2_ded3_last", f"{m.PLANTED_SQL} SELECT {K}, ts_ms, seq, close FROM planted QUALIFY row_number() OVER (PARTITION BY {K}, ts_ms ORDER BY seq DESC) = 1")
def ded2_last(spark, sf):
    return ts_ms(silver.last_by_arrival(m.planted(spark, sf))).select(*KEY, "ts_ms", "seq", "close")


@query("ded4_trades", f"WITH {m.TRADES_SQL}, twice AS (SELECT * FROM trades UNION ALL SELECT * REPLACE (ts_ms + 5 AS ts_ms, price + 1 AS price) FROM trades WHERE trade_id % 3 = 0) SELECT exchange, symbol, trade_id, max(ts_ms) AS ts_ms, arg_max(price, ts_ms) AS price FROM twice GROUP BY ALL")
def ded4_trades(spark, sf):
    t = m.trades(spark, sf)
    again = t.where("trade_id % 3 = 0").withColumns({"timestamp": F.timestamp_millis(F.unix_millis("timestamp") + 5), "price": F.col("price") + 1})
    return ts_ms(silver.latest_trades(t.union(again).withColumn("at", F.unix_millis("timestamp")), "at")).select("exchange", "symbol", "trade_id", "ts_ms", "price")


@query("ded5_pages", f"{m.BASE_SQL} SELECT {K}, ts_ms, close + CASE WHEN ts_ms % (2 * {HOUR}) = 0 THEN 1 ELSE 0 END AS close FROM candles")
def ded5_pages(spark, sf):
    c = m.candles(spark, sf).withColumn("seq", F.lit(0))
    page = c.where(F.unix_millis("timestamp") % (2 * HOUR) == 0).withColumns({"close": F.col("close") + 1, "seq": F.lit(1)})
    return ts_ms(silver.last_by_arrival(c.unionByName(page))).select(*KEY, "ts_ms", "close")


# ---- gaps ---------------------------------------------------------------------------------------

GAPS_SQL = f"""{m.BASE_SQL}, deltas AS (SELECT {K}, lag(ts_ms) OVER w AS start_ms, ts_ms AS end_ms FROM candles {W}),
gaps AS (SELECT *, (end_ms - start_ms) // {HOUR} - 1 AS expected FROM deltas WHERE end_ms - start_ms >= 2 * {HOUR}),
told AS (SELECT *, CASE WHEN expected <= 2 THEN 'low' WHEN expected <= 10 THEN 'medium' ELSE 'high' END AS severity, end_ms - start_ms AS duration_ms FROM gaps)"""


@query("win12_gap_scan", f"{GAPS_SQL} SELECT * FROM told")
def win12_gaps(spark, sf):
    return gaps.scan_gaps(m.candles(spark, sf))


@query("win13_dq12_severity", f"{GAPS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY start_ms) AS n FROM told) SELECT {K}, severity, count(*) AS gaps FROM n WHERE n > 3 GROUP BY {K}, severity")
def win13_severity(spark, sf):
    return gaps.severity_counts(gaps.scan_gaps(m.candles(spark, sf)), 3)


def _candidates(spark, sf) -> DataFrame:
    """Every third missing candle from the other venue, as the landed second source."""
    c = m.candles(spark, sf)
    other = c.withColumn("exchange", F.when(F.col("exchange") == "ex0", "ex1").otherwise("ex0"))
    return other.withColumn("seq", F.lit(0)).where(F.floor(F.unix_millis("timestamp") / HOUR) % 3 < 2)


HEALED_SQL = f"""{GAPS_SQL}, other AS (SELECT * REPLACE (CASE WHEN exchange = 'ex0' THEN 'ex1' ELSE 'ex0' END AS exchange) FROM candles WHERE ts_ms // {HOUR} % 3 < 2),
healed AS (SELECT g.exchange, g.market_type, g.symbol, g.timeframe, start_ms, end_ms, expected, ts_ms, open, high, low, close, volume FROM gaps g JOIN other o ON g.exchange = o.exchange AND g.market_type = o.market_type AND g.symbol = o.symbol
  AND g.timeframe = o.timeframe AND o.ts_ms > g.start_ms AND o.ts_ms < g.end_ms),
outcomes AS (SELECT g.exchange, g.market_type, g.symbol, g.timeframe, g.start_ms, g.end_ms, g.expected, count(h.ts_ms) AS filled FROM gaps g LEFT JOIN healed h USING ({K}, start_ms, end_ms) GROUP BY ALL),
repaired AS (SELECT *, filled / expected AS fill_ratio, CASE WHEN expected > 43200 THEN 'skipped' WHEN filled = 0 THEN 'failed' WHEN filled / expected >= 0.95 THEN 'full' ELSE 'partial' END AS outcome FROM outcomes)"""


@query("jn6_gap_heal", f"{HEALED_SQL} SELECT * FROM healed")
def jn6_heal(spark, sf):
    return gaps.healed(gaps.scan_gaps(m.candles(spark, sf)), _candidates(spark, sf))


def _outcomes(spark, sf) -> DataFrame:
    g = gaps.scan_gaps(m.candles(spark, sf))
    return gaps.repair_outcome(g, gaps.healed(g, _candidates(spark, sf)))


@query("gap5_gap6_repair", f"{HEALED_SQL} SELECT * REPLACE (round(fill_ratio, 6) AS fill_ratio) FROM repaired")
def gap5_repair(spark, sf):
    return rounded(_outcomes(spark, sf), "fill_ratio")


@query("jn7_irrecoverable", f"{HEALED_SQL} SELECT {K}, start_ms, end_ms, outcome FROM repaired WHERE NOT expected > 5")
def jn7_irrecoverable(spark, sf):
    g = gaps.scan_gaps(m.candles(spark, sf))
    return gaps.repair_outcome(g, gaps.healed(g, _candidates(spark, sf)), g.where("expected > 5")).select(*gaps.GAP, "outcome")


@query("gap7_lifecycle", f"""{HEALED_SQL}, e AS (SELECT *, unnest(['gap_detected', CASE WHEN outcome IN ('full', 'partial') THEN 'gap_healed' WHEN outcome = 'failed' THEN 'gap_heal_failed' END]) AS event_type FROM repaired)
  SELECT exchange || ':' || symbol || ':' || timeframe || ':' || CAST(start_ms AS VARCHAR) AS event_key, event_type, expected, filled FROM e WHERE event_type IS NOT NULL""")
def gap7_lifecycle(spark, sf):
    return gaps.lifecycle(_outcomes(spark, sf))


def _registry(spark, sf) -> DataFrame:
    g = gaps.scan_gaps(m.candles(spark, sf))
    empty = gaps.register(g.where("false").select(*gaps.GAP, "expected", F.lit("").alias("status"), F.lit(0).alias("attempts"), F.lit(0).cast("long").alias("detected_ms")), g.where("expected % 2 = 0"), 1000)
    return gaps.register(empty, g, 2000)


@query("gap1_register", f"{GAPS_SQL} SELECT {K}, start_ms, end_ms, expected, 'pending' AS status, 0 AS attempts, CASE WHEN expected % 2 = 0 THEN 1000 ELSE 2000 END AS detected_ms FROM gaps")
def gap1_register(spark, sf):
    return _registry(spark, sf)


@query("gap2_gap3_resolve", f"{HEALED_SQL} SELECT {K}, start_ms, end_ms, CASE WHEN outcome = 'full' THEN 'healed' ELSE 'irrecoverable' END AS status, 1 AS attempts FROM repaired")
def gap2_resolve(spark, sf):
    return gaps.resolve(_registry(spark, sf), _outcomes(spark, sf), 1).select(*gaps.GAP, "status", "attempts")


@query("gap4_pending", f"{HEALED_SQL} SELECT exchange, count(*) AS n FROM repaired WHERE outcome <> 'full' GROUP BY exchange")
def gap4_pending(spark, sf):
    return gaps.pending(gaps.resolve(_registry(spark, sf), _outcomes(spark, sf)), 3000).groupBy("exchange").agg(F.count("*").alias("n"))


_OVERLAP = f"greatest(CASE timeframe {' '.join(f'''WHEN '{k}' THEN {v}''' for k, v in gaps.LEAST_OVERLAP.items())} ELSE 1 END, CAST(ceil(CASE exchange {' '.join(f'''WHEN '{k}' THEN {v}''' for k, v in gaps.LATENESS_MS.items())} ELSE 900000 END / ms) AS BIGINT))"
_ALL_TF = ", ".join(f"('{k}', {v})" for k, v in MS.items())


@query("gap8_overlap", f"{m.BASE_SQL}, tf(timeframe, ms) AS (VALUES {_ALL_TF}), s AS (SELECT DISTINCT CASE WHEN exchange = 'ex0' THEN 'bybit' ELSE 'kucoin' END AS exchange, symbol FROM candles) SELECT exchange, symbol, timeframe, {_OVERLAP} AS bars FROM s, tf")
def gap8_overlap(spark, sf):
    s = m.candles(spark, sf).select(F.when(F.col("exchange") == "ex0", "bybit").otherwise("kucoin").alias("exchange"), "symbol").distinct()
    s = s.withColumn("timeframe", F.explode(F.array(*map(F.lit, MS))))
    return s.select("exchange", "symbol", "timeframe", long(gaps.overlap_bars(F.col("timeframe"), F.col("exchange"))).alias("bars"))


CURSORS_SQL = f"{m.BASE_SQL}, cursors AS (SELECT {K}, CASE WHEN symbol < 'p' THEN max(ts_ms) - 5 * {HOUR} END AS cursor_ms, CASE WHEN symbol >= 's' THEN min(ts_ms) END AS start_ms FROM candles GROUP BY {K})"


def _cursors(spark, sf) -> DataFrame:
    ms = F.unix_millis("timestamp")
    return m.candles(spark, sf).groupBy(*KEY).agg(F.when(F.col("symbol") < "p", F.max(ms) - 5 * HOUR).alias("cursor_ms"), F.when(F.col("symbol") >= "s", F.min(ms)).alias("start_ms"))


@query("gap9_incremental_start", f"{CURSORS_SQL} SELECT {K}, coalesce(cursor_ms - 2 * {HOUR}, start_ms, {m.NOW_MS - 30 * 86_400_000}) AS since_ms FROM cursors")
def gap9_start(spark, sf):
    return gaps.incremental_start(_cursors(spark, sf), m.NOW_MS).select(*KEY, "since_ms")


@query("gap10_gap14_newer", f"{CURSORS_SQL} SELECT c.* FROM candles c JOIN cursors k USING ({K}) WHERE k.cursor_ms IS NULL OR c.ts_ms > k.cursor_ms")
def gap10_newer(spark, sf):
    return ts_ms(gaps.newer(m.candles(spark, sf), _cursors(spark, sf)))


@query("gap11_backfill_pages", f"""{m.BASE_SQL}, s AS (SELECT {K}, min(ts_ms) AS origin_ms, max(ts_ms) AS oldest_ms FROM candles GROUP BY {K}), p AS (SELECT *, unnest(range(CAST(ceil((oldest_ms - origin_ms) / (100 * {HOUR})) AS BIGINT))) AS page FROM s WHERE oldest_ms > origin_ms)
  SELECT {K}, page, greatest(origin_ms, oldest_ms - (page + 1) * 100 * {HOUR}) AS from_ms, oldest_ms - page * 100 * {HOUR} AS to_ms FROM p""")
def gap11_pages(spark, sf):
    ms = F.unix_millis("timestamp")
    s = m.candles(spark, sf).groupBy(*KEY).agg(F.min(ms).alias("origin_ms"), F.max(ms).alias("oldest_ms"))
    return gaps.backfill_pages(s, 100).withColumn("page", long("page"))


@query("gap12_backfill_cursor", f"{m.BASE_SQL} SELECT {K}, min(ts_ms) AS cursor_ms FROM candles GROUP BY {K}")
def gap12_cursor(spark, sf):
    c = m.candles(spark, sf).groupBy(*KEY).agg(F.min(F.unix_millis("timestamp")).alias("cursor_ms"))
    return gaps.advanced(c, c.withColumn("cursor_ms", F.col("cursor_ms") + 7), forward=False)


@query("gap13_origin", f"{m.BASE_SQL} SELECT {K}, min(ts_ms) AS first_ms, CASE WHEN min(ts_ms) > {1_704_067_200_000 + 90_000_000} - 86400000 THEN 1483228800000 ELSE min(ts_ms) END AS origin_ms FROM candles GROUP BY {K}")
def gap13_origin(spark, sf):
    return gaps.origins(m.candles(spark, sf), 1_704_067_200_000 + 90_000_000)


@query("agg18_cursor", f"{m.BASE_SQL} SELECT {K}, max(ts_ms) AS cursor_ms FROM candles GROUP BY {K}")
def agg18_cursor(spark, sf):
    c = m.candles(spark, sf).groupBy(*KEY).agg(F.max(F.unix_millis("timestamp")).alias("cursor_ms"))
    return gaps.advanced(c.withColumn("cursor_ms", F.col("cursor_ms") - 9), c)


# ---- quality ------------------------------------------------------------------------------------

_FLAT = "CASE timeframe " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in FLAT.items()) + " ELSE 0.0001 END"
Z_SQL = f"""z AS (SELECT *, coalesce(abs(close - CASE WHEN count(close) {R20} >= 10 THEN avg(close) {R20} END) / nullif(CASE WHEN count(close) {R20} >= 10 THEN stddev_samp(close) {R20} END, 0), 0) AS z, ts_ms - lag(ts_ms) OVER w AS delta FROM candles {W})"""
MAD_SQL = f"""numbered AS (SELECT *, row_number() OVER w AS i, count(close) OVER (PARTITION BY {K}) AS n FROM candles {W}),
sized AS (SELECT *, least(100, greatest(10, n // 5)) // 2 AS half FROM numbered),
meds AS (SELECT a.exchange, a.market_type, a.symbol, a.timeframe, a.ts_ms, a.close, a.n, median(b.close) AS med, list(b.close) AS vals FROM sized a JOIN sized b ON a.exchange = b.exchange AND a.market_type = b.market_type AND a.symbol = b.symbol AND a.timeframe = b.timeframe AND abs(a.i - b.i) <= a.half GROUP BY ALL),
mads AS (SELECT {K}, ts_ms, CASE WHEN n >= 5 THEN coalesce(0.6745 * abs(close - med) / nullif(list_aggregate(list_transform(vals, lambda v: abs(v - med)), 'median'), 0), 0) ELSE 0 END AS mad_score FROM meds)"""


#: Candles of which one in eleven has no close; those are in no frame.
NULLED_SQL = f"{m.BASE_SQL.replace('candles AS', 'whole AS')}, nulled AS (SELECT * REPLACE (CASE WHEN ts_ms // {HOUR} % 11 <> 0 THEN close END AS close) FROM whole), candles AS (SELECT * FROM nulled WHERE close IS NOT NULL)"


def _nulled(spark, sf) -> DataFrame:
    return m.candles(spark, sf).withColumn("close", F.when(F.floor(F.unix_millis("timestamp") / HOUR) % 11 != 0, F.col("close")))


@query("win14_zscore", f"{NULLED_SQL}, {Z_SQL} SELECT {K}, ts_ms, {r('z', 'z')} FROM z UNION ALL SELECT {K}, ts_ms, 0 FROM nulled WHERE close IS NULL")
def win14_zscore(spark, sf):
    return rounded(ts_ms(quality.with_zscore(_nulled(spark, sf))).select(*KEY, "ts_ms", "z"), "z")


@query("win15_mad", f"{NULLED_SQL}, {MAD_SQL} SELECT {K}, ts_ms, round(mad_score, 9) AS mad_score FROM mads UNION ALL SELECT {K}, ts_ms, 0 FROM nulled WHERE close IS NULL")
def win15_mad(spark, sf):
    return rounded(ts_ms(quality.with_mad(_nulled(spark, sf))).select(*KEY, "ts_ms", "mad_score"), "mad_score", places=9)


_LATE = m.NOW_MS - 20 * 86_400_000
CHECKS_SQL = f"""{m.BASE_SQL}, {Z_SQL}, {MAD_SQL}, checks AS (SELECT {', '.join('z.' + c for c in KEY)}, count(*) AS rows, count(*) FILTER (z.ts_ms > {_LATE}) AS future, count(*) FILTER (delta > 1.5 * {HOUR}) AS gaps,
  coalesce(CAST(floor(sum(delta / {HOUR} - 1) FILTER (delta > 1.5 * {HOUR})) AS BIGINT), 0) AS missing_bars, coalesce(max(delta) FILTER (delta > 1.5 * {HOUR}) / 1000, 0.0) AS largest_gap_s,
  count(*) FILTER (high < low) + count(*) FILTER (close > high) + count(*) FILTER (close < low) + count(*) FILTER (open > high) + count(*) FILTER (open < low) AS inconsistent,
  count(*) FILTER (mad_score > 3.5) AS mad_outliers, max(mad_score) AS max_mad, CASE WHEN count(close) > 20 THEN count(*) FILTER (z > 4) ELSE 0 END AS z_outliers, max(z) AS max_z, count(*) FILTER (high - low < close * {_FLAT}) AS flat
  FROM z JOIN mads USING ({K}, ts_ms) GROUP BY ALL)"""


@query("dq1_dq7_checks", f"{CHECKS_SQL} SELECT * REPLACE (round(max_mad, 6) AS max_mad, round(max_z, 6) AS max_z) FROM checks")
def dq1_checks(spark, sf):
    return rounded(quality.checks(m.candles(spark, sf), _LATE), "max_mad", "max_z")


ISSUES_SQL = f"""{CHECKS_SQL}, issues AS (SELECT * FROM (
  SELECT {K}, rows, 'future_timestamps' AS "check", 'critical' AS severity, future AS affected FROM checks UNION ALL SELECT {K}, rows, 'temporal_gaps', CASE WHEN gaps / rows >= 0.05 THEN 'critical' ELSE 'warning' END, gaps FROM checks UNION ALL
  SELECT {K}, rows, 'ohlc_inconsistencies', 'critical', inconsistent FROM checks UNION ALL SELECT {K}, rows, 'price_outliers_mad', 'warning', mad_outliers FROM checks UNION ALL
  SELECT {K}, rows, 'price_outliers_zscore', 'warning', z_outliers FROM checks UNION ALL SELECT {K}, rows, 'flatline_candles', 'warning', flat FROM checks) WHERE affected > 0),
weights("check", weight) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in quality.WEIGHTS.items())}),
scored AS (SELECT c.exchange, c.market_type, c.symbol, c.timeframe, c.rows, greatest(0, 100 - coalesce(sum(weight * affected / c.rows * CASE WHEN severity = 'critical' THEN 2 ELSE 1 END * 100), 0)) AS score,
  coalesce(sum(affected) FILTER (severity = 'critical') / c.rows, 0) AS share, coalesce(string_agg("check" || '(' || severity || '): ' || CAST(affected AS VARCHAR) || ' rows', '; ' ORDER BY "check"), '') AS reasons
  FROM checks c LEFT JOIN issues i USING ({K}) LEFT JOIN weights USING ("check") GROUP BY c.exchange, c.market_type, c.symbol, c.timeframe, c.rows),
decided AS (SELECT *, CASE WHEN score < 40 OR share > 0.1 THEN 'reject' WHEN score < 99 THEN 'accept_with_flags' ELSE 'accept' END AS decision FROM scored)"""


def _checked(spark, sf) -> DataFrame:
    return quality.checks(m.candles(spark, sf), _LATE)


@query("dq16_issues", f"{ISSUES_SQL} SELECT * FROM issues")
def dq16_issues(spark, sf):
    return quality.issues(_checked(spark, sf))


@query("dq8_dq10_decisions", f"{ISSUES_SQL} SELECT {K}, rows, round(score, 6) AS score, decision, CASE decision WHEN 'reject' THEN 'rejected' WHEN 'accept' THEN 'clean' ELSE 'flagged' END AS tier, reasons FROM decided")
def dq8_decisions(spark, sf):
    return rounded(quality.decisions(_checked(spark, sf)), "score").withColumn("reasons", F.array_join("reasons", "; "))


#: The same of candles of every grade.
GRADED_ISSUES_SQL = ISSUES_SQL.replace(m.BASE_SQL, m.GRADED_SQL).replace(str(_LATE), str(m.NOW_MS))


@query("dq8_dq11_grades", f"{GRADED_ISSUES_SQL} SELECT {K}, rows, round(score, 6) AS score, decision, CASE decision WHEN 'reject' THEN 'rejected' WHEN 'accept' THEN 'clean' ELSE 'flagged' END AS tier, reasons FROM decided")
def dq8_grades(spark, sf):
    """Series of which some are clean, some flagged and some rejected."""
    found = quality.checks(m.graded(spark, sf), m.NOW_MS)
    return rounded(quality.decisions(found), "score").withColumn("reasons", F.array_join("reasons", "; "))


_DAILY_SQL = ISSUES_SQL.replace(str(_LATE), str(m.NOW_MS)).replace(str(HOUR), str(MS["1d"])).replace("'1h' AS timeframe", "'1d' AS timeframe")


@query("dq11_tiers", f"{_DAILY_SQL} SELECT c.*, CASE decision WHEN 'accept' THEN 'clean' ELSE 'flagged' END AS tier FROM candles c JOIN decided d USING ({K}) WHERE d.decision <> 'reject'")
def dq11_tiers(spark, sf):
    c = m.candles(spark, sf, "1d")
    found = quality.checks(c, m.NOW_MS)
    return ts_ms(quality.accepted(c, quality.decisions(found)))


@query("dq14_dq15_expectations", f"""{m.PLANTED_SQL}, x AS (SELECT * REPLACE (CASE WHEN isnan(volume) THEN NULL ELSE volume END AS volume), count(*) OVER (PARTITION BY {K}, ts_ms) AS same, ts_ms - lag(ts_ms) OVER (PARTITION BY {K} ORDER BY seq, ts_ms) AS delta FROM planted),
  e AS (SELECT {K}, count(*) AS rows, unnest([{{'expectation': 'close_not_null', 'severity': 'critical', 'unexpected': count(*) FILTER (close IS NULL)}}, {{'expectation': 'open_not_null', 'severity': 'critical', 'unexpected': count(*) FILTER (open IS NULL)}},
  {{'expectation': 'prices_positive', 'severity': 'critical', 'unexpected': count(*) FILTER (NOT (open > 0 AND high > 0 AND low > 0 AND close > 0))}}, {{'expectation': 'high_ge_low', 'severity': 'critical', 'unexpected': count(*) FILTER (high < low)}},
  {{'expectation': 'high_ge_open', 'severity': 'critical', 'unexpected': count(*) FILTER (high < open)}}, {{'expectation': 'high_ge_close', 'severity': 'critical', 'unexpected': count(*) FILTER (high < close)}},
  {{'expectation': 'open_ge_low', 'severity': 'critical', 'unexpected': count(*) FILTER (open < low)}}, {{'expectation': 'close_ge_low', 'severity': 'critical', 'unexpected': count(*) FILTER (close < low)}},
  {{'expectation': 'volume_not_negative', 'severity': 'critical', 'unexpected': count(*) FILTER (volume < 0)}}, {{'expectation': 'timestamp_unique', 'severity': 'critical', 'unexpected': count(*) FILTER (same > 1)}},
  {{'expectation': 'timestamp_increasing', 'severity': 'warning', 'unexpected': count(*) FILTER (delta <= 0)}}]) AS e FROM x GROUP BY {K})
  SELECT {K}, rows, e.expectation, e.severity, e.unexpected, e.unexpected = 0 AS success FROM e""")
def dq14_expectations(spark, sf):
    return quality.expectations(features.without_nan(m.planted(spark, sf), OHLCV))


@query("dq2_empty_series", f"{ISSUES_SQL}, wanted AS (SELECT DISTINCT exchange, market_type, symbol, timeframe FROM candles UNION ALL SELECT 'ex9', 'spot', 'none', '1h' UNION ALL SELECT 'ex9', 'spot', 'nothing', '1h') SELECT {K}, coalesce(rows, 0) AS rows, CASE WHEN rows IS NULL THEN 'reject' ELSE decision END AS decision, CASE WHEN rows IS NULL THEN 'empty_dataset(critical): 1 rows' ELSE reasons END AS reasons FROM wanted LEFT JOIN decided USING ({K})")
def dq2_empty(spark, sf):
    """Two of the expected series have no candle."""
    wanted = m.candles(spark, sf).select(*KEY).union(spark.createDataFrame([("ex9", "spot", "none", "1h"), ("ex9", "spot", "nothing", "1h")], "exchange string, market_type string, symbol string, timeframe string"))
    return quality.decisions(quality.with_expected(_checked(spark, sf), wanted)).select(*KEY, "rows", "decision", F.array_join("reasons", "; ").alias("reasons"))


@query("dq14_table", f"{m.BASE_SQL}, n AS (SELECT count(*) AS n FROM candles) SELECT * FROM (SELECT unnest(['timestamp', 'open', 'high', 'low', 'close', 'volume']) AS c), LATERAL (SELECT 'column_exists:' || c AS expectation, 'critical' AS severity, c <> 'low' AS success UNION ALL SELECT 'type_double:' || c, 'warning', c NOT IN ('low', 'volume') WHERE c <> 'timestamp') UNION ALL SELECT '', 'row_count_positive', 'warning', n > 0 FROM n".replace("SELECT * FROM (SELECT unnest", "SELECT expectation, severity, success FROM (SELECT unnest").replace("UNION ALL SELECT '', 'row", "UNION ALL SELECT 'row"))
def dq14_table(spark, sf):
    """Candles without a low, and with the volume as text."""
    return quality.table_expectations(m.candles(spark, sf).drop("low").withColumn("volume", F.col("volume").cast("string")))


@query("dq15_degraded", f"{m.PLANTED_SQL}, x AS (SELECT *, count(*) OVER (PARTITION BY {K}, ts_ms) AS same FROM planted), i AS (SELECT {K}, count(*) AS rows, unnest(['high_ge_low', 'close_not_null', 'timestamp_unique']) AS \"check\", 'critical' AS severity, unnest([count(*) FILTER (high < low), count(*) FILTER (close IS NULL), count(*) FILTER (same > 1)]) AS affected FROM x GROUP BY {K}) SELECT * FROM i WHERE affected > 0 UNION ALL SELECT {K}, count(*), 'expectations_failed', 'warning', count(*) FROM planted GROUP BY {K}")
def dq15_degraded(spark, sf):
    """The issues of three expectations, and the degraded report of candles that lack a column."""
    rules = {"high_ge_low": ("high < low", "critical"), "close_not_null": ("close IS NULL", "critical"), "timestamp_unique": ("_same > 1", "critical")}
    p = m.planted(spark, sf)
    return quality.judged_expectations(p, rules).union(quality.judged_expectations(p.drop("high"), rules))


@query("flt8_order_and_extra", f"{m.PLANTED_SQL}, x AS (SELECT *, ts_ms <= lag(ts_ms) OVER (PARTITION BY {K} ORDER BY seq, close, ts_ms) AS back FROM planted WHERE close IS NOT NULL) SELECT {K}, count(*) FILTER (back) AS not_increasing, 2 AS extra_columns FROM x GROUP BY {K}")
def flt8_order(spark, sf):
    """Candles in an order of arrival that is not that of time, with two columns too many."""
    p = m.planted(spark, sf).where("close IS NOT NULL").withColumn("arrival", F.struct("seq", "close", F.unix_millis("timestamp").alias("t"))).withColumn("odd", F.lit(1))
    extra = silver.extra_columns(p.drop("seq"))
    return silver.order_report(p, "arrival").withColumn("extra_columns", F.lit(len(extra)).cast("long"))


@query("flt10_assertions", f"{m.BASE_SQL} SELECT {K}, count(*) AS rows FROM candles GROUP BY {K}")
def flt10_assertions(spark, sf):
    """Candles pass; the same with times without a zone, and none at all, do not."""
    c = m.candles(spark, sf)
    for bad, error in ((lambda: rules.assert_utc(c.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))), TypeError), (lambda: rules.assert_non_empty(c.limit(0)), ValueError)):
        try:
            bad()
        except error:
            continue
        raise AssertionError("an assertion let a bad table pass")
    return rules.assert_non_empty(rules.assert_utc(c)).groupBy(*KEY).agg(F.count("*").alias("rows"))


@query("prj9_silver_frame", f"{m.BASE_SQL}, x AS (SELECT *, lag(ts_ms) OVER (PARTITION BY {K} ORDER BY ts_ms) AS before FROM candles WHERE ts_ms // {HOUR} % 10 <> 0) SELECT {K}, ts_ms, open, high, low, close, volume, CASE WHEN volume = 0 OR high = low OR abs(ts_ms - before - {HOUR}) > 1 THEN 'suspect' ELSE 'clean' END AS quality_flag FROM x")
def prj9_frame(spark, sf):
    """Landed candle lists, of which one in ten has a high below its low, to labelled Silver rows."""
    bad = F.floor(F.unix_millis("timestamp") / HOUR) % 10 == 0
    row = F.array(F.unix_millis("timestamp").cast("double"), "open", F.when(bad, F.col("low") - 1).otherwise(F.col("high")), "low", "close", "volume")
    raw = m.candles(spark, sf).groupBy(*KEY, F.to_date("timestamp").alias("day")).agg(F.to_json(F.collect_list(row)).alias("value"))
    return ts_ms(silver.labelled(landed.raw_candles(raw, keep=KEY)))


@query("snk1_bronze_append", f"{m.BASE_SQL} SELECT {K}, ts_ms, close, true AS stamped FROM candles")
def snk1_bronze(spark, sf):
    """Candles without identity but for their symbol and venue land in Bronze with it, and with their time of arrival."""
    lake = Lake(spark, new_folder(spark))
    silver.append_bronze(lake, m.candles(spark, sf).drop("market_type", "timeframe"), 1, m.NOW_MS, market_type="spot", timeframe="1h")
    df = lake.candles("bronze")
    return ts_ms(df).select(*KEY, "ts_ms", "close", (F.unix_millis("ingestion_ts") == m.NOW_MS).alias("stamped"))


@query("snk4_build_all", f"{m.BASE_SQL}, n AS (SELECT {K}, count(*) AS rows FROM candles GROUP BY {K}) SELECT exchange, count(*) AS done, 1 AS failed, sum(rows) AS rows FROM n GROUP BY exchange")
def snk4_build(spark, sf):
    """Gold of all series in one job; of each venue one expected series has no candle, so it fails."""
    c, lake = m.candles(spark, sf), Lake(spark, new_folder(spark))
    wanted = c.select(*KEY).distinct()
    wanted = wanted.union(wanted.select("exchange", "market_type", F.lit("nothing").alias("symbol"), "timeframe").distinct())
    told = features.build_all(lake, c, wanted, 1, m.NOW_MS, "r1", "v1")
    return told.groupBy("exchange").agg(F.count_if("done").alias("done"), F.count_if(~F.col("done")).alias("failed"), F.sum("rows").alias("rows"))


# ---- two venues ---------------------------------------------------------------------------------

VENUES_SQL = f"""{m.BASE_SQL}, a AS (SELECT symbol, timeframe, ts_ms - ts_ms % 60000 AS minute, * EXCLUDE (symbol, timeframe) FROM candles WHERE exchange = 'ex0'), b AS (SELECT symbol, timeframe, ts_ms - ts_ms % 60000 AS minute, * EXCLUDE (symbol, timeframe) FROM candles WHERE exchange = 'ex1'),
j AS (SELECT symbol, timeframe, abs((a.high + a.low) / 2 - (b.high + b.low) / 2) / (((a.high + a.low) / 2 + (b.high + b.low) / 2) / 2) AS price, abs(a.volume - b.volume) / ((a.volume + b.volume) / 2) AS volume FROM a JOIN b USING (symbol, timeframe, minute)),
g AS (SELECT symbol, timeframe, count(*) AS common, count(*) FILTER (price > 0.005) AS price_diverges, max(price) AS max_price_gap, count(*) FILTER (volume > 0.5) AS volume_diverges FROM j GROUP BY ALL),
s AS (SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.timeframe, b.timeframe) AS timeframe, count(*) FILTER (b.minute IS NULL) AS only_a, count(*) FILTER (a.minute IS NULL) AS only_b FROM a FULL JOIN b ON a.symbol = b.symbol AND a.timeframe = b.timeframe AND a.minute = b.minute GROUP BY ALL)"""


@query("jn1_align", f"{VENUES_SQL} SELECT symbol, timeframe, minute AS ts_ms, a.close AS close_a, b.close AS close_b FROM a JOIN b USING (symbol, timeframe, minute)")
def jn1_align(spark, sf):
    c = m.candles(spark, sf)
    return ts_ms(quality.aligned(c.where("exchange = 'ex0'"), c.where("exchange = 'ex1'")), "minute").select("symbol", "timeframe", "ts_ms", "close_a", "close_b")


@query("jn2_jn5_dq17_venues", f"""{VENUES_SQL} SELECT symbol, timeframe, only_a, only_b, common, price_diverges, round(max_price_gap, 6) AS max_price_gap, volume_diverges, CASE WHEN common < 10 THEN 'no_overlap' WHEN price_diverges / common > 0.05 THEN 'critical'
  WHEN price_diverges + volume_diverges + only_a + only_b > 0 THEN 'warning' ELSE 'clean' END AS verdict FROM s JOIN g USING (symbol, timeframe)""")
def jn2_venues(spark, sf):
    c = m.candles(spark, sf)
    return rounded(quality.venue_report(c.where("exchange = 'ex0'"), c.where("exchange = 'ex1'")), "max_price_gap")


_GRADED_A = "SELECT symbol, timeframe, ts_ms - ts_ms % 60000 AS minute, * EXCLUDE (symbol, timeframe) FROM candles WHERE exchange = 'ex0'"
_GRADED_B = f"SELECT * REPLACE (high * CASE WHEN symbol = 'error' AND ts_ms // {HOUR} % 3 = 0 THEN 1.02 ELSE 1 END AS high, volume * CASE WHEN symbol = 'signup' AND ts_ms // {HOUR} % 9 = 0 THEN 5 ELSE 1 END AS volume) FROM a WHERE NOT (symbol = 'view' AND ts_ms // {HOUR} % 10 = 0) AND (symbol <> 'purchase' OR ts_ms // {HOUR} % 200 = 1)"
_VENUE_TAIL = VENUES_SQL[VENUES_SQL.index("j AS (SELECT symbol") :]


@query("jn2_dq17_verdicts", f"""{m.GRADED_SQL}, a AS ({_GRADED_A}), b AS ({_GRADED_B}), {_VENUE_TAIL} SELECT symbol, timeframe, only_a, only_b, coalesce(common, 0) AS common, coalesce(price_diverges, 0) AS price_diverges, round(max_price_gap, 6) AS max_price_gap, coalesce(volume_diverges, 0) AS volume_diverges,
  CASE WHEN coalesce(common, 0) < 10 THEN 'no_overlap' WHEN price_diverges / common > 0.05 THEN 'critical' WHEN price_diverges + volume_diverges + only_a + only_b > 0 THEN 'warning' ELSE 'clean' END AS verdict FROM s LEFT JOIN g USING (symbol, timeframe)""")
def jn2_verdicts(spark, sf):
    """Two venues that agree in one symbol, differ in the price of another and the volume of a third, and lack minutes of two more, one nearly all."""
    a = m.graded(spark, sf).where("exchange = 'ex0'")
    h, of = F.floor(F.unix_millis("timestamp") / F.lit(HOUR)), F.col("symbol")
    b = a.where(~((of == "view") & (h % 10 == 0)) & ((of != "purchase") | (h % 200 == 1)))
    b = b.withColumns({"high": F.col("high") * F.when((of == "error") & (h % 3 == 0), 1.02).otherwise(1.0), "volume": F.col("volume") * F.when((of == "signup") & (h % 9 == 0), 5.0).otherwise(1.0)})
    return rounded(quality.venue_report(a, b), "max_price_gap")
