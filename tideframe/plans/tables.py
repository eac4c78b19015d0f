"""Queries of landed data, keys, versions, registries, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.functions.timeframes import MS, lookup, ms_of
from tideframe.operators import features, registry
from tideframe.operators.resample import KEY
from tideframe.plans.core import HOUR, K, r
from tideframe.plans.register import long, query, rounded, ts_ms
from tideframe.sources import landed
from tideframe.sources import mappings as m
from tideframe.sources.snapshots import Lake, gold_rows, new_folder, removed

_T = f"WITH {m.TRADES_SQL}"
_C = m.BASE_SQL


def _events(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def trade_messages(spark, sf) -> DataFrame:
    """Trades as wire events; some of a wrong version, an unknown source, or no JSON at all."""
    t = m.trades(spark, sf)
    i = F.col("trade_id")
    body = F.to_json(F.struct(F.concat(F.lit("e"), i.cast("string")).alias("event_id"), F.when(i % 19 == 0, 2).otherwise(1).alias("event_version"), F.when(i % 17 == 0, "rumour").otherwise("live").alias("source"), F.lit("r1").alias("run_id"), "exchange", "symbol", "market_type", i.cast("string").alias("trade_id"), F.unix_millis("timestamp").alias("timestamp_ms"), F.when(i % 23 == 0, "n/a").otherwise(F.col("price").cast("string")).alias("price"), F.col("amount").cast("string").alias("amount"), F.upper("side").alias("side")))
    return t.select(F.when(i % 29 == 0, F.lit("{broken")).otherwise(body).alias("value"))


_REJECT = "CASE WHEN trade_id % 29 = 0 THEN 'undecodable' WHEN trade_id % 19 = 0 THEN 'bad_version' WHEN trade_id % 17 = 0 THEN 'bad_source' END"


@query("src10_src17_trade_events", f"{_T} SELECT CAST(trade_id AS VARCHAR) AS trade_id, price, amount, side, ts_ms AS timestamp_ms FROM trades WHERE {_REJECT} IS NULL AND trade_id % 23 <> 0 AND price > 0")
def src10_trades(spark, sf):
    df = landed.exact_trades(landed.parsed(trade_messages(spark, sf), "trade"))
    return df.select("trade_id", F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"), "side", "timestamp_ms")


@query("flt19_snk14_dead_letters", f"{_T} SELECT {_REJECT} AS reject_reason, count(*) AS n FROM trades WHERE {_REJECT} IS NOT NULL GROUP BY ALL")
def flt19_rejects(spark, sf):
    return landed.parsed(trade_messages(spark, sf), "trade").where("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count("*").alias("n"))


@query("src9_snk8_snk13_candle_events", f"{_C} SELECT exchange, symbol, timeframe, ts_ms, open, high, low, close, volume FROM candles")
def src9_candles(spark, sf):
    sent = landed.candle_messages(m.candles(spark, sf), "r1")
    got = landed.exploded_bars(landed.parsed(sent, "ohlcv"))
    return ts_ms(got).select("exchange", "symbol", "timeframe", "ts_ms", "open", "high", "low", "close", "volume")


@query("snk12_keys", f"{_T} SELECT DISTINCT exchange || ':' || symbol || ':1h' AS ohlcv_key, symbol AS symbol_key, 'src:price:' || CASE WHEN symbol < 'p' THEN symbol ELSE 'global' END AS external_key FROM trades")
def snk12_keys(spark, sf):
    t = m.trades(spark, sf).withColumns({"source_id": F.lit("src"), "metric": F.lit("price"), "s": F.col("symbol")})
    t = t.withColumn("symbol", F.when(F.col("s") < "p", F.col("s")))
    return t.select(landed.routing_key("exchange", "s", F.lit("1h")).alias("ohlcv_key"), landed.routing_key("s").alias("symbol_key"), landed.external_key().alias("external_key")).distinct()


@query("src15_raw_candles", f"{_C} SELECT ts_ms, open, close, volume FROM candles")
def src15_raw(spark, sf):
    row = F.array(F.unix_millis("timestamp").cast("double"), "open", "high", "low", "close", "volume")
    raw = m.candles(spark, sf).groupBy("symbol", F.to_date("timestamp").alias("day")).agg(F.to_json(F.collect_list(row)).alias("value"))  # a list for each day
    return ts_ms(landed.raw_candles(raw)).select("ts_ms", "open", "close", "volume")


@query("src16_raw_trades", f"{_T} SELECT CAST(trade_id AS VARCHAR) AS id, ts_ms AS timestamp, {r('CASE WHEN trade_id % 2 = 0 THEN 1.5 ELSE price * amount END', 'cost')} FROM trades WHERE trade_id % 7 <> 0")
def src16_raw(spark, sf):
    i = F.col("trade_id")
    raw = m.trades(spark, sf).select(F.to_json(F.struct(F.when(i % 7 != 0, i.cast("string")).alias("id"), F.unix_millis("timestamp").alias("timestamp"), "price", "amount", F.when(i % 2 == 0, 1.5).alias("cost"), "side")).alias("value"))
    return rounded(landed.raw_trades(raw).select("id", "timestamp", "cost"), "cost")


@query("src18_prj8_funding", f"{_T} SELECT symbol, ts_ms AS timestamp, price AS value_float FROM trades WHERE trade_id % 9 <> 0")
def src18_funding(spark, sf):
    raw = m.trades(spark, sf).select(F.to_json(F.struct("symbol", F.unix_millis("timestamp").alias("timestamp"), F.when(F.col("trade_id") % 9 != 0, F.col("price")).alias("rate"))).alias("value"))
    return landed.raw_derivatives(raw, "rate")


@query("src13_eav", f"{_T} SELECT symbol, ts_ms, unnest(['price', 'amount']) AS metric, unnest([price, amount]) AS value FROM trades")
def src13_eav(spark, sf):
    return ts_ms(m.trades(spark, sf)).unpivot(["symbol", "ts_ms"], ["price", "amount"], "metric", "value")


@query("prj17_prj19_external", f"{_T} SELECT 'coinglass' AS source_id, 'funding' AS metric, upper(symbol) || '/USDT' AS symbol, ts_ms + trade_id % 2 AS timestamp_ms, CAST(trade_id AS VARCHAR) AS value FROM trades WHERE trade_id % 11 <> 0")
def prj17_external(spark, sf):
    i = F.col("trade_id")
    raw = m.trades(spark, sf).select(F.to_json(F.struct(F.concat(F.upper("symbol"), F.lit("-USDT-PERP")).alias("symbol"), F.when(i % 11 != 0, i.cast("string")).alias("rate"), F.when(i % 2 == 0, F.unix_millis("timestamp").cast("string")).alias("updateTime"), (F.unix_millis("timestamp") + 1).cast("string").alias("createdTime"))).alias("value"))
    return landed.NORMALISERS["coinglass"](raw, "coinglass", "funding", "rate")


@query("prj20_global_metrics", "SELECT 'coinmarketcap' AS source_id, event_id AS timestamp_ms, unnest(['cap', 'volume']) AS metric, unnest([CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR)]) AS value FROM events")
def prj20_metrics(spark, sf):
    raw = _events(spark, sf).select("event_id", F.to_json(F.struct(F.col("user_id").alias("cap"), F.col("event_id").alias("volume"), F.struct(F.lit(1).alias("usd")).alias("quote"))).alias("value"))
    return landed.NORMALISERS["coinmarketcap"](raw, "coinmarketcap", "event_id")


@query("src_props_json", "SELECT event_id, length(props) > 0 AS has_props FROM events")
def src_props(spark, sf):
    return _events(spark, sf).select("event_id", (F.size(F.from_json("props", "map<string,string>")) > 0).alias("has_props"))


@query("prj30_order_states", "SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'submitted' ELSE 'cancelled' END AS state, o_totalprice AS avg_price, CASE o_orderkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 5.0 END AS fee FROM orders")
def prj30_orders(spark, sf):
    o, k = spark.read.parquet(f"{sf}/orders.parquet"), F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "O", "open").otherwise("canceled")
    cost = lambda x: F.struct(F.lit(x).alias("cost"))
    raw = o.select(F.to_json(F.struct(k.cast("string").alias("id"), status.alias("status"), F.col("o_totalprice").alias("average"), F.when(k % 3 == 0, cost(1.0)).alias("fee"), F.when(k % 3 == 1, F.array(cost(2.0), cost(3.0))).alias("fees"))).alias("value"))
    return landed.order_states(raw).select("id", "state", "avg_price", "fee")


@query("prj16_prj27_symbols", f"{_T} SELECT DISTINCT symbol, CASE WHEN symbol < 's' THEN upper(symbol) || '/USDT' END AS canonical, rtrim(replace(replace(to_base64(encode('binance:' || symbol || '?>')), '+', '-'), '/', '_'), '=') AS segment, true AS round_trip FROM trades")
def prj16_symbols(spark, sf):
    s = m.trades(spark, sf).select("symbol").distinct()
    key = F.concat(F.lit("binance:"), F.col("symbol"), F.lit("?>"))
    return s.select("symbol", landed.symbol_parts(F.concat(F.lit(" "), F.col("symbol"), F.when(F.col("symbol") < "s", "/usdt").otherwise("usdt"))).alias("canonical"), landed.encoded_segment(key).alias("segment"), (landed.decoded_segment(landed.encoded_segment(key)) == key).alias("round_trip"))


@query("prj23_prj25_timeframes", f"{_C}, t AS (SELECT timeframe, count(*) AS n FROM candles GROUP BY timeframe) SELECT timeframe, {HOUR} AS ms, 8760 AS yearly, n FROM t")
def prj23_timeframes(spark, sf):
    from tideframe.functions.timeframes import YEARLY, YEARLY_DEFAULT

    c = m.candles(spark, sf).groupBy("timeframe").agg(F.count("*").alias("n"))
    return c.select("timeframe", ms_of(F.col("timeframe")).alias("ms"), lookup(YEARLY, F.col("timeframe"), YEARLY_DEFAULT).alias("yearly"), "n")


@query("prj28_errors", "SELECT event_id, event_id % 4 <> 3 AND event_id % 4 <> 2 AS transient FROM events")
def prj28_errors(spark, sf):
    i = (F.col("event_id") % 4 + 1).cast("int")
    kind = F.element_at(F.array(F.lit("TimeoutError"), F.lit("ValueError"), F.lit("KeyError"), F.lit("ValueError")), i)
    text = F.element_at(F.array(F.lit(""), F.lit("HTTP 429 Too Many"), F.lit("no such symbol"), F.lit(None).cast("string")), i)
    return _events(spark, sf).select("event_id", landed.is_transient(kind, text).alias("transient"))


@query("flt13_live_only", f"{_T} SELECT count(*) AS n FROM trades WHERE trade_id % 17 <> 0 AND trade_id % 19 <> 0 AND trade_id % 29 <> 0")
def flt13_live(spark, sf):
    return landed.parsed(trade_messages(spark, sf), "trade").where("reject_reason IS NULL AND source = 'live'").agg(F.count("*").alias("n"))


@query("ded7_event_ids", "SELECT event_id FROM events WHERE event_id % 4 <> 0")
def ded7_ids(spark, sf):
    e = _events(spark, sf).select("event_id")
    return e.union(e.where("event_id % 3 = 0")).dropDuplicates(["event_id"]).join(e.where("event_id % 4 = 0"), "event_id", "left_anti")


# ---- sorts and sets -------------------------------------------------------------------------------


@query("srt2_src8_last_n", f"{_C} SELECT {K}, ts_ms, close FROM candles QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY ts_ms DESC) <= 5")
def srt2_last(spark, sf):
    n = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("timestamp")))
    return ts_ms(m.candles(spark, sf).withColumn("n", n).where("n <= 5")).select(*KEY, "ts_ms", "close")


@query("srt4_top_anomalies", f"{_C}, a AS (SELECT exchange, symbol, timeframe, CASE WHEN volume < 3 THEN 'thin' WHEN volume > 20 THEN 'heavy' ELSE 'normal' END AS reason, ts_ms FROM candles), g AS (SELECT exchange, symbol, timeframe, reason, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, count(*) AS n FROM a GROUP BY ALL) SELECT * FROM g ORDER BY n DESC, exchange, symbol, reason LIMIT 8")
def srt4_top(spark, sf):
    return registry.anomaly_counts(_anomalies(spark, sf)).orderBy(F.desc("n"), "exchange", "symbol", "reason").limit(8)


def _anomalies(spark, sf) -> DataFrame:
    v = F.col("volume")
    return ts_ms(m.candles(spark, sf)).select("exchange", "symbol", "timeframe", F.when(v < 3, "thin").when(v > 20, "heavy").otherwise("normal").alias("reason"), "ts_ms")


_SETS = f"{_C}, a AS (SELECT symbol, ts_ms FROM candles WHERE exchange = 'ex0'), b AS (SELECT symbol, ts_ms FROM candles WHERE exchange = 'ex1')"


def _sides(spark, sf):
    c = ts_ms(m.candles(spark, sf))
    return c.where("exchange = 'ex0'").select("symbol", "ts_ms"), c.where("exchange = 'ex1'").select("symbol", "ts_ms")


@query("set1_union", f"{_SETS} SELECT * FROM a UNION ALL SELECT * FROM b")
def set1_union(spark, sf):
    a, b = _sides(spark, sf)
    return a.unionByName(b)


@query("set2_jn5_intersect", f"{_SETS} SELECT * FROM a INTERSECT SELECT * FROM b")
def set2_intersect(spark, sf):
    a, b = _sides(spark, sf)
    return a.intersect(b)


@query("set3_jn4_difference", f"{_SETS} SELECT 'a' AS only, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def set3_difference(spark, sf):
    a, b = _sides(spark, sf)
    return a.subtract(b).select(F.lit("a").alias("only"), "*").union(b.subtract(a).select(F.lit("b").alias("only"), "*"))


@query("set4_key_union", f"{_SETS} SELECT * FROM a UNION SELECT * FROM b")
def set4_keys(spark, sf):
    a, b = _sides(spark, sf)
    return a.join(b, ["symbol", "ts_ms"], "full").distinct()


# ---- registries -----------------------------------------------------------------------------------

_RESULTS = f"{_C}, results AS (SELECT 'run' || CAST(ts_ms // 86400000 % 5 AS VARCHAR) AS run_id, CASE WHEN ts_ms // {HOUR} % 50 = 0 THEN 'boom' END AS error, ts_ms // {HOUR} % 50 = 1 AS skipped, CAST(volume AS BIGINT) AS rows, CAST(ts_ms // {HOUR} % 3 AS BIGINT) AS gaps_found, ts_ms // {HOUR} % 2 AS gaps_healed, 1000 + ts_ms // {HOUR} % 100 AS duration_ms FROM candles)"


@query("agg9_run_summary", f"{_RESULTS} SELECT run_id, count(*) AS total, count(*) FILTER (error IS NULL AND NOT skipped) AS succeeded, count(*) FILTER (skipped) AS skipped, count(error) AS failed, sum(rows) AS rows, sum(gaps_found) AS gaps_found, sum(gaps_healed) AS gaps_healed, max(duration_ms) AS duration_ms, round(sum(rows) / (max(duration_ms) / 1000), 2) AS rows_per_s, CASE WHEN count(error) = 0 THEN 'ok' WHEN count(error) < count(*) THEN 'degraded' ELSE 'failed' END AS status FROM results GROUP BY run_id")
def agg9_runs(spark, sf):
    h = long(F.floor(F.col("ts_ms") / HOUR))
    c = ts_ms(m.candles(spark, sf))
    rows = c.select(F.concat(F.lit("run"), (F.floor(F.col("ts_ms") / MS["1d"]) % 5).cast("string")).alias("run_id"), F.when(h % 50 == 0, "boom").alias("error"), (h % 50 == 1).alias("skipped"), long("volume").alias("rows"), (h % 3).alias("gaps_found"), (h % 2).alias("gaps_healed"), (1000 + h % 100).alias("duration_ms"))
    return registry.run_summary(rows)


@query("agg11_anomalies", f"{_C}, a AS (SELECT exchange, symbol, timeframe, CASE WHEN volume < 3 THEN 'thin' WHEN volume > 20 THEN 'heavy' ELSE 'normal' END AS reason, ts_ms FROM candles) SELECT exchange, symbol, timeframe, reason, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, count(*) AS n FROM a GROUP BY ALL")
def agg11_anomalies(spark, sf):
    return registry.anomaly_counts(_anomalies(spark, sf))


@query("dq13_novel", f"{_C} SELECT DISTINCT exchange, symbol, timeframe, CASE WHEN volume < 3 THEN 'thin' WHEN volume > 20 THEN 'heavy' ELSE 'normal' END AS reason FROM candles WHERE exchange = 'ex1' OR volume > 20")
def dq13_novel(spark, sf):
    a = _anomalies(spark, sf)
    seen = a.where("exchange = 'ex0' AND reason != 'heavy'")
    return registry.novel(a.withColumn("reason", F.concat("reason", F.lit(" (n=1)"))), seen).select("exchange", "symbol", "timeframe", "reason")


@query("agg15_manifest", f"""{_C}, p AS (SELECT symbol, ts_ms // {MS['1d']} AS d, exchange, min(ts_ms) AS lo, max(ts_ms) AS hi, count(*) AS rows FROM candles GROUP BY ALL), q AS (SELECT symbol, CASE WHEN d % 7 = 0 THEN hi + 1 ELSE lo END AS min_ms, CASE WHEN d % 7 = 0 THEN lo WHEN d % 7 = 3 THEN lo ELSE hi END AS max_ms, CASE WHEN d % 5 = 0 THEN 0 ELSE rows END AS rows FROM p WHERE symbol <> 'error'),
  n AS (SELECT *, lead(min_ms) OVER (PARTITION BY symbol ORDER BY min_ms, max_ms) AS next_ms FROM q), t AS (SELECT symbol, count(*) AS parts, count(*) FILTER (next_ms < max_ms) AS overlaps, count(*) FILTER (min_ms >= max_ms) AS inverted, count(*) FILTER (rows < 1) AS empty FROM n GROUP BY symbol),
  d AS (SELECT DISTINCT symbol, concat_ws(',', CASE WHEN symbol = 'view' THEN 'exchange' END, CASE WHEN symbol IN ('view', 'click') THEN 'version' END) AS missing FROM candles)
  SELECT d.symbol, missing, coalesce(parts, 0) AS parts, coalesce(t."overlaps", 0) AS overlaps, coalesce(inverted, 0) AS inverted, coalesce(empty, 0) AS empty, missing = '' AND coalesce(parts, 0) > 0 AND coalesce(t."overlaps", 0) + coalesce(inverted, 0) + coalesce(empty, 0) = 0 AS ok FROM d LEFT JOIN t ON t.symbol = d.symbol""")
def agg15_manifest(spark, sf):
    """Datasets of which one has no part and some lack fields; parts of which some end as or before they begin, and some have no row."""
    c, d = ts_ms(m.candles(spark, sf)), F.floor(F.col("ts_ms") / MS["1d"])
    parts = c.where("symbol != 'error'").groupBy("symbol", d.alias("d"), "exchange").agg(F.min("ts_ms").alias("lo"), F.max("ts_ms").alias("hi"), F.count("*").alias("rows"))
    day = F.col("d") % 7
    parts = parts.select("symbol", F.when(day == 0, F.col("hi") + 1).otherwise(F.col("lo")).alias("min_ms"), F.when(day.isin(0, 3), F.col("lo")).otherwise(F.col("hi")).alias("max_ms"), F.when(F.col("d") % 5 == 0, 0).otherwise(F.col("rows")).alias("rows"))
    of = F.col("symbol")
    datasets = c.select("symbol").distinct().select("symbol", F.lit("1h").alias("timeframe"), F.when(of != "view", "ex0").alias("exchange"), F.when(~of.isin("view", "click"), 1).alias("version"))
    return registry.manifest_problems(datasets, parts)


@query("agg16_lag", f"{_C} SELECT {K}, ({m.NOW_MS} - max(ts_ms)) // {HOUR} AS lag_candles, ({m.NOW_MS} - max(ts_ms)) // {HOUR} > 48 AS warning FROM candles GROUP BY {K}")
def agg16_lag(spark, sf):
    lag = F.expr(f"({m.NOW_MS} - max(unix_millis(timestamp))) div {HOUR}")
    return m.candles(spark, sf).groupBy(*KEY).agg(lag.alias("lag_candles"), (lag > 48).alias("warning"))


@query("agg17_lin1_loss", f"{m.PLANTED_SQL} SELECT {K}, count(*) AS rows_in, count(*) FILTER (close IS NOT NULL) AS rows_out, {r('(count(*) - count(*) FILTER (close IS NOT NULL)) / count(*)', 'loss_rate')} FROM planted GROUP BY {K}")
def agg17_loss(spark, sf):
    steps = m.planted(spark, sf).groupBy(*KEY).agg(F.count("*").alias("rows_in"), F.count("close").alias("rows_out"))
    return rounded(registry.with_loss(steps), "loss_rate")


_RUNS = f"{_C}, runs AS (SELECT 'run' || CAST(ts_ms // {MS['1d']} % 5 AS VARCHAR) || exchange AS run_id, CASE WHEN ts_ms // {HOUR} % 2 = 0 THEN 'prod' ELSE 'test' END AS env, CASE WHEN volume > 10 THEN 'ok' ELSE 'failed' END AS result, ts_ms * 10 + length(symbol) AS ts_ms, symbol FROM candles), latest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts_ms DESC, symbol DESC) = 1)"


def _runs(spark, sf) -> DataFrame:
    c = ts_ms(m.candles(spark, sf))
    hour = F.floor(F.col("ts_ms") / HOUR)
    return c.select(F.concat(F.lit("run"), (F.floor(F.col("ts_ms") / MS["1d"]) % 5).cast("string"), "exchange").alias("run_id"), F.when(hour % 2 == 0, "prod").otherwise("test").alias("env"), F.when(F.col("volume") > 10, "ok").otherwise("failed").alias("result"), (F.col("ts_ms") * 10 + F.length("symbol")).alias("ts_ms"), "symbol")


@query("lin2_lin3_runs", f"{_RUNS} SELECT run_id, ts_ms FROM latest")
def lin2_runs(spark, sf):
    """The last record of each run is the one that counts."""
    return registry.latest_runs(_runs(spark, sf)).select("run_id", "ts_ms")


@query("srt4_runs_by_time", f"{_RUNS}, t AS (SELECT run_id, max(ts_ms) AS ts_ms FROM runs WHERE symbol = 'click' GROUP BY run_id) SELECT run_id, ts_ms FROM t ORDER BY ts_ms DESC, run_id LIMIT 4")
def srt4_runs(spark, sf):
    """A report of the four newest runs."""
    return registry.runs_by_time(_runs(spark, sf).where("symbol = 'click'"), 4).select("run_id", "ts_ms")


@query("lin1_lineage", f"""{_C}, days AS (SELECT 'run' || CAST(ts_ms // {MS['1d']} % 3 AS VARCHAR) AS run_id, exchange, symbol, ts_ms // {MS['1d']} AS d, count(*) AS rows_in, count(*) FILTER (volume > 5) AS kept FROM candles GROUP BY ALL), steps AS (SELECT run_id, 'bronze' AS layer, exchange, symbol, d, rows_in, rows_in AS rows_out FROM days UNION ALL SELECT run_id, 'silver', exchange, symbol, d, rows_in, kept FROM days)
  SELECT run_id, layer, exchange, symbol, rows_in, rows_out, round((rows_in - rows_out) / rows_in, 6) AS loss_rate FROM (SELECT * FROM steps WHERE symbol = 'click' AND exchange = 'ex0' ORDER BY d DESC, layer, run_id LIMIT 9) UNION ALL SELECT run_id, 'run', exchange, symbol, sum(rows_in), sum(rows_out), 0 FROM steps WHERE run_id = 'run1' GROUP BY ALL""")
def lin1_lineage(spark, sf):
    """Steps appended in two writes; then the newest nine of a series, and the totals of a run."""
    day = F.floor(F.col("ts_ms") / MS["1d"])
    days = ts_ms(m.candles(spark, sf)).groupBy(day.alias("d"), "exchange", "symbol", "timeframe").agg(F.count("*").alias("rows_in"), F.count_if(F.col("volume") > 5).alias("kept"))
    steps = days.select("*", F.concat(F.lit("run"), (F.col("d") % 3).cast("string")).alias("run_id"), (F.col("d") * MS["1d"]).alias("ts_ms"), F.lit("success").alias("status"))
    folder = new_folder(spark)
    registry.record(steps.withColumns({"layer": F.lit("bronze"), "rows_out": F.col("rows_in")}), folder)
    registry.record(steps.withColumns({"layer": F.lit("silver"), "rows_out": F.col("kept")}), folder)
    table = registry.lineage_of(spark, folder)
    shown = ["run_id", "layer", "exchange", "symbol", "rows_in", "rows_out", "loss_rate"]
    whole = registry.run_events(table, "run1").groupBy("run_id", F.lit("run").alias("layer"), "exchange", "symbol").agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"), F.lit(0.0).alias("loss_rate"))
    return rounded(registry.series_history(table, "click", "ex0", 9).select(*shown).union(whole), "loss_rate")


@query("prj26_run_ids", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') || '-' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS run_id FROM events")
def prj26_ids(spark, sf):
    return _events(spark, sf).select("event_id", registry.run_id(F.col("ts").cast("timestamp"), F.col("event_id")).alias("run_id"))


_NOW = m.NOW_MS - 6 * MS["1d"]


@query("agg21_rules", f"""{_T}, x AS (SELECT exchange, ts_ms, CASE trade_id % 4 WHEN 0 THEN 'last_run' WHEN 1 THEN 'fetch_errors' WHEN 2 THEN 'events_failed' ELSE 'circuit_open' END AS metric, CASE WHEN trade_id % 4 = 3 THEN trade_id // 4 % 2 WHEN exchange = 'ex0' THEN 500.0 ELSE 1 END AS value, trade_id FROM trades WHERE ts_ms <= {_NOW} AND (exchange <> 'ex1' OR trade_id % 4 <> 0)),
  v AS (SELECT DISTINCT exchange FROM trades UNION ALL SELECT 'ex9'), a AS (SELECT exchange, max(ts_ms) FILTER (metric = 'last_run') AS last_run, sum(value) FILTER (metric = 'fetch_errors' AND ts_ms > {_NOW - 300_000}) AS fetched, sum(value) FILTER (metric = 'events_failed' AND ts_ms > {_NOW - 300_000}) AS failed, arg_max(value, ts_ms) FILTER (metric = 'circuit_open') AS circuit FROM x GROUP BY exchange),
  j AS (SELECT v.exchange, ({_NOW} - last_run) / 1000.0 AS age, coalesce(fetched / 300.0, 0) AS fetched, coalesce(failed / 300.0, 0) AS failed, coalesce(circuit, 0) AS circuit FROM v LEFT JOIN a ON a.exchange = v.exchange)
  SELECT exchange, unnest(['stale', 'fetch_errors', 'events_failed', 'circuit_open']) AS rule, round(unnest([age, fetched, failed, circuit]), 6) AS value, unnest([coalesce(age > 600, true), fetched > 0.1, failed > 1, circuit > 0]) AS alarm FROM j""")
def agg21_rules(spark, sf):
    """One venue never reports a run, one reports nothing at all."""
    i, t = F.col("trade_id"), ts_ms(m.trades(spark, sf))
    metric = F.get(F.array(*map(F.lit, ("last_run", "fetch_errors", "events_failed", "circuit_open"))), (i % 4).cast("int"))
    value = F.when(i % 4 == 3, (F.floor(i / 4) % 2).cast("double")).when(F.col("exchange") == "ex0", 500.0).otherwise(1.0)
    metrics = t.where("exchange != 'ex1' OR trade_id % 4 != 0").select("exchange", metric.alias("metric"), "ts_ms", value.alias("value"))
    venues = t.select("exchange").union(spark.createDataFrame([("ex9",)], "exchange string"))
    return rounded(registry.health(metrics, venues, _NOW), "value")


@query("str14_checkpoints", f"{_T}, x AS (SELECT exchange, symbol, ts_ms FROM trades), c AS (SELECT exchange AS source_id, max(ts_ms) FILTER (ts_ms < {m.NOW_MS - 10 * MS['1d']}) AS checkpoint FROM x GROUP BY exchange) SELECT source_id, count(*) AS taken, max(ts_ms) AS checkpoint FROM x JOIN c ON exchange = source_id WHERE ts_ms > checkpoint GROUP BY source_id")
def str14_checkpoints(spark, sf):
    """External rows past each source's checkpoint, which then moves to the newest of them."""
    rows = ts_ms(m.trades(spark, sf)).select(F.col("exchange").alias("source_id"), F.col("ts_ms").alias("timestamp_ms"))
    before = registry.checkpoints(rows.where(F.col("timestamp_ms") < m.NOW_MS - 10 * MS["1d"]))
    fresh = registry.past_checkpoints(rows, before)
    return fresh.groupBy("source_id").agg(F.count("*").alias("taken")).join(registry.checkpoints(fresh), "source_id")


@query("agg19_cursor_lag", f"{_C}, k AS (SELECT {K}, max(ts_ms) AS cursor_ms FROM candles GROUP BY {K}) SELECT exchange, count(*) AS series, round(avg({m.NOW_MS} - cursor_ms), 3) AS mean_lag_ms FROM k GROUP BY exchange")
def agg19_lag(spark, sf):
    cursors = ts_ms(m.candles(spark, sf)).groupBy(*KEY).agg(F.max("ts_ms").alias("cursor_ms"))
    return rounded(registry.cursor_lag(cursors, m.NOW_MS), "mean_lag_ms", places=3)


@query("agg20_metrics", f"{_T} SELECT 'trades' AS topic, exchange, CASE WHEN trade_id % 10 = 0 THEN 'failed' ELSE 'ok' END AS outcome, CAST(price > 5 AS INT) + CAST(price > 50 AS INT) + CAST(price > 250 AS INT) AS bucket, count(*) AS n FROM trades GROUP BY ALL")
def agg20_metrics(spark, sf):
    e = m.trades(spark, sf).select(F.lit("trades").alias("topic"), "exchange", F.when(F.col("trade_id") % 10 == 0, "failed").otherwise("ok").alias("outcome"), F.col("price").alias("value"))
    return registry.stream_metrics(e, [5.0, 50.0, 250.0]).withColumn("bucket", long("bucket"))


@query("agg21_health", f"{_T} SELECT ts_ms - ts_ms % 300000 AS window_ms, count(*) FILTER (trade_id % 3 = 0) AS failed, count(*) FILTER (trade_id % 3 = 0) / 300 > 0.003 AS alarm FROM trades GROUP BY ALL")
def agg21_health(spark, sf):
    return registry.failure_rate(m.trades(spark, sf).withColumn("failed", F.col("trade_id") % 3 == 0), 0.003)


# ---- tables with a snapshot log -------------------------------------------------------------------


def _lake(spark, sf) -> Lake:
    lake = Lake(spark, new_folder(spark))
    c = m.candles(spark, sf)
    lake.commit(c, "silver", 1, 1_000)
    lake.commit(c, "silver", 1, 9_000)  # the same commit again is skipped
    lake.commit(c.where(F.floor(F.unix_millis("timestamp") / HOUR) % 2 == 0).withColumn("close", F.col("close") + 1), "silver", 2, 2_000)
    return lake


@query("src1_snk2_silver_read", f"{_C} SELECT {K}, ts_ms, close + CASE WHEN ts_ms // {HOUR} % 2 = 0 THEN 1 ELSE 0 END AS close FROM candles WHERE symbol IN ('click', 'view') AND ts_ms >= {m.NOW_MS - 10 * MS['1d']} AND ts_ms <= {m.NOW_MS - 5 * MS['1d']}")
def src1_read(spark, sf):
    df = _lake(spark, sf).candles("silver", ["click", "view"], m.NOW_MS - 10 * MS["1d"], m.NOW_MS - 5 * MS["1d"])
    return ts_ms(df).select(*KEY, "ts_ms", "close")


@query("src3_src4_as_of", f"{_C} SELECT {K}, ts_ms, close FROM candles")
def src3_as_of(spark, sf):
    return ts_ms(_lake(spark, sf).candles("silver", as_of_ms=1_500)).select(*KEY, "ts_ms", "close")


@query("snk3_snk5_gold_replace", f"{_C} SELECT {K}, count(*) AS rows, min(ts_ms) AS oldest_ms, 'v2' AS feature_version FROM candles WHERE symbol = 'click' GROUP BY {K} UNION ALL SELECT {K}, count(*), min(ts_ms), 'v1' FROM candles WHERE symbol <> 'click' GROUP BY {K}")
def snk3_gold(spark, sf):
    lake = Lake(spark, new_folder(spark))
    f = features.gold_features(m.candles(spark, sf))
    lake.commit(gold_rows(f, "r1", "v1", 2), "gold", 1, 1_000, "replace", source_commit_id=2)
    lake.commit(gold_rows(f.where("symbol = 'click'"), "r2", "v2", 2), "gold", 2, 2_000, "replace", source_commit_id=2)
    g = ts_ms(lake.read("gold"))
    return g.groupBy(*KEY, "feature_version").agg(F.count("*").alias("rows"), F.min("ts_ms").alias("oldest_ms"))


@query("src19_src21_versions", f"{_C} SELECT {K}, 1 AS commit_id, 1000 AS committed_ms, 'append' AS kind, count(*) AS added_rows FROM candles GROUP BY {K} UNION ALL SELECT {K}, 2, 2000, 'append', count(*) FROM candles WHERE ts_ms // {HOUR} % 2 = 0 GROUP BY {K}")
def src19_versions(spark, sf):
    return _lake(spark, sf).versions("silver").select(*KEY, "commit_id", "committed_ms", "kind", "added_rows")


@query("src23_bounds", f"{_C} SELECT {K}, min(ts_ms) AS oldest_ms, max(ts_ms) AS newest_ms FROM candles GROUP BY {K}")
def src23_bounds(spark, sf):
    return _lake(spark, sf).bounds("silver").select(*KEY, F.unix_millis("oldest").alias("oldest_ms"), F.unix_millis("newest").alias("newest_ms"))


@query("src21_manifest", f"{_C}, u AS (SELECT *, 1 AS c FROM candles UNION ALL SELECT *, 2 FROM candles WHERE ts_ms // {HOUR} % 2 = 0) SELECT {K}, CAST(max(c) AS BIGINT) AS commit_id, count(*) AS rows, count(DISTINCT (c, strftime(make_timestamp(ts_ms * 1000), '%Y-%m'))) AS files, min(ts_ms) AS oldest_ms, max(ts_ms) AS newest_ms, true AS in_order FROM u GROUP BY {K}")
def src21_manifest(spark, sf):
    """What the newest version is made of, from the log: the data files are gone when it is asked."""
    lake = _lake(spark, sf)
    told = lake.manifest("silver")
    removed(spark, f"{lake.folder}/silver")
    order = F.forall(F.sequence(F.lit(1), F.size("parts") - 1), lambda i: F.element_at("parts", i)["min_us"] <= F.element_at("parts", i + 1)["min_us"])
    return told.select(*KEY, "commit_id", "rows", "files", F.unix_millis("oldest").alias("oldest_ms"), F.unix_millis("newest").alias("newest_ms"), F.when(F.size("parts") < 2, True).otherwise(order).alias("in_order"))


@query("src1_src6_files_in_range", f"{_C}, u AS (SELECT *, 1 AS c FROM candles UNION ALL SELECT *, 2 FROM candles WHERE ts_ms // {HOUR} % 2 = 0), f AS (SELECT {K}, c, count(*) AS rows, min(ts_ms) AS lo, max(ts_ms) AS hi FROM u GROUP BY {K}, c, strftime(make_timestamp(ts_ms * 1000), '%Y-%m')) SELECT {K}, count(*) AS files, sum(rows)::BIGINT AS rows FROM f WHERE symbol IN ('click', 'view') AND hi >= {m.NOW_MS - 33 * MS['1d']} AND lo <= {m.NOW_MS - 31 * MS['1d']} GROUP BY {K}")
def src1_files(spark, sf):
    """The files that a read of two symbols and a range lists, of all that the log has."""
    found = _lake(spark, sf).files("silver", symbols=["click", "view"], start_ms=m.NOW_MS - 33 * MS["1d"], end_ms=m.NOW_MS - 31 * MS["1d"])
    return found.groupBy(*KEY).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


@query("snk17_sweep", f"""{_C}, s AS (SELECT count(DISTINCT ({K}, strftime(make_timestamp(ts_ms * 1000), '%Y-%m'))) AS every, count(DISTINCT ({K}, strftime(make_timestamp(ts_ms * 1000), '%Y-%m'))) FILTER (ts_ms // {HOUR} % 2 = 0) AS even, count(*) AS rows, sum(CASE WHEN ts_ms // {HOUR} % 2 = 0 THEN 1 ELSE 0 END) AS higher FROM candles)
  SELECT 'reachable' AS state, 0 AS unreached, 2 * every + even AS files, rows AS live_rows FROM s UNION ALL SELECT 'expired', every + even, 2 * every + even, rows FROM s UNION ALL SELECT 'swept', 0, every, rows FROM s""")
def snk17_sweep(spark, sf):
    """An append, an upsert and a compaction: once the older versions have expired, a sweep leaves the compacted files alone."""
    lake = _lake(spark, sf)
    lake.compact("silver", 3, 3_000)

    def state(name: str) -> tuple:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(f"{lake.folder}/silver").select("path").count()
        return name, lake.unreached("silver").count(), files, lake.candles("silver").count()

    told = [state("reachable")]
    lake.retention("silver", 3_500 + 3 * MS["1d"], 3, dry_run=False)
    told.append(state("expired"))
    lake.sweep("silver")
    # what the log lists but the sweep removed is no longer there to be swept
    told.append(("swept", lake.sweep("silver", dry_run=True)[0], *state("swept")[2:]))
    return spark.createDataFrame(told, "state string, unreached long, files long, live_rows long")


@query("snk17_retention", f"{_C} SELECT 'before' AS state, 2 AS scanned, 1 AS eligible, count(*) AS live_rows FROM candles UNION ALL SELECT 'after', 1, 0, count(*) FROM candles")
def snk17_retention(spark, sf):
    """The older version expires: it is no version any more, and the newest one reads the same rows."""
    lake, now = _lake(spark, sf), 1_500 + 3 * MS["1d"]
    before, rows = lake.retention("silver", now, 3), lake.candles("silver").agg(F.count("*").alias("live_rows"))
    before = spark.createDataFrame([(*before.first(), rows.first()[0])], "scanned long, eligible long, live_rows long").select(F.lit("before").alias("state"), "*")
    lake.retention("silver", now, 3, dry_run=False)
    after = lake.retention("silver", now, 3).crossJoin(lake.candles("silver").agg(F.count("*").alias("live_rows")))  # each is one row
    return before.union(after.select(F.lit("after").alias("state"), "*"))


@query("snk6_src6_trades_table", f"{_T} SELECT exchange, symbol, trade_id, ts_ms, price + CASE WHEN trade_id % 3 = 0 THEN 1 ELSE 0 END AS price FROM trades WHERE symbol IN ('click', 'view') AND ts_ms BETWEEN {m.NOW_MS - 10 * MS['1d']} AND {m.NOW_MS - 5 * MS['1d']}")
def snk6_trades(spark, sf):
    """Trades, which have no timeframe, are stored by trade id; a second commit corrects some of them."""
    lake, t = Lake(spark, new_folder(spark)), m.trades(spark, sf).withColumn("timestamp", F.timestamp_millis(F.unix_millis("timestamp")))
    lake.commit(t, "trades", 1, 1_000)
    lake.upsert(t.where("trade_id % 3 = 0").withColumn("price", F.col("price") + 1), "trades", 2, 2_000)
    return ts_ms(lake.newest_rows("trades", ["click", "view"], m.NOW_MS - 10 * MS["1d"], m.NOW_MS - 5 * MS["1d"], columns=["price"])).select("exchange", "symbol", "trade_id", "ts_ms", "price")


@query("snk7_derivatives_table", f"{_T}, d AS (SELECT exchange, symbol, ts_ms - ts_ms % {HOUR} AS ts_ms, unnest(['funding_rate', 'open_interest']) AS metric, unnest([avg(price), sum(amount)]) AS value FROM trades GROUP BY exchange, symbol, ts_ms - ts_ms % {HOUR}) SELECT exchange, symbol, metric, ts_ms, round(value + CASE WHEN metric = 'funding_rate' THEN 5 ELSE 0 END, 6) AS value FROM d")
def snk7_derivatives(spark, sf):
    """Derivatives in long form; a correction of one metric leaves the other of the same time as it is."""
    hour = F.window("timestamp", "1 hour").alias("w")
    wide = m.trades(spark, sf).groupBy("exchange", "market_type", "symbol", hour).agg(F.avg("price").alias("funding_rate"), F.sum("amount").alias("open_interest"))
    long_form = wide.select("exchange", "market_type", "symbol", F.col("w.start").alias("timestamp"), "funding_rate", "open_interest").unpivot(["exchange", "market_type", "symbol", "timestamp"], ["funding_rate", "open_interest"], "metric", "value")
    lake = Lake(spark, new_folder(spark))
    lake.commit(long_form, "derivatives", 1, 1_000)
    lake.upsert(long_form.where("metric = 'funding_rate'").withColumn("value", F.col("value") + 5), "derivatives", 2, 2_000)
    return rounded(ts_ms(lake.newest_rows("derivatives")).select("exchange", "symbol", "metric", "ts_ms", "value"), "value")


@query("src7_feature_range", f"{_C} SELECT symbol, ts_ms, round((high - low) / nullif(close, 0), 6) AS high_low_spread FROM candles WHERE symbol = 'click' AND exchange = 'ex0' AND ts_ms >= {m.NOW_MS - 5 * MS['1d']}")
def src7_features(spark, sf):
    """A research read: one column of one symbol's features in a range of time."""
    lake = Lake(spark, new_folder(spark))
    lake.commit(gold_rows(features.gold_features(m.candles(spark, sf)), "r1", "v1", 1), "gold", 1, 1_000, "replace", source_commit_id=1)
    df = lake.found("gold", ["click"], m.NOW_MS - 5 * MS["1d"], columns=["high_low_spread"]).where("exchange = 'ex0'")
    return rounded(ts_ms(df).select("symbol", "ts_ms", "high_low_spread"), "high_low_spread")


@query("src19_datasets", f"{_C} SELECT DISTINCT exchange, symbol, timeframe, true AS fresh FROM candles")
def src19_datasets(spark, sf):
    lake = _lake(spark, sf)
    return lake.datasets("silver").select("exchange", "symbol", "timeframe", F.lit(lake.fresh("silver", 2_000 + HOUR) and not lake.fresh("silver", 2_001 + HOUR)).alias("fresh"))
