"""Queries of trades and order books."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.timeframes import MS
from tideframe.operators import registry, rules
from tideframe.operators import trade_series as t
from tideframe.operators.sketch import LATENCY_BOUNDS, bound_quantiles, log_histogram, merged
from tideframe.plans.core import HOUR, K, r
from tideframe.plans.register import long, query, rounded, ts_ms
from tideframe.sources import mappings as m
from tideframe.sources.snapshots import new_folder

S = "exchange, market_type, symbol"
_T = f"WITH {m.TRADES_SQL}"
_TOTALS = """count(*) AS trade_count, CAST(sum(amount) AS DOUBLE) AS total_volume, round(CAST(sum(CAST(price AS DECIMAL(24,8)) * CAST(amount AS DECIMAL(10,0))) AS DOUBLE), 6) AS total_cost,
  coalesce(sum(amount) FILTER (side = 'buy'), 0) AS buy_volume, coalesce(sum(amount) FILTER (side = 'sell'), 0) AS sell_volume, arg_min(price, (ts_ms, trade_id)) AS open_price, max(price) AS high_price, min(price) AS low_price,
  arg_max(price, (ts_ms, trade_id)) AS close_price, max(ts_ms) - min(ts_ms) AS duration_ms, round(sum(price * amount) / sum(amount), 9) AS vwap,
  round((coalesce(sum(amount) FILTER (side = 'buy'), 0) - coalesce(sum(amount) FILTER (side = 'sell'), 0)) / sum(amount), 9) AS buy_sell_imbalance"""


def _doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c, kind in df.dtypes if kind.startswith("decimal")})


#: Trades of which one in nine has no known side: it counts in the volume, on neither side.
_SIDED = f"{_T.replace('trades AS', 'all_trades AS')}, trades AS (SELECT * REPLACE (CASE WHEN trade_id % 9 = 0 THEN 'unknown' ELSE side END AS side) FROM all_trades)"


def _sided(spark, sf) -> DataFrame:
    return m.trades(spark, sf).withColumn("side", t.parsed_side(F.when(F.col("trade_id") % 9 == 0, "none").otherwise(F.upper("side"))))


@query("agg6_trade_series", f"{_SIDED} SELECT {S}, {_TOTALS} FROM trades GROUP BY {S}")
def agg6_series(spark, sf):
    return rounded(_doubles(t.series_totals(_sided(spark, sf), t.SERIES)), "vwap", "buy_sell_imbalance", places=9)


@query("agg6_str4_trade_windows", f"{_SIDED} SELECT {S}, ts_ms - ts_ms % {MS['4h']} AS window_start_ms, {_TOTALS} FROM trades GROUP BY {S}, ts_ms - ts_ms % {MS['4h']}")
def agg6_windows(spark, sf):
    df = t.series_totals(_sided(spark, sf), [*t.SERIES, F.window("timestamp", "4 hours").alias("w")])
    return rounded(_doubles(df.withColumn("window_start_ms", F.unix_millis("w.start")).drop("w")), "vwap", "buy_sell_imbalance", places=9)


@query("win21_in_order", f"{_T}, x AS (SELECT *, (trade_id * 7919) % 10007 AS arrival FROM trades), y AS (SELECT *, max(ts_ms) OVER (PARTITION BY {S} ORDER BY arrival, trade_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM x) SELECT {S}, trade_id, ts_ms FROM y WHERE newest IS NULL OR ts_ms >= newest")
def win21_order(spark, sf):
    rows = m.trades(spark, sf).withColumn("timestamp", F.timestamp_millis(F.unix_millis("timestamp"))).withColumn("arrival", (F.col("trade_id") * 7919) % 10007)
    return ts_ms(t.in_order(rows.withColumn("a", F.struct("arrival", "trade_id")), "a", F.floor(F.col("arrival") / 64))).select(*t.SERIES, "trade_id", "ts_ms")


@query("win22_disorder", f"{_T}, x AS (SELECT *, (trade_id * 7919) % 10007 AS arrival FROM trades), y AS (SELECT *, lag(ts_ms) OVER (PARTITION BY {S} ORDER BY arrival, trade_id) AS before FROM x) SELECT {S}, count(*) AS trades, count(*) FILTER (before > ts_ms) AS out_of_order FROM y GROUP BY {S}")
def win22_disorder(spark, sf):
    rows = m.trades(spark, sf).withColumn("timestamp", F.timestamp_millis(F.unix_millis("timestamp"))).withColumn("a", F.struct(((F.col("trade_id") * 7919) % 10007).alias("arrival"), "trade_id"))
    return t.disorder(rows, "a", F.floor(F.col("a.arrival") / 64))


@query("win23_silences", f"{_T}, y AS (SELECT {S}, lag(ts_ms) OVER (PARTITION BY {S} ORDER BY ts_ms, trade_id) + 1 AS from_ms, ts_ms AS to_ms FROM trades) SELECT *, to_ms - from_ms + 1 AS silence_ms FROM y WHERE to_ms - from_ms + 1 > 7200000")
def win23_silences(spark, sf):
    return t.silences(m.trades(spark, sf), 7_200_000)


@query("ded8_sources", f"{_T}, x AS (SELECT *, 'rest' AS source FROM trades UNION ALL SELECT *, 'ws' FROM trades WHERE trade_id % 2 = 0 UNION ALL SELECT *, 'replay' FROM trades WHERE trade_id % 3 = 0) SELECT exchange, symbol, ts_ms, trade_id, price, CASE WHEN trade_id % 3 = 0 THEN 'replay' WHEN trade_id % 2 = 0 THEN 'ws' ELSE 'rest' END AS source FROM trades")
def ded8_sources(spark, sf):
    rows = m.trades(spark, sf)
    every = rows.withColumn("source", F.lit("rest")).union(rows.where("trade_id % 2 = 0").withColumn("source", F.lit("ws"))).union(rows.where("trade_id % 3 = 0").withColumn("source", F.lit("replay")))
    return ts_ms(t.across_sources(every)).select("exchange", "symbol", "ts_ms", "trade_id", "price", "source")


@query("agg10_lateness", f"{m.BASE_SQL}, d AS (SELECT exchange, timeframe, volume * 30000 AS delay_ms FROM candles) SELECT exchange, timeframe, count(*) AS n, round(least(greatest(quantile_cont(delay_ms, 0.95), 60000), 3600000), 6) AS p95_ms, round(least(greatest(quantile_cont(delay_ms, 0.99), 60000), 3600000), 6) AS p99_ms FROM d GROUP BY exchange, timeframe")
def agg10_lateness(spark, sf):
    return rounded(t.lateness(m.candles(spark, sf).select("exchange", "timeframe", (F.col("volume") * 30_000).alias("delay_ms")), exact=True), "p95_ms", "p99_ms")


_DELAYS = f"{m.BASE_SQL}, d AS (SELECT exchange, timeframe, volume * 30000 AS delay_ms FROM candles), h AS (SELECT exchange, timeframe, CAST(ceil(ln(delay_ms) / ln(1.01)) AS BIGINT) AS bucket, count(*) AS n FROM d GROUP BY ALL)"
_RANKS = "x AS (SELECT *, sum(n) OVER (PARTITION BY exchange, timeframe ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY exchange, timeframe) AS every FROM h)"


def _at_rank(share: float, name: str) -> str:
    rank = f"{share} * (every - 1)"
    return f"max(CASE WHEN upto > {rank} AND upto - n <= {rank} THEN pow(1.01, bucket - 1) * (1 + 0.01 * ({rank} - (upto - n) + 0.5) / n) END) AS {name}"


@query("agg10_str7_calibration", f"{_DELAYS}, {_RANKS}, q AS (SELECT exchange, timeframe, CAST(sum(n) AS BIGINT) AS n, {_at_rank(0.95, 'p95')}, {_at_rank(0.99, 'p99')} FROM x GROUP BY ALL) SELECT exchange, timeframe, n, round(least(greatest(p95, 60000), 3600000), 4) AS p95_ms, round(least(greatest(p99, 60000), 3600000), 4) AS p99_ms FROM q")
def agg10_calibration(spark, sf):
    """Lateness calibrated from a stream's own state: three batches of delays add to one histogram, and no delay is read twice."""
    folder = new_folder(spark)
    delays = m.candles(spark, sf).select("exchange", "timeframe", (F.col("volume") * 30_000).alias("delay_ms"))
    delays.repartition(3).write.json(f"{folder}/landed")
    stream = spark.readStream.schema(delays.schema).option("maxFilesPerTrigger", 1).json(f"{folder}/landed")
    state = log_histogram(stream, ["exchange", "timeframe"], "delay_ms")
    state.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/histogram/batch={n}")).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(f"{folder}/histogram")
    told = last.join(last.agg(F.max("batch").alias("batch")), "batch").drop("batch")
    return rounded(t.lateness_of(told), "p95_ms", "p99_ms", places=4)


@query("agg20_latency_quantiles", f"""{_T}, v AS (SELECT exchange, trade_id % 3 AS part, price AS ms FROM trades), h AS (SELECT exchange, (ms > 1)::INT + (ms > 5)::INT + (ms > 10)::INT + (ms > 25)::INT + (ms > 50)::INT + (ms > 100)::INT + (ms > 250)::INT + (ms > 500)::INT + (ms > 1000)::INT + (ms > 2500)::INT + (ms > 5000)::INT AS bucket, count(*) AS n FROM v GROUP BY ALL),
  x AS (SELECT *, [0, 1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 5000][bucket + 1] AS low, [0, 1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 5000][bucket + 2] AS high, sum(n) OVER (PARTITION BY exchange ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY exchange) AS every FROM h)
  SELECT exchange, CAST(sum(n) AS BIGINT) AS n, {', '.join(f"round(max(CASE WHEN upto >= {q} * every AND upto - n < {q} * every THEN low + (high - low) * ({q} * every - (upto - n)) / n END), 6) AS p{round(q * 100)}_ms" for q in (0.5, 0.95, 0.99))} FROM x GROUP BY exchange""")
def agg20_quantiles(spark, sf):
    """Latency quantiles as the live figures have them: histograms of three parts add up, and quantiles are linear within a bucket."""
    v = m.trades(spark, sf).select(F.lit("trades").alias("topic"), "exchange", F.lit("ok").alias("outcome"), F.col("price").alias("value"), (F.col("trade_id") % 3).alias("part"))
    parts = [registry.stream_metrics(v.where(F.col("part") == k), LATENCY_BOUNDS).select("exchange", "bucket", "n") for k in range(3)]
    told = bound_quantiles(merged(["exchange"], *parts), ["exchange"], {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, LATENCY_BOUNDS)
    return rounded(told, "p50_ms", "p95_ms", "p99_ms")


@query("flt18_homogeneous", f"{_T} SELECT ts_ms // {MS['1d']} AS batch, count(DISTINCT (exchange, market_type, symbol)) AS series, count(DISTINCT (exchange, market_type, symbol)) = 1 AS homogeneous FROM trades GROUP BY ALL")
def flt18_homogeneous(spark, sf):
    n = F.count_distinct("exchange", "market_type", "symbol")
    return m.trades(spark, sf).groupBy(long(F.floor(F.unix_millis("timestamp") / MS["1d"])).alias("batch")).agg(n.alias("series"), (n == 1).alias("homogeneous"))


# ---- candle and trade projections -----------------------------------------------------------------


@query("prj11_shape", f"{m.BASE_SQL} SELECT {K}, ts_ms, {r('abs(close - open)', 'body_size')}, {r('high - greatest(open, close)', 'wick_upper')}, {r('least(open, close) - low', 'wick_lower')}, close > open AS is_bullish, close < open AS is_bearish FROM candles")
def prj11_shape(spark, sf):
    df = rules.with_shape(ts_ms(m.candles(spark, sf)))
    return rounded(df.drop("open", "high", "low", "close", "volume"), "body_size", "wick_upper", "wick_lower")


@query("prj12_valid_count", f"{m.PLANTED_SQL} SELECT {K}, count(*) FILTER (ts_ms > 0 AND volume >= 0 AND NOT isnan(volume) AND open BETWEEN low AND high AND close BETWEEN low AND high) AS valid FROM planted GROUP BY {K}")
def prj12_valid(spark, sf):
    return m.planted(spark, sf).groupBy(*K.split(", ")).agg(F.count_if(rules.candle_is_valid()).alias("valid"))


@query("prj13_chunks", f"{m.BASE_SQL} SELECT {K}, ts_ms // {MS['1d']} AS chunk, count(*) AS n, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, ts_ms // {MS['1d']} = max(ts_ms // {MS['1d']}) OVER (PARTITION BY {K}) AS is_last_chunk FROM candles GROUP BY {K}, ts_ms // {MS['1d']}".replace(f"max(ts_ms // {MS['1d']}) OVER", f"max(max(ts_ms // {MS['1d']})) OVER"))
def prj13_chunks(spark, sf):
    return rules.chunks(m.candles(spark, sf), K.split(", "), MS["1d"]).drop("bars")


@query("prj14_side", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' ELSE 'unknown' END AS side FROM events")
def prj14_side(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id")
    raw = F.element_at(F.array(F.lit(" BUY "), F.lit("Sell"), F.lit("short"), F.lit(None).cast("string")), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select("event_id", t.parsed_side(raw).alias("side"))


@query("prj15_cost", f"{_T} SELECT trade_id, CAST(CAST(price AS DECIMAL(24,8)) * CAST(amount AS DECIMAL(10,0)) AS DOUBLE) AS cost, side = 'buy' AS is_buy, side = 'sell' AS is_sell, ts_ms FROM trades")
def prj15_cost(spark, sf):
    return rules.with_cost(m.trades(spark, sf)).select("trade_id", F.col("cost").cast("double").alias("cost"), "is_buy", "is_sell", F.unix_millis("timestamp").alias("ts_ms"))


# ---- order books ----------------------------------------------------------------------------------


def books(spark, sf) -> DataFrame:
    """A book for each order: odd lines are bids below, even lines asks above."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    level = F.struct(F.try_divide("l_extendedprice", "l_quantity").alias("price"), F.col("l_quantity").alias("qty"))
    side = lambda odd: F.filter(F.collect_list(F.struct((F.col("l_linenumber") % 2 == 1).alias("odd"), level.alias("level"))), lambda x: x["odd"] == odd)
    df = li.groupBy("l_orderkey").agg(side(True).alias("bids"), side(False).alias("asks"))
    return t.sorted_book(df.select("l_orderkey", *(F.transform(c, lambda x: x["level"]).alias(c) for c in ("bids", "asks"))))


_LEVELS = "l AS (SELECT l_orderkey, l_linenumber % 2 = 1 AS bid, l_extendedprice / l_quantity AS price, l_quantity AS qty FROM lineitem), b AS (SELECT l_orderkey, max(price) FILTER (bid) AS best_bid, min(price) FILTER (NOT bid) AS best_ask, count(*) FILTER (bid) AS bid_depth, count(*) FILTER (NOT bid) AS ask_depth FROM l GROUP BY l_orderkey)"


@query("ob1_ob3_book", f"WITH {_LEVELS} SELECT l_orderkey, round(best_bid, 9) AS best_bid, round(best_ask, 9) AS best_ask, round((best_bid + best_ask) / 2, 9) AS mid, round(best_ask - best_bid, 9) AS spread, round((best_ask - best_bid) / nullif((best_bid + best_ask) / 2, 0) * 10000, 6) AS spread_bps, coalesce(best_bid >= best_ask, false) AS crossed, bid_depth, ask_depth FROM b")
def ob1_book(spark, sf):
    df = t.book_measures(books(spark, sf)).drop("bids", "asks")
    return rounded(rounded(df, "best_bid", "best_ask", "mid", "spread", places=9), "spread_bps").withColumns({c: long(c) for c in ("bid_depth", "ask_depth")})


#: Books with one fault each, by the order's number modulo 8; two bids of one price and falling quantities are no fault.
_FAULTS = "CASE l_orderkey % 8 WHEN 1 THEN 'no_exchange' WHEN 2 THEN 'bad_time' WHEN 3 THEN CASE WHEN bid_depth + ask_depth > 0 THEN 'empty' END WHEN 4 THEN CASE WHEN bid_depth > 0 THEN 'bad_level' END WHEN 5 THEN CASE WHEN best_bid > least_bid THEN 'bids_not_falling' END END"


@query("srt6_flt15_book_valid", f"WITH {_LEVELS.replace('max(price) FILTER (bid) AS best_bid', 'max(price) FILTER (bid) AS best_bid, min(price) FILTER (bid) AS least_bid')} SELECT l_orderkey, {_FAULTS} AS problem, best_bid AS first_bid FROM b")
def srt6_book(spark, sf):
    kind = F.col("l_orderkey") % 8
    b = books(spark, sf).withColumns({"exchange": F.when(kind == 1, "").otherwise("ex0"), "symbol": F.lit("part"), "ts_ms": F.when(kind == 2, 0).otherwise(m.NOW_MS), "first_bid": F.get("bids", F.lit(0))["price"]})
    none = F.slice("bids", 1, 0)
    again = F.transform("bids", lambda x: F.struct(x["price"].alias("price"), (x["qty"] - 0.5).alias("qty")))
    bids = F.when(kind == 3, none).when(kind == 4, F.transform("bids", lambda x: F.struct((-x["price"]).alias("price"), x["qty"].alias("qty")))).when(kind == 5, F.reverse("bids"))
    twice = F.flatten(F.transform(F.sequence(F.lit(0), F.size("bids") - 1), lambda i: F.array(F.get("bids", i), F.get(again, i))))
    bids = F.coalesce(bids, F.when((kind == 6) & (F.size("bids") > 0), twice), F.col("bids"))
    b = b.withColumns({"bids": bids, "asks": F.when(kind == 3, none).otherwise(F.col("asks"))})
    return b.select("l_orderkey", t.book_problem().alias("problem"), "first_bid")


@query("flt15_deltas", f"{_T} SELECT CASE WHEN trade_id % 5 = 0 THEN 'bad_side' WHEN trade_id % 7 = 0 OR NOT coalesce(price > 0, false) THEN 'bad_price' WHEN trade_id % 11 = 0 THEN 'bad_size' END AS problem, count(*) AS n FROM trades GROUP BY ALL")
def flt15_deltas(spark, sf):
    i = F.col("trade_id")
    d = ts_ms(m.trades(spark, sf)).withColumns({"side": F.when(i % 5 == 0, F.col("side")).otherwise("bid"), "price": F.when(i % 7 == 0, 0.0).otherwise(F.col("price")), "qty": F.when(i % 11 == 0, F.lit(None).cast("double")).when(i % 13 == 0, 0.0).otherwise(F.col("amount"))})
    return d.groupBy(t.delta_problem().alias("problem")).agg(F.count("*").alias("n"))


@query("ob4_deltas", f"{_T} SELECT trade_id, CASE WHEN trade_id % 6 = 0 THEN 'delete' ELSE 'upsert' END AS kind, side = 'buy' AS is_bid FROM trades")
def ob4_deltas(spark, sf):
    qty = F.when(F.col("trade_id") % 6 == 0, 0.0).otherwise(F.col("amount"))
    return m.trades(spark, sf).select("trade_id", t.delta_kind(qty).alias("kind"), (F.col("side") == "buy").alias("is_bid"))


_AT = m.NOW_MS - 3 * MS["1d"]


@query("ob5_book_at", f"""{_T}, d AS (SELECT exchange, symbol, ts_ms, trade_id AS seq, CASE side WHEN 'buy' THEN 'bid' ELSE 'ask' END AS side, floor(price / 10) AS price, CASE WHEN trade_id % 6 = 0 THEN 0.0 ELSE amount END AS qty FROM trades),
  s AS (SELECT exchange, symbol, min(ts_ms) AS base_ms FROM trades GROUP BY ALL), l AS (SELECT exchange, symbol, base_ms AS ts_ms, -1 AS seq, 'bid' AS side, CAST(unnest(range(50)) AS DOUBLE) AS price, 1.0 AS qty FROM s UNION ALL SELECT d.* FROM d JOIN s USING (exchange, symbol) WHERE ts_ms > base_ms AND ts_ms <= {_AT}),
  f AS (SELECT exchange, symbol, side, price, arg_max(qty, (ts_ms, seq)) AS qty FROM l GROUP BY ALL) SELECT * FROM f WHERE qty > 0""")
def ob5_book_at(spark, sf):
    x = ts_ms(m.trades(spark, sf))
    deltas = x.select("exchange", "symbol", "ts_ms", F.col("trade_id").alias("seq"), F.when(F.col("side") == "buy", "bid").otherwise("ask").alias("side"), F.floor(F.col("price") / 10).cast("double").alias("price"), F.when(F.col("trade_id") % 6 == 0, 0.0).otherwise(F.col("amount")).alias("qty"))
    level = F.transform(F.sequence(F.lit(0), F.lit(49)), lambda k: F.struct(k.cast("double").alias("price"), F.lit(1.0).alias("qty")))
    snaps = x.groupBy("exchange", "symbol").agg(F.min("ts_ms").alias("ts_ms")).withColumns({"bids": level, "asks": F.slice(level, 1, 0)})
    return t.book_at(snaps, deltas, _AT)


@query("ob6_split", f"{_T} SELECT trade_id, CASE WHEN trade_id % 4 = 0 THEN 'snapshot' ELSE 'delta' END AS payload_type, CASE WHEN trade_id % 3 = 0 THEN ts_ms + 250 ELSE ts_ms END AS book_ms FROM trades")
def ob6_split(spark, sf):
    x = ts_ms(m.trades(spark, sf)).withColumns({"delta": F.when(F.col("trade_id") % 4 != 0, F.col("price")), "exchange_ms": F.when(F.col("trade_id") % 3 != 0, F.col("ts_ms")), "receipt_s": (F.col("ts_ms") + 250) / 1000.0})
    return x.select("trade_id", rules.book_kind(F.col("delta")).alias("payload_type"), rules.book_time(F.col("exchange_ms"), F.col("receipt_s")).alias("book_ms"))
