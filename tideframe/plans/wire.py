"""Queries of wire events, messages and validity rules; each plants rows that its rules must catch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.functions.timeframes import MS
from tideframe.operators import gaps, rules
from tideframe.operators import trade_series as t
from tideframe.plans.core import HOUR
from tideframe.plans.register import query, rounded, ts_ms
from tideframe.sources import events, landed
from tideframe.sources import mappings as m

_T = f"WITH {m.TRADES_SQL}"


def _numbered(spark, sf) -> DataFrame:
    """Trades with their time in milliseconds and what every event has; one in nineteen is of a later version."""
    i = F.col("trade_id")
    return ts_ms(m.trades(spark, sf)).withColumns({"event_id": F.concat(F.lit("e"), i.cast("string")), "event_version": F.when(i % 19 == 0, 2).otherwise(1), "run_id": F.lit("r1")})


def _sent(df: DataFrame, **fields: Column) -> DataFrame:
    return events.messages(df.withColumns(fields), F.col("symbol"), "event_id", "event_version", "exchange", "symbol", *fields)


@query("src11_trade_windows", f"{_T}, w AS (SELECT exchange, symbol, ts_ms - ts_ms % {MS['4h']} AS window_start_ms, count(*) AS trade_count, CAST(sum(amount) AS DOUBLE) AS total_volume FROM trades GROUP BY ALL) SELECT *, CASE WHEN trade_count % 5 = 0 THEN 'bad_source' END AS reject_reason FROM w")
def src11_windows(spark, sf):
    """Window totals out as messages and in again."""
    w = F.window("timestamp", "4 hours").alias("w")
    totals = t.series_totals(m.trades(spark, sf), [*t.SERIES, w]).withColumns({"window_start_ms": F.unix_millis("w.start"), "window_end_ms": F.unix_millis("w.end"), "vwap": F.col("vwap").cast("string"), "event_id": F.lit("w"), "source": F.when(F.col("trade_count") % 5 == 0, "guess").otherwise("live")})
    sent = events.messages(totals, landed.routing_key("exchange", "symbol"), "event_id", "source", *t.SERIES, "window_start_ms", "window_end_ms", "trade_count", "vwap", "total_volume", "total_cost")
    got = events.events(sent, "trade_window")
    return got.select("exchange", "symbol", "window_start_ms", "trade_count", F.col("total_volume").cast("double").alias("total_volume"), "reject_reason")


def _books(spark, sf) -> DataFrame:
    i, x = F.col("trade_id"), _numbered(spark, sf)
    level = lambda up: F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.array((F.col("price") + (k if up else -k) * F.when(i % 11 == 0, -1).otherwise(1)).cast("decimal(18,4)").cast("string"), F.col("amount").cast("string")))
    kind = F.when(i % 7 == 0, F.lit(None)).when(i % 4 == 0, "snapshot").when(i % 31 == 0, "ticker").otherwise("delta")
    return _sent(x, payload_type=kind, timestamp_ms=F.when(i % 13 != 0, F.col("ts_ms")), bids=F.when(i % 4 == 0, level(False)), asks=F.when(i % 4 == 0, level(True)), side=F.when(i % 5 == 0, "buy").when(i % 3 != 0, F.when(F.col("side") == "buy", "bid").otherwise("ask")), price=F.col("price").cast("decimal(18,4)"), size=F.col("amount").cast("decimal(18,4)"))


_REASON = "CASE WHEN trade_id % 19 = 0 THEN 'bad_version' WHEN trade_id % 13 = 0 THEN 'missing_field'"


@query("src12_snk15_book_events", f"""{_T}, k AS (SELECT *, CASE WHEN trade_id % 7 = 0 THEN 'other' WHEN trade_id % 4 = 0 THEN 'snapshot' WHEN trade_id % 31 = 0 THEN 'other' ELSE 'delta' END AS kind FROM trades),
  j AS (SELECT *, CASE WHEN kind <> 'other' THEN {_REASON} WHEN kind = 'delta' AND trade_id % 5 = 0 THEN 'bad_side' WHEN kind = 'delta' AND round(price, 4) <= 0 THEN 'bad_price' WHEN kind = 'snapshot' AND round(price, 4) - 3 <= 0 THEN 'bad_level' WHEN kind = 'snapshot' AND trade_id % 11 = 0 THEN 'bids_not_falling' END END AS problem FROM k)
  SELECT kind, problem, count(*) AS n, coalesce(round(sum(CASE WHEN kind = 'delta' AND problem IS NULL THEN round(price, 4) END), 2), 0) AS prices FROM j GROUP BY kind, problem""")
def src12_books(spark, sf):
    snapshots, deltas, others = events.book_events(_books(spark, sf))
    s = snapshots.select(F.lit("snapshot").alias("kind"), F.coalesce("reject_reason", t.book_problem()).alias("problem"), F.lit(0.0).alias("price"))
    d = deltas.withColumn("problem", F.coalesce("reject_reason", t.delta_problem())).select(F.lit("delta").alias("kind"), "problem", F.when(F.col("problem").isNull(), F.col("price")).alias("price"))
    o = others.select(F.lit("other").alias("kind"), F.lit(None).cast("string").alias("problem"), F.lit(0.0).alias("price"))
    return rounded(s.union(d).union(o).groupBy("kind", "problem").agg(F.count("*").alias("n"), F.coalesce(F.sum("price"), F.lit(0.0)).alias("prices")), "prices", places=2)


@query("src13_snk15_derivatives", f"""{_T}, r AS (SELECT *, {_REASON} END AS reason FROM trades), f AS (SELECT 'funding' AS kind, market, reason AS reject_reason, price AS value FROM r, (VALUES ('linear')) AS x(market) UNION ALL SELECT 'open_interest', CASE WHEN trade_id % 2 = 0 THEN 'inverse' ELSE 'linear' END, reason, amount FROM r
  UNION ALL SELECT 'liquidation', 'linear', CASE WHEN reason IS NOT NULL THEN reason WHEN trade_id % 5 = 0 THEN 'bad_side' END, price * amount FROM r) SELECT kind, market AS market_type, reject_reason, count(*) AS n, round(sum(value), 2) AS value FROM f GROUP BY ALL""")
def src13_derivatives(spark, sf):
    i, x = F.col("trade_id"), _numbered(spark, sf)
    ms = F.when(i % 13 != 0, F.col("ts_ms"))
    sent = {
        "funding": (_sent(x, timestamp_ms=ms, funding_rate=F.col("price").cast("string")), F.col("funding_rate").cast("double")),
        "open_interest": (_sent(x, timestamp_ms=ms, market_type=F.when(i % 2 == 0, "inverse"), open_interest_contracts=F.col("amount").cast("string")), F.col("open_interest_contracts").cast("double")),
        "liquidation": (_sent(x, timestamp_ms=ms, side=F.when(i % 5 == 0, "long").when(i % 3 == 0, "sell"), quantity=F.col("amount").cast("string"), price=F.col("price").cast("string")), F.col("price").cast("double") * F.col("quantity").cast("double")),
    }
    parts = [events.events(raw, kind).select(F.lit(kind).alias("kind"), "market_type", "reject_reason", value.alias("value")) for kind, (raw, value) in sent.items()]
    return rounded(parts[0].union(parts[1]).union(parts[2]).groupBy("kind", "market_type", "reject_reason").agg(F.count("*").alias("n"), F.sum("value").alias("value")), "value", places=2)


@query("src14_trading_events", f"""{_T}, s AS (SELECT *, CASE WHEN trade_id % 19 = 0 THEN 'bad_version' WHEN trade_id % 13 = 0 THEN 'missing_field' WHEN trade_id % 7 = 0 THEN 'bad_direction' WHEN trade_id % 11 = 0 THEN 'bad_confidence' END AS signal, CASE WHEN trade_id % 19 = 0 THEN 'bad_version' WHEN trade_id % 13 = 0 THEN 'missing_field' END AS other,
  CASE WHEN trade_id % 19 = 0 THEN 'bad_version' WHEN trade_id % 7 = 0 THEN 'bad_direction' END AS refused FROM trades) SELECT kind, reject_reason, count(*) AS n FROM (SELECT unnest(['signal', 'approved_signal', 'rejected_signal', 'order_filled', 'order_rejected', 'position_opened', 'position_closed']) AS kind, unnest([signal, signal, refused, other, CASE WHEN trade_id % 19 = 0 THEN 'bad_version' END, other, other]) AS reject_reason FROM s) GROUP BY ALL""")
def src14_trading(spark, sf):
    i, x = F.col("trade_id"), _numbered(spark, sf)
    price, direction, own = F.when(i % 13 != 0, F.col("price")), F.when(i % 7 == 0, "up").otherwise(F.col("side")), F.col("event_id")
    signal = {"timeframe": F.lit("1h"), "direction": direction, "price": price, "confidence": F.when(i % 11 == 0, 1.5).when(i % 2 == 0, 0.5)}
    order = {"order_id": own, "side": F.col("side"), "size_pct": F.lit(0.05)}
    sent = {
        "signal": signal, "approved_signal": signal, "rejected_signal": {"direction": F.when(i % 7 == 0, "up"), "reason": F.lit("system_halted")},
        "order_filled": order | {"fill_price": price}, "order_rejected": order, "position_opened": order | {"side": F.lit("long"), "entry_price": price},
        "position_closed": order | {"entry_price": F.lit(1.0), "exit_price": price},
    }
    parts = [events.events(_sent(x, **fields), kind).select(F.lit(kind).alias("kind"), "reject_reason") for kind, fields in sent.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.groupBy("kind", "reject_reason").agg(F.count("*").alias("n"))


@query("snk9_trade_messages", f"""{_T} SELECT symbol AS key, trade_id, CAST(CAST(price AS DECIMAL(18,8)) AS VARCHAR) AS price, CAST(CAST(amount AS DECIMAL(18,8)) AS VARCHAR) AS amount FROM trades""")
def snk9_trades(spark, sf):
    rows = ts_ms(m.trades(spark, sf)).withColumns({c: F.col(c).cast("decimal(18,8)") for c in ("price", "amount")})
    sent = events.messages(rows, F.col("symbol"), *t.SERIES, "trade_id", "ts_ms", "price", "amount", "side")
    return sent.select("key", F.from_json("value", "trade_id bigint, price string, amount string").alias("v")).select("key", "v.*")


@query("snk10_gap_messages", f"""{m.BASE_SQL}, g AS (SELECT exchange, symbol, timeframe, lag(ts_ms) OVER (PARTITION BY exchange, symbol, timeframe ORDER BY ts_ms) AS start_ms, ts_ms FROM candles), d AS (SELECT *, 'g' || start_ms AS id FROM g WHERE ts_ms - start_ms > 2 * {HOUR})
  SELECT unnest(['gap_detected', 'gap_healed']) AS event_type, unnest([exchange || ':' || symbol || ':' || timeframe, id]) AS key, start_ms, true AS stamped FROM d""")
def snk10_gaps(spark, sf):
    c = ts_ms(m.candles(spark, sf))
    from pyspark.sql.window import Window

    start = F.lag("ts_ms").over(Window.partitionBy("exchange", "symbol", "timeframe").orderBy("ts_ms"))
    found = c.withColumn("start_ms", start).where(F.col("ts_ms") - F.col("start_ms") > 2 * HOUR)
    own = F.concat(F.lit("g"), F.col("start_ms").cast("string"))
    rows = found.select(F.explode(F.array(F.lit("gap_detected"), F.lit("gap_healed"))).alias("event_type"), own.alias("event_id"), own.alias("gap_event_id"), F.col("exchange").alias("exchange_id"), "symbol", "timeframe", "start_ms")
    sent = events.gap_messages(rows, m.NOW_MS)
    return sent.select("key", F.from_json("value", "event_type string, start_ms bigint, published_at_ms bigint").alias("v")).select("key", "v.event_type", "v.start_ms", (F.col("v.published_at_ms") == m.NOW_MS).alias("stamped"))


@query("snk11_metric_messages", f"{_T} SELECT 'src:price:' || CASE WHEN symbol < 'p' THEN symbol ELSE 'global' END AS key, count(*) AS n, round(sum(price), 2) AS value FROM trades GROUP BY ALL")
def snk11_metrics(spark, sf):
    rows = m.trades(spark, sf).select(F.lit("src").alias("source_id"), F.lit("price").alias("metric"), F.when(F.col("symbol") < "p", F.col("symbol")).alias("symbol"), F.col("price").cast("decimal(18,8)").alias("value"))
    sent = events.messages(rows, landed.external_key(), "source_id", "metric", "symbol", "value")
    return rounded(sent.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.get_json_object("value", "$.value").cast("double")).alias("value")), "value", places=2)


@query("flt20_promoted", "SELECT CASE event_id % 4 WHEN 0 THEN 'snapshot' ELSE 'signal' END AS kind, count(*) AS n FROM events WHERE event_id % 4 IN (0, 1) GROUP BY ALL")
def flt20_promoted(spark, sf):
    kinds = F.array(*map(F.lit, ("snapshot", "signal", "liquidation", "never heard of")))
    e = spark.read.parquet(f"{sf}/events.parquet").select(F.get(kinds, (F.col("event_id") % 4).cast("int")).alias("kind"))
    return events.promoted(e).groupBy("kind").agg(F.count("*").alias("n"))


# ---- validity -------------------------------------------------------------------------------------


@query("flt14_signals", f"{_T} SELECT CASE WHEN trade_id % 11 = 0 THEN 'bad_confidence' WHEN trade_id % 13 = 0 THEN 'bad_price' WHEN trade_id % 17 = 0 THEN 'no_symbol' WHEN trade_id % 19 = 0 THEN 'no_timeframe' WHEN trade_id % 23 = 0 THEN 'bad_quantity' END AS problem, trade_id % 3 <> 2 AS actionable, count(*) AS n FROM trades GROUP BY ALL")
def flt14_signals(spark, sf):
    i = F.col("trade_id")
    s = m.trades(spark, sf).select(
        F.when(i % 11 == 0, 1.01).otherwise(0.5).alias("confidence"), F.when(i % 13 == 0, 0.0).otherwise(1.0).alias("price"), F.when(i % 17 == 0, "").otherwise("s").alias("symbol"), F.when(i % 19 != 0, "1h").alias("timeframe"),
        F.when(i % 23 == 0, -1.0).when(i % 2 == 0, 1.0).alias("quantity"), rules.is_actionable(F.get(F.array(F.lit("buy"), F.lit("sell"), F.lit("hold")), (i % 3).cast("int"))).alias("actionable"),
    )
    return s.groupBy(rules.signal_problem().alias("problem"), "actionable").agg(F.count("*").alias("n"))


@query("flt16_positions", f"{_T} SELECT CASE WHEN trade_id % 5 = 0 THEN 'bad_side' WHEN trade_id % 7 = 0 THEN 'bad_quantity' WHEN trade_id % 11 = 0 THEN 'bad_entry' WHEN (trade_id % 30) / 20 NOT BETWEEN 0 AND 1 OR trade_id % 30 = 0 THEN 'bad_size' END AS problem, CASE WHEN (trade_id % 30) / 20 NOT BETWEEN 0 AND 1 OR trade_id % 30 = 0 THEN 'bad_size' WHEN trade_id % 7 = 0 THEN 'bad_quantity' END AS order_problem, count(*) AS n FROM trades GROUP BY ALL")
def flt16_positions(spark, sf):
    i = F.col("trade_id")
    p = m.trades(spark, sf).select(F.when(i % 5 == 0, "flat").otherwise("long").alias("side"), F.when(i % 7 == 0, 0.0).when(i % 5 != 0, F.col("amount")).otherwise(1.0).alias("quantity"), F.when(i % 11 != 0, 1.0).alias("avg_entry"), ((i % 30) / 20).alias("size_pct"))
    return p.groupBy(rules.position_problem().alias("problem"), rules.order_problem().alias("order_problem")).agg(F.count("*").alias("n"))


@query("flt17_trade_rules", f"{_T} SELECT CASE WHEN trade_id % 29 = 0 THEN 'no_symbol' WHEN trade_id % 23 = 0 THEN 'bad_time' WHEN trade_id % 11 = 0 OR trade_id % 7 = 0 OR NOT coalesce(price > 0, false) THEN 'bad_price' WHEN trade_id % 13 = 0 THEN 'bad_amount' WHEN trade_id % 5 = 0 THEN 'bad_source' END AS problem, count(*) AS n FROM trades GROUP BY ALL")
def flt17_rules(spark, sf):
    i = F.col("trade_id")
    x = ts_ms(m.trades(spark, sf)).withColumns({"symbol": F.when(i % 29 != 0, F.col("symbol")), "timestamp_ms": F.when(i % 23 == 0, 0).otherwise(F.col("ts_ms")), "price": F.when(i % 11 == 0, -1.0).when(i % 7 == 0, 0.0).otherwise(F.col("price")), "amount": F.when(i % 13 == 0, 0.0).otherwise(F.col("amount")), "source": F.when(i % 5 == 0, "telegraph").otherwise("live")})
    return x.groupBy(rules.trade_problem().alias("problem")).agg(F.count("*").alias("n"))


@query("flt12_slice_side", f"{_T} SELECT exchange, market_type, symbol, trade_id, ts_ms FROM trades WHERE ts_ms BETWEEN {m.NOW_MS - 10 * MS['1d']} AND {m.NOW_MS - 9 * MS['1d']} AND side = 'buy'")
def flt12_slice(spark, sf):
    return ts_ms(rules.sliced(m.trades(spark, sf), m.NOW_MS - 10 * MS["1d"], m.NOW_MS - 9 * MS["1d"], "buy")).select(*t.SERIES, "trade_id", "ts_ms")


@query("prj18_coerce_ts", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN event_id * 1000 WHEN event_id % 5 = 2 THEN event_id WHEN event_id % 5 = 3 THEN event_id + 7 END AS timestamp_ms FROM events")
def prj18_coerce(spark, sf):
    i, five = F.col("event_id"), F.col("event_id") % 5
    raw = F.when(five == 0, (i * 1000).cast("string")).when(five == 1, F.lit("true")).when(five == 2, i.cast("string")).when(five == 3, F.concat((i + 7).cast("string"), F.lit(".9"))).otherwise("12x")
    kind = F.when(five == 1, "bool").when(five == 3, "float").when(five == 0, "int").otherwise("string")
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", rules.coerced_ms(raw, kind).alias("timestamp_ms"))


@query("prj24_sources", "SELECT event_type, CASE event_type WHEN 'click' THEN 'live' WHEN 'view' THEN 'replay' ELSE 'backfill' END AS wire_source, count(*) AS n FROM events GROUP BY ALL")
def prj24_sources(spark, sf):
    source = F.when(F.col("event_type") == "click", "live").when(F.col("event_type") == "view", "replay").when(F.col("event_type") == "signup", "rest").otherwise("who knows")
    return spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type", rules.wire_source(source).alias("wire_source")).agg(F.count("*").alias("n"))


@query("prj19_symbol_filter", f"{_T} SELECT 'coinglass' AS source_id, 'funding' AS metric, upper(symbol) || '/USDT' AS symbol, count(*) AS n FROM trades WHERE symbol IN ('click', 'view') GROUP BY ALL")
def prj19_symbols(spark, sf):
    raw = m.trades(spark, sf).select(F.to_json(F.struct(F.concat(F.upper("symbol"), F.lit("-USDT-PERP")).alias("symbol"), F.lit("1").alias("rate"), F.unix_millis("timestamp").cast("string").alias("createdTime"))).alias("value"))
    wanted = spark.createDataFrame([("CLICK-USDT",), ("VIEW-USDT-SWAP",), ("NONE-USDT",)], "symbol string")
    return landed.metric_rows(raw, "coinglass", "funding", "rate", symbols=wanted).groupBy("source_id", "metric", "symbol").agg(F.count("*").alias("n"))


@query("gap15_replay", f"{_T} SELECT exchange, symbol, count(*) AS n, 'replay' AS source FROM trades WHERE ts_ms >= {m.NOW_MS - 10 * MS['1d']} AND ts_ms < {m.NOW_MS - 5 * MS['1d']} AND symbol = 'click' GROUP BY exchange, symbol UNION ALL SELECT exchange, symbol, count(*), 'replay' FROM trades WHERE ts_ms >= {m.NOW_MS - 2 * MS['1d']} AND symbol = 'view' GROUP BY exchange, symbol")
def gap15_replay(spark, sf):
    """One request of a bounded range, one that is open at its end."""
    requests = spark.createDataFrame([("r1", "click", m.NOW_MS - 10 * MS["1d"], m.NOW_MS - 5 * MS["1d"]), ("r2", "view", m.NOW_MS - 2 * MS["1d"], None)], "request_id string, symbol string, from_ms long, to_ms long")
    return gaps.replayed(m.trades(spark, sf), requests).groupBy("exchange", "symbol", "source").agg(F.count("*").alias("n"))
