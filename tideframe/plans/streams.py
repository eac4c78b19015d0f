"""Streaming queries over landed files that Spark derives from the given tables; most have their batch twin as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideframe.functions.timeframes import MS
from tideframe.operators import features
from tideframe.operators import trade_series as t
from tideframe.operators.resample import KEY
from tideframe.plans.core import FEATURES_SQL, GRADED_ISSUES_SQL, K
from tideframe.plans.register import long, query, rounded, ts_ms
from tideframe.plans.tables import trade_messages
from tideframe.sources import landed
from tideframe.sources import mappings as m
from tideframe.sources.events import events, gap_messages, messages
from tideframe.sources.ingest import incremental
from tideframe.sources.log_source import consume, publish
from tideframe.sources.snapshots import Lake, new_folder, wall_clock_ms
from tideframe.streaming import jobs, publishers

_GOOD = "trade_id % 29 <> 0 AND trade_id % 19 <> 0 AND trade_id % 17 <> 0 AND trade_id % 23 <> 0"
#: What trade_rows() and land_trades() accept: a price of nothing is no trade.
_KEPT = f"{_GOOD} AND coalesce(price > 0, false)"
_T = f"WITH {m.TRADES_SQL}"


def _trades(spark, sf) -> tuple[DataFrame, str]:
    folder = new_folder(spark)
    trade_messages(spark, sf).repartitionByRange(4, F.coalesce(F.get_json_object("value", "$.timestamp_ms").try_cast("bigint"), F.lit(0))).sortWithinPartitions(F.get_json_object("value", "$.timestamp_ms").try_cast("bigint")).write.text(f"{folder}/landed")
    return jobs.trade_rows(jobs.source(spark, f"{folder}/landed")), folder


@query("str5_window_candles", f"{_T}, good AS (SELECT * FROM trades WHERE {_KEPT}), last AS (SELECT max(ts_ms) AS newest FROM good), {m.candles_sql(MS['1d'], '1d', source='good')} SELECT c.* FROM candles c, last WHERE ts_ms + {MS['1d']} <= newest - {MS['1d']}")
def str5_candles(spark, sf):
    stream, folder = _trades(spark, sf)
    done = ts_ms(jobs.drain(jobs.window_candles(stream, "1d", "1 day", "1 day"), folder))
    newest = ts_ms(m.trades(spark, sf)).where(_KEPT).agg(F.max("ts_ms").alias("newest"))
    return done.crossJoin(newest).where(F.col("ts_ms") + MS["1d"] <= F.col("newest") - MS["1d"]).drop("newest")  # newest is one row


@query("ded7_str_once", f"{_T} SELECT exchange, symbol, CAST(trade_id AS VARCHAR) AS trade_id, ts_ms AS timestamp_ms FROM trades WHERE {_KEPT}")
def ded7_once(spark, sf):
    folder = new_folder(spark)
    sent = trade_messages(spark, sf)
    sent.union(sent).write.text(f"{folder}/landed")
    stream = jobs.once(jobs.trade_rows(jobs.source(spark, f"{folder}/landed")), "400 days")
    return jobs.drain(stream, folder).select("exchange", "symbol", "trade_id", "timestamp_ms")


@query("str8_monotonic", f"{_T} SELECT exchange, symbol, CAST(trade_id AS VARCHAR) AS trade_id, ts_ms AS timestamp_ms, price FROM trades WHERE {_KEPT}")
def str8_monotonic(spark, sf):
    stream, folder = _trades(spark, sf)
    return jobs.drain(jobs.monotonic(stream), folder).drop("source")


@query("str8_sources", f"{_T}, s AS (SELECT *, CASE WHEN exchange = 'ex0' AND trade_id % 5 = 0 THEN 'replay' WHEN trade_id % 2 = 0 OR symbol = 'error' THEN 'rest' ELSE 'ws' END AS source FROM trades) SELECT exchange, symbol, source, count(*) AS n FROM s WHERE source = CASE WHEN exchange = 'ex0' THEN 'replay' WHEN symbol = 'error' THEN 'rest' ELSE 'ws' END GROUP BY ALL")
def str8_sources(spark, sf):
    """Trades of up to three sources in two batches: a series keeps to the best one of its first batch."""
    folder, i = new_folder(spark), F.col("trade_id")
    source = F.when((F.col("exchange") == "ex0") & (i % 5 == 0), "replay").when((i % 2 == 0) | (F.col("symbol") == "error"), "rest").otherwise("ws")
    rows = ts_ms(m.trades(spark, sf)).select("exchange", "symbol", i.cast("string").alias("trade_id"), F.col("ts_ms").alias("timestamp_ms"), "price", source.alias("source"))
    middle = rows.agg(F.percentile_approx("timestamp_ms", 0.5)).first()[0]
    for late in (False, True):
        rows.where((F.col("timestamp_ms") > middle) == late).coalesce(1).write.mode("append").json(f"{folder}/landed")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).json(f"{folder}/landed")
    return jobs.drain(jobs.monotonic(stream), folder).groupBy("exchange", "symbol", "source").agg(F.count("*").alias("n"))


#: Trades of which one symbol ends days early and others have disconnects after some of them; the clock goes on to NOW_MS.
_END = m.NOW_MS - 4 * MS["1d"]
_E = f"""{_T}, g AS (SELECT * FROM trades WHERE {_GOOD} AND (symbol <> 'click' OR ts_ms < {_END})), e AS (SELECT exchange, symbol, ts_ms, true AS trade FROM g UNION ALL SELECT exchange, symbol, ts_ms + 1, false FROM g WHERE trade_id % 41 = 0),
  k AS (SELECT *, count(*) FILTER (trade) OVER (PARTITION BY exchange, symbol ORDER BY ts_ms, trade) AS n FROM e), y AS (SELECT exchange, symbol, n, max(ts_ms) FILTER (trade) AS last, bool_or(NOT trade) AS cut FROM k GROUP BY ALL), z AS (SELECT exchange, symbol, last + 1 AS from_ms, lead(last) OVER (PARTITION BY exchange, symbol ORDER BY n) AS to_ms, cut FROM y)"""


@query("str9_silence", f"""{_E} SELECT exchange, symbol, from_ms, coalesce(to_ms, {m.NOW_MS}) AS to_ms, CASE WHEN cut THEN 'disconnect' ELSE 'silence' END AS cause, CASE WHEN to_ms IS NULL THEN 'open' ELSE 'closed' END AS status FROM z
  WHERE coalesce(to_ms, {m.NOW_MS}) > from_ms AND (cut OR coalesce(to_ms, {m.NOW_MS}) - from_ms + 1 > 7200000)""")
def str9_silence(spark, sf):
    """Trades, disconnects after some of them, and at last only the clock: gaps that a trade ended are closed, those of feeds that ended stay open."""
    folder, good = new_folder(spark), ts_ms(m.trades(spark, sf)).where(_GOOD.replace("<>", "!=")).where(f"symbol != 'click' OR ts_ms < {_END}")
    e = good.select("exchange", "symbol", F.col("ts_ms").alias("timestamp_ms"), F.when(F.col("trade_id") % 2 == 0, "trade").alias("event"))
    e = e.union(good.where("trade_id % 41 = 0").select("exchange", "symbol", F.col("ts_ms") + 1, F.lit("disconnect")))
    e.repartitionByRange(4, "timestamp_ms").sortWithinPartitions("timestamp_ms").write.json(f"{folder}/landed")
    events = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 8).json(f"{folder}/landed")
    jobs.drain(jobs.silence_gaps(events, 7_200_000), folder)
    spark.createDataFrame([("clock", "clock", m.NOW_MS, "tick")], e.schema).write.mode("append").json(f"{folder}/landed")
    told = jobs.drain(jobs.silence_gaps(events, 7_200_000), folder)  # the same stream, started again
    now = F.when(F.col("status") == "open", F.lit(m.NOW_MS)).otherwise(F.col("to_ms"))  # an open gap was told at the time known then
    return jobs.latest_gaps(told).withColumn("to_ms", now)


@query("str9_recovered", f"{_T}, y AS (SELECT exchange, symbol, lag(ts_ms) OVER (PARTITION BY exchange, symbol ORDER BY ts_ms) + 1 AS from_ms, ts_ms AS to_ms FROM trades WHERE trade_id % 3 = 0), g AS (SELECT * FROM y WHERE to_ms - from_ms + 1 > 7200000) SELECT exchange, symbol, 'recovery' AS source, count(*) AS n FROM trades t WHERE EXISTS (SELECT 1 FROM g WHERE g.exchange = t.exchange AND g.symbol = t.symbol AND ts_ms >= from_ms AND ts_ms < to_ms) GROUP BY ALL")
def str9_recovered(spark, sf):
    """A stream that saw a third of the trades; the others that lie in its gaps come back with a tag."""
    t = ts_ms(m.trades(spark, sf)).select("exchange", "symbol", "trade_id", F.col("ts_ms").alias("timestamp_ms"))
    folder = new_folder(spark)
    t.where("trade_id % 3 = 0").write.json(f"{folder}/landed")
    gaps = jobs.drain(jobs.silence_gaps(spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1000).json(f"{folder}/landed"), 7_200_000), folder)
    return jobs.recovered(t, gaps.where("status = 'closed'")).groupBy("exchange", "symbol", "source").agg(F.count("*").alias("n"))


@query("str1_bronze", f"{m.BASE_SQL} SELECT {K}, ts_ms, open, high, low, close, volume FROM candles")
def str1_bronze(spark, sf):
    folder = new_folder(spark)
    good = landed.candle_messages(m.candles(spark, sf), "r1").select("value")
    good.union(good.limit(1)).union(good.select(F.lit("{broken").alias("value")).distinct()).coalesce(2).write.text(f"{folder}/landed")
    lake = Lake(spark, folder)
    jobs.drain_batches(jobs.source(spark, f"{folder}/landed"), jobs.land_candles(lake, "bronze", f"{folder}/dead"), folder)
    return ts_ms(lake.candles("bronze")).select(*KEY, "ts_ms", "open", "high", "low", "close", "volume")


@query("str1_two_streams", f"{m.BASE_SQL} SELECT {K}, count(*) AS candles, round(sum(close), 3) AS close, CASE WHEN exchange = 'ex0' THEN 2 ELSE 1 END AS commits, count(*) * CASE WHEN exchange = 'ex0' THEN 2 ELSE 1 END AS landed, true AS fresh FROM candles GROUP BY {K}")
def str1_two_streams(spark, sf):
    """A stream for each venue into one table, both restarted with nothing new, and one again with a new checkpoint: nothing is lost, nothing is there twice."""
    folder, c = new_folder(spark), m.candles(spark, sf).persist()
    lake = Lake(spark, folder)
    for venue in ("ex0", "ex1"):
        landed.candle_messages(c.where(F.col("exchange") == venue), "r1").select("value").coalesce(1).write.text(f"{folder}/landed/{venue}")
    for venue, checkpoint in (("ex0", "a"), ("ex1", "b"), ("ex0", "a"), ("ex1", "b"), ("ex0", "c")):
        jobs.drain_batches(jobs.source(spark, f"{folder}/landed/{venue}"), jobs.land_candles(lake, "bronze", f"{folder}/dead"), f"{folder}/{checkpoint}")
    c.unpersist()
    rows = lake.candles("bronze").groupBy(*KEY).agg(F.count("*").alias("candles"), F.round(F.sum("close"), 3).alias("close"))
    log = lake.versions("bronze").groupBy(*(F.col(k).alias(f"_{k}") for k in KEY)).agg(F.count("*").alias("commits"), F.sum("added_rows").alias("landed"))
    known = rows.join(log, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]).drop(*(f"_{k}" for k in KEY))
    return known.withColumn("fresh", F.lit(lake.fresh("bronze", wall_clock_ms())))


@query("str1_correction", f"{m.BASE_SQL} SELECT {K}, ts_ms, close + CASE WHEN ts_ms // 3600000 % 3 = 0 THEN 1 ELSE 0 END AS close FROM candles")
def str1_correction(spark, sf):
    """A batch commit of all candles, then a stream that corrects a third of them: its rows are newer."""
    folder, c = new_folder(spark), m.candles(spark, sf)
    lake = Lake(spark, folder)
    lake.commit(c, "bronze", 1, m.NOW_MS)
    third = c.where(F.floor(F.unix_millis("timestamp") / F.lit(3_600_000)) % 3 == 0)
    fixed = third.withColumns({"close": F.col("close") + 1, "high": F.col("high") + 1})
    landed.candle_messages(fixed, "r2").select("value").coalesce(1).write.text(f"{folder}/landed")
    jobs.drain_batches(jobs.source(spark, f"{folder}/landed"), jobs.land_candles(lake, "bronze", f"{folder}/dead"), folder)
    return ts_ms(lake.candles("bronze")).select(*KEY, "ts_ms", "close")


@query("str6_features", f"{FEATURES_SQL} SELECT {K}, ts_ms, {', '.join(f'round({f}, 6) AS {f}' for f in features.FEATURES[:-1])}, is_suspect, false AS late FROM f2")
def str6_features(spark, sf):
    """All candles on a stream in six batches, the last hours of each batch wrong at first and corrected by the next one, with a gap of days between batches; all nine features."""
    folder, c = new_folder(spark), m.candles(spark, sf).persist()
    ms = F.unix_millis("timestamp")
    first, last = c.agg(F.min(ms), F.max(ms)).first()
    step, columns = (last - first) // 6 + 1, [*KEY, "timestamp", "open", "high", "low", "close", "volume"]
    before = None
    for k in range(6):
        own = c.where(ms.between(first + k * step, first + (k + 1) * step - 1)).select(*columns)
        wrong = ms > first + (k + 1) * step - 8 * MS["1h"]
        batch = own.withColumn("close", F.when(wrong & F.lit(k < 5), F.col("close") + 7).otherwise(F.col("close")))
        (batch if before is None else batch.unionByName(before)).coalesce(1).write.mode("append").parquet(f"{folder}/landed")
        before = own.where(wrong)
    c.unpersist()
    stream = spark.readStream.schema(before.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
    told = jobs.latest_features(jobs.drain(jobs.features_stream(stream), folder))
    return rounded(ts_ms(told).select(*KEY, "ts_ms", *features.FEATURES, "late"), *features.FEATURES[:-1])


#: Candles of every grade, an event for each series and week.
_EVENTS_SQL = GRADED_ISSUES_SQL.replace(m.GRADED_SQL, m.GRADED_SQL.replace("candles AS (SELECT exchange, market_type, symbol,", f"candles AS (SELECT exchange, market_type, symbol || '#' || CAST(ts_ms // {landed.CHUNK_MS} AS VARCHAR) AS symbol,"))


@query("str3_dq18_gate", f"{_EVENTS_SQL}, t AS (SELECT *, CASE decision WHEN 'reject' THEN 'rejected' WHEN 'accept' THEN 'clean' ELSE 'flagged' END AS tier FROM decided) SELECT * REPLACE (split_part(symbol, '#', 1) AS symbol), split_part(symbol, '#', 2) AS chunk FROM (SELECT {K}, tier, rows AS rows_in, CASE WHEN tier = 'rejected' THEN 0 ELSE rows END AS rows_out, CASE WHEN reasons = '' THEN 'success' ELSE 'partial' END AS status, round(score, 6) AS quality_score FROM t)")
def str3_gate(spark, sf):
    """Candle events of every grade through the quality gate, in several batches: what each event left in lineage, and its rows in either sink."""
    folder = new_folder(spark)
    landed.candle_messages(m.graded(spark, sf), "r1", strict=False).select("value").repartition(3).write.text(f"{folder}/landed")
    jobs.drain_batches(jobs.source(spark, f"{folder}/landed", 1), jobs.quality_gate(m.NOW_MS, folder), folder)
    by = [*KEY, "event_id"]
    sinks = [spark.read.parquet(f"{folder}/{sink}").groupBy(*by, "tier").agg(F.count("*").alias("n")) for sink in ("validated", "rejected")]
    steps = spark.read.parquet(f"{folder}/lineage").select(*by, "rows_in", "rows_out", "status", "quality_score")
    told = steps.join(sinks[0].union(sinks[1]), by).where("n = rows_in").withColumn("chunk", F.substring_index("event_id", "-", -1))
    return rounded(told.select(*KEY, "chunk", "tier", "rows_in", long("rows_out").alias("rows_out"), "status", "quality_score"), "quality_score")


@query("str4_str7_window_totals", f"{_T}, good AS (SELECT * FROM trades WHERE {_KEPT}), last AS (SELECT max(ts_ms) AS newest FROM good), w AS (SELECT exchange, market_type, symbol, ts_ms - ts_ms % {MS['1d']} AS window_start_ms, count(*) AS trade_count, CAST(sum(amount) AS DOUBLE) AS total_volume, round(sum(price * amount) / sum(amount), 6) AS vwap FROM good GROUP BY ALL) SELECT w.* FROM w, last WHERE window_start_ms + {MS['1d']} <= newest - {MS['1d']}")
def str4_totals(spark, sf):
    """Window totals on a stream that waits for late trades as long as the calibrated lateness says."""
    stream, folder = _trades(spark, sf)
    late = t.lateness(m.candles(spark, sf).select("exchange", "timeframe", (F.col("volume") * 30_000).alias("delay_ms")))
    done = jobs.drain(jobs.window_totals(stream, "1 day", jobs.calibrated_delay(late)), folder)
    newest = ts_ms(m.trades(spark, sf)).where(_KEPT).agg(F.max("ts_ms").alias("newest"))
    df = done.crossJoin(newest).where(F.col("window_start_ms") + MS["1d"] <= F.col("newest") - MS["1d"])  # newest is one row
    return rounded(df.select(*t.SERIES, "window_start_ms", "trade_count", F.col("total_volume").cast("double").alias("total_volume"), "vwap"), "vwap")


@query("snk6_str_trades", f"{_T} SELECT 'kept' AS what, NULL AS reject_reason, count(*) AS n FROM trades WHERE {_KEPT} UNION ALL SELECT 'dead', CASE WHEN trade_id % 29 = 0 THEN 'undecodable' WHEN trade_id % 19 = 0 THEN 'bad_version' WHEN trade_id % 17 = 0 THEN 'bad_source' ELSE 'bad_trade' END, count(*) FROM trades WHERE NOT ({_KEPT}) GROUP BY ALL")
def snk6_stream(spark, sf):
    """Trade events, each sent twice in different files, land once; what is wrong goes to the dead letters once for each time it was sent and had no id."""
    folder = new_folder(spark)
    sent = trade_messages(spark, sf)
    sent.union(sent.where("value != '{broken'")).repartition(6).write.text(f"{folder}/landed")
    lake = Lake(spark, folder)
    jobs.drain_batches(jobs.first_seen(jobs.source(spark, f"{folder}/landed", 2)), jobs.land_trades(lake, "trades", f"{folder}/dead"), folder)
    kept = lake.newest_rows("trades").agg(F.count("*").alias("n")).select(F.lit("kept").alias("what"), F.lit(None).cast("string").alias("reject_reason"), "n")
    return kept.union(spark.read.parquet(f"{folder}/dead").groupBy(F.lit("dead").alias("what"), "reject_reason").agg(F.count("*").alias("n")))


#: Book events: three levels a side as a snapshot at each 500th event of a book, changes else; one event in 701 is lost. Of three batches, every second
#: snapshot comes one later than its changes; what is left out in between makes books wait.
_BOOK = f"""{_T}, e AS (SELECT exchange, symbol, CASE side WHEN 'buy' THEN 'bid' ELSE 'ask' END AS side, floor(price / 10) AS price, CASE WHEN trade_id % 6 = 0 THEN 0.0 ELSE amount END AS qty, trade_id, row_number() OVER (PARTITION BY exchange, symbol ORDER BY trade_id) AS seq FROM trades), n3 AS (SELECT max(seq) AS top FROM e),
  r AS (SELECT exchange, symbol, seq, 'delta' AS kind, side, price, qty FROM e WHERE seq % 500 <> 7 AND trade_id % 701 <> 0 UNION ALL SELECT exchange, symbol, seq, 'snapshot', l.side, CAST(l.price AS DOUBLE), 1.0 FROM e, (VALUES ('bid', 1), ('bid', 2), ('ask', 900), ('ask', 901)) AS l(side, price) WHERE seq % 500 = 7),
  b AS (SELECT exchange, symbol, max(seq) AS seen, max(seq) FILTER (kind = 'snapshot') AS base FROM r GROUP BY ALL),
  f AS (SELECT r.*, b.base FROM r JOIN b USING (exchange, symbol) WHERE r.seq >= b.base), n AS (SELECT exchange, symbol, seq, lag(seq) OVER (PARTITION BY exchange, symbol ORDER BY seq) AS before FROM (SELECT DISTINCT exchange, symbol, seq FROM f)), g AS (SELECT exchange, symbol, min(before) AS held FROM n WHERE seq - before > 1 GROUP BY ALL),
  z AS (SELECT b.exchange, b.symbol, seen, base, CASE WHEN base IS NULL THEN -1 ELSE coalesce(held, seen) END AS seq FROM b LEFT JOIN g USING (exchange, symbol)),
  live AS (SELECT f.exchange, f.symbol, f.side, f.price, arg_max(f.qty, f.seq) AS qty FROM f JOIN z USING (exchange, symbol) WHERE f.seq <= z.seq GROUP BY ALL)"""


def _book_told(spark, sf) -> DataFrame:
    """Books' rows over three batches and late snapshots; these find their changes waiting, or others in their place."""
    from pyspark.sql.window import Window

    folder, i = new_folder(spark), F.col("trade_id")
    seq = F.row_number().over(Window.partitionBy("exchange", "symbol").orderBy("trade_id")).cast("long")
    e = m.trades(spark, sf).select("exchange", "symbol", "trade_id", seq.alias("seq"), F.when(F.col("side") == "buy", "bid").otherwise("ask").alias("side"), F.floor(F.col("price") / 10).cast("double").alias("price"), F.when(i % 6 == 0, 0.0).otherwise(F.col("amount")).alias("qty")).persist()
    changes = e.where("seq % 500 != 7 AND trade_id % 701 != 0").select("exchange", "symbol", "seq", F.lit("delta").alias("kind"), "side", "price", "qty")
    levels = F.array(*(F.struct(F.lit(s).alias("side"), F.lit(p).alias("price"), F.lit(1.0).alias("qty")) for s, p in (("bid", 1.0), ("bid", 2.0), ("ask", 900.0), ("ask", 901.0))))
    whole = e.where("seq % 500 = 7").select("exchange", "symbol", "seq", F.lit("snapshot").alias("kind"), F.inline(levels))
    rows = changes.union(whole)
    last = e.agg(F.max("seq")).first()[0]
    due = F.floor((F.col("seq") - 1) * 3 / F.lit(last)) + ((F.col("kind") == "snapshot") & (F.col("seq") % 1000 == 7)).cast("int")
    for k in range(4):  # four batches, in the order of events but for late snapshots: all files of one land before the stream goes on
        rows.where(due == k).write.mode("append").json(f"{folder}/landed")
        stream = spark.readStream.schema(rows.schema).json(f"{folder}/landed")
        told = jobs.drain(jobs.book_stream(stream, 100_000), folder)
    e.unpersist()
    return told


@query("str10_book", f"{_BOOK} SELECT z.exchange, z.symbol, z.seq, seen, base IS NOT NULL AND z.seq = seen AS ready, max(price) FILTER (side = 'bid' AND qty > 0) AS best_bid, min(price) FILTER (side = 'ask' AND qty > 0) AS best_ask, count(*) FILTER (qty > 0) AS levels FROM z LEFT JOIN live USING (exchange, symbol) GROUP BY ALL")
def str10_book(spark, sf):
    """Books as they are after the last batch: each holds what follows on its newest snapshot without a hole, and is ready if that is all."""
    return jobs.books(_book_told(spark, sf))


@query("str10_snk10_gaps", f"""{_BOOK}, d AS (SELECT DISTINCT exchange, symbol, seq, CAST(floor((seq - 1) * 3 / (SELECT top FROM n3)) AS BIGINT) + CASE WHEN kind = 'snapshot' AND seq % 1000 = 7 THEN 1 ELSE 0 END AS due FROM r),
  w AS (SELECT *, max(seq) OVER (PARTITION BY exchange, symbol ORDER BY due, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_before FROM d), h AS (SELECT w.exchange, w.symbol, seen_before + 1 AS from_seq, w.seq - 1 AS to_seq, w.seq - 1 <= z.seq AS healed FROM w JOIN z USING (exchange, symbol) WHERE w.seq > seen_before + 1)
  SELECT exchange || ':' || symbol || ':book' AS key, 'gap_detected' AS event_type, from_seq, to_seq FROM h UNION ALL SELECT exchange || ':' || symbol || ':' || from_seq || ':' || to_seq, 'gap_healed', from_seq, to_seq FROM h WHERE healed""")
def str10_gaps(spark, sf):
    """The same state's second output: each hole is one message, and one more when its book has got beyond it."""
    sent = gap_messages(jobs.book_gaps(_book_told(spark, sf)), m.NOW_MS)
    return sent.select("key", F.inline(F.array(F.from_json("value", "event_type string, from_seq long, to_seq long"))))


@query("str13_profiles", f"""{_T}, s AS (SELECT symbol, trade_id, trade_id % 3 AS batch FROM trades) SELECT 'bronze' AS profile, symbol, count(*) AS events, count(DISTINCT trade_id) AS ids, min(batch) AS first_batch FROM s GROUP BY symbol
  UNION ALL SELECT 'trading', symbol, count(*), count(DISTINCT trade_id), min(batch) FROM s WHERE batch > 0 GROUP BY symbol""")
def str13_profiles(spark, sf):
    """One log, two kinds of consumer: both start when it has one batch, one from the earliest and one from the latest; a batch later both go on, and once more from their checkpoints."""
    folder = new_folder(spark)
    rows = m.trades(spark, sf).withColumn("batch", F.col("trade_id") % 3)
    batches = [messages(rows.where(F.col("batch") == k), F.col("symbol"), "symbol", "trade_id") for k in range(3)]
    for batch in (batches[0], batches[1], batches[2], None):
        if batch is not None:
            publish(batch, f"{folder}/log")
        told = {p: jobs.drain(consume(spark, f"{folder}/log", p), f"{folder}/{p}") for p in ("bronze", "trading")}
    read = lambda p: told[p].select(F.lit(p).alias("profile"), F.inline(F.array(F.from_json("value", "symbol string, trade_id long"))), "seq")
    return read("bronze").union(read("trading")).groupBy("profile", "symbol").agg(F.count("*").alias("events"), F.count_distinct("trade_id").alias("ids"), F.min("seq").alias("first_batch"))


#: Market rows of five kinds, of which some lack a time, have an unknown side, or no value; each is refused for the reason of its kind.
_MARKET = f"""{_T}, k AS (SELECT exchange, symbol, trade_id, price, CASE trade_id % 5 WHEN 0 THEN 'snapshot' WHEN 1 THEN 'delta' WHEN 2 THEN 'funding' WHEN 3 THEN 'open_interest' ELSE 'liquidation' END AS kind FROM trades),
  j AS (SELECT *, CASE WHEN trade_id % 13 = 0 OR (trade_id % 17 = 0 AND kind <> 'snapshot') THEN 'missing_field' WHEN trade_id % 11 = 0 AND kind IN ('delta', 'liquidation') THEN 'bad_side' END AS reason FROM k)"""


@query("snk15_published", f"""{_MARKET}, t AS (SELECT *, CASE WHEN kind IN ('snapshot', 'delta') THEN 'orderbook.raw' WHEN kind = 'open_interest' THEN 'oi.raw' WHEN kind = 'liquidation' THEN 'liquidations.raw' ELSE 'funding.raw' END AS topic FROM j)
  SELECT topic, kind, exchange || ':' || symbol AS key, reason AS reject_reason, count(*) AS n, CASE WHEN reason IS NULL AND kind <> 'snapshot' THEN round(sum(round(price, 4)), 2) END AS value FROM t GROUP BY topic, kind, exchange, symbol, reason""")
def snk15_published(spark, sf):
    """Streams of market rows through the publishers into four logs, a stream for each; a consumer reads each log from its start, and the failed rows are told beside."""
    folder, i = new_folder(spark), F.col("trade_id")
    kind = F.get(F.array(*map(F.lit, publishers.TOPICS)), (i % 5).cast("int"))
    number = F.when(i % 17 != 0, F.col("price").cast("decimal(18,4)"))
    level = lambda up: F.array(F.array((F.col("price") + (1 if up else -1)).cast("decimal(18,4)").cast("string"), F.lit("1")))
    side = F.when(i % 11 == 0, "up").when(i % 5 == 1, F.when(F.col("side") == "buy", "bid").otherwise("ask")).otherwise(F.col("side"))
    rows = ts_ms(m.trades(spark, sf)).select("exchange", "symbol", kind.alias("kind"), F.when(i % 13 != 0, F.col("ts_ms")).alias("timestamp_ms"), level(False).alias("bids"), level(True).alias("asks"), side.alias("side"), number.alias("price"), *(number.alias(c) for c in ("funding_rate", "open_interest_contracts")), F.lit(1).cast("decimal(18,4)").alias("size"), F.lit(1).cast("decimal(18,4)").alias("quantity"))
    tasks = spark.sparkContext.defaultParallelism
    rows.repartition(2 * tasks).write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", tasks).parquet(f"{folder}/landed")  # two batches, each of as many files as tasks
    value = {"delta": "price", "funding": "funding_rate", "open_interest": "open_interest_contracts", "liquidation": "price"}
    told = []
    for topic in dict.fromkeys(publishers.TOPICS.values()):
        kinds = [k for k, t_ in publishers.TOPICS.items() if t_ == topic]
        jobs.drain_batches(stream.where(F.col("kind").isin(kinds)), publishers.publisher(kinds, folder), f"{folder}/{topic}-stream")
        read = jobs.drain(consume(spark, f"{folder}/{topic}", "bronze"), f"{folder}/{topic}-read")
        named = F.get_json_object("value", "$.payload_type")
        for k in kinds:
            got = events(read.where(named == k) if k in publishers.NAMED else read, k, keep="key")
            told.append(got.select(F.lit(topic).alias("topic"), F.lit(k).alias("kind"), "key", "reject_reason", F.lit(None).cast("double").alias("value") if k == "snapshot" else F.col(value[k]).cast("double").alias("value")))
    failed = spark.read.parquet(f"{folder}/failed").select("topic", "kind", "key", "reject_reason", F.lit(None).cast("double").alias("value"))
    every = told[0]
    for part in (*told[1:], failed):
        every = every.unionByName(part)
    return rounded(every.groupBy("topic", "kind", "key", "reject_reason").agg(F.count("*").alias("n"), F.sum("value").alias("value")), "value", places=2)


_PAST = m.NOW_MS - 12 * MS["1d"]
_NEW_SQL = GRADED_ISSUES_SQL.replace("h % 40 = 0))", f"h % 40 = 0) AND (exchange <> 'ex0' OR ts_ms > {_PAST}) AND NOT (exchange = 'ex1' AND symbol = 'click'))")


@query("gap14_incremental", f"""{_NEW_SQL}, s AS (SELECT DISTINCT exchange, market_type, symbol, '1h' AS timeframe FROM base), one AS (SELECT s.*, CASE WHEN rows IS NULL THEN 'skipped' WHEN decision = 'reject' THEN 'rejected' ELSE 'published' END AS status, coalesce(rows, 0) AS rows FROM s LEFT JOIN decided USING ({K}))
  SELECT 1 AS run, *, CASE status WHEN 'published' THEN rows ELSE 0 END AS sent FROM one UNION ALL SELECT 2, {K}, CASE status WHEN 'published' THEN 'skipped' ELSE status END, CASE status WHEN 'rejected' THEN rows ELSE 0 END, 0 FROM one""")
def gap14_incremental(spark, sf):
    """Two runs of one chain: what is new is judged and published, cursors follow what was published, and the second run finds only what was rejected."""
    folder, c = new_folder(spark), m.graded(spark, sf)
    cursor = F.when(F.col("exchange") == "ex0", _PAST).when(F.col("symbol") == "click", m.NOW_MS)
    cursors = c.select(*KEY).distinct().withColumn("cursor_ms", cursor.cast("long"))
    told = []
    for run in (1, 2):
        report, cursors = incremental(c, cursors, f"{folder}/log", f"r{run}", m.NOW_MS)
        told.append(report.select(F.lit(run).alias("run"), *KEY, "status", "rows", "sent"))
    return told[0].union(told[1])


@query("str12_fan_out", f"{_T} SELECT exchange, count(*) AS kept, count(*) FILTER (side = 'buy') AS buys FROM trades WHERE {_KEPT} GROUP BY exchange")
def str12_fan_out(spark, sf):
    stream, folder = _trades(spark, sf)
    sink = lambda name, keep: lambda batch, n: batch.where(keep).write.mode("overwrite").parquet(f"{folder}/{name}/batch={n}")
    jobs.drain_batches(stream, jobs.fan_out(sink("every", "true"), sink("buys", "side = 'buy'")), folder)
    every = spark.read.parquet(f"{folder}/every").groupBy("exchange").agg(F.count("*").alias("kept"))
    return every.join(spark.read.parquet(f"{folder}/buys").groupBy("exchange").agg(F.count("*").alias("buys")), "exchange").select("exchange", long("kept").alias("kept"), "buys")
