"""Market tables derived from the given tables by fixed mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.operators.resample import candles_from_trades

KEY = ["exchange", "market_type", "symbol", "timeframe"]


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as trades: a symbol for each event type, two venues by user, prices from values."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        F.concat(F.lit("ex"), (F.col("user_id") % 2).cast("string")).alias("exchange"),
        F.lit("spot").alias("market_type"),
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("price"),
        (1 + F.col("user_id") % 10).cast("double").alias("amount"),
        F.when(F.col("event_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.col("user_id").alias("account"),
    )


TRADES_SQL = """trades AS (SELECT 'ex' || CAST(user_id % 2 AS VARCHAR) AS exchange, 'spot' AS market_type, event_type AS symbol, event_id AS trade_id,
  epoch_us(ts) // 1000 AS ts_ms, value AS price, CAST(1 + user_id % 10 AS DOUBLE) AS amount, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, user_id AS account FROM events)"""


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as trades: a symbol for each return flag, unit prices."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.select(
        F.lit("ex0").alias("exchange"),
        F.lit("spot").alias("market_type"),
        F.col("l_returnflag").alias("symbol"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("amount"),
        F.when(F.col("l_linenumber") % 2 == 1, "buy").otherwise("sell").alias("side"),
        F.col("l_suppkey").alias("account"),
    )


SHIPMENTS_SQL = """trades AS (SELECT 'ex0' AS exchange, 'spot' AS market_type, l_returnflag AS symbol, l_orderkey * 10 + l_linenumber AS trade_id, epoch_us(l_shipdate) // 1000 AS ts_ms,
  l_extendedprice / nullif(l_quantity, 0) AS price, l_quantity AS amount, CASE WHEN l_linenumber % 2 = 1 THEN 'buy' ELSE 'sell' END AS side, l_suppkey AS account FROM lineitem)"""


def candles(spark: SparkSession, sf_dir: str, timeframe: str = "1h") -> DataFrame:
    return candles_from_trades(trades(spark, sf_dir), timeframe)


def candles_sql(ms: int = 3_600_000, timeframe: str = "1h", name: str = "candles", source: str = "trades") -> str:
    return f"""{name} AS (SELECT exchange, market_type, symbol, '{timeframe}' AS timeframe, ts_ms - ts_ms % {ms} AS ts_ms, arg_min(price, (ts_ms, trade_id)) AS open,
  max(price) AS high, min(price) AS low, arg_max(price, (ts_ms, trade_id)) AS close, sum(amount) AS volume FROM {source} GROUP BY exchange, market_type, symbol, ts_ms - ts_ms % {ms})"""


BASE_SQL = f"WITH {TRADES_SQL}, {candles_sql()}"

#: The fixed present of all queries: the first moment after the events.
NOW_MS = 1_706_659_200_000


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles with one defective copy of some of them, chosen by the hour; seq tells arrival."""
    c = candles(spark, sf_dir).withColumn("seq", F.lit(0))
    hour = F.floor(F.unix_millis("timestamp") / F.lit(3_600_000))
    bad = c.where(hour % 23 < 8).withColumn("kind", (hour % 23).cast("int")).withColumn("seq", F.lit(1))
    shift = lambda ms: F.timestamp_millis(F.unix_millis("timestamp") + ms)
    k = F.col("kind")
    bad = bad.withColumns({
        "close": F.when(k == 0, F.lit(None)).when(k == 3, F.col("high") + 1).otherwise(F.col("close")),
        "volume": F.when(k == 1, F.lit(float("nan"))).when(k == 5, F.lit(-1.0)).when(k == 6, F.lit(0.0)).otherwise(F.col("volume")),
        "high": F.when(k == 2, F.col("low") - 1).otherwise(F.col("high")),
        "open": F.when(k == 4, F.col("low") - 1).otherwise(F.col("open")),
        "timestamp": F.when(k == 7, shift(7000)).otherwise(F.col("timestamp")),
    })
    return c.union(bad.drop("kind").select(c.columns))


PLANTED_SQL = f"""{BASE_SQL}, marked AS (SELECT *, (ts_ms // 3600000) % 23 AS kind FROM candles),
planted AS (SELECT exchange, market_type, symbol, timeframe, ts_ms, open, high, low, close, volume, 0 AS seq FROM candles UNION ALL
  SELECT exchange, market_type, symbol, timeframe, CASE WHEN kind = 7 THEN ts_ms + 7000 ELSE ts_ms END, CASE WHEN kind = 4 THEN low - 1 ELSE open END, CASE WHEN kind = 2 THEN low - 1 ELSE high END, low,
    CASE WHEN kind = 0 THEN NULL WHEN kind = 3 THEN high + 1 ELSE close END, CASE WHEN kind = 1 THEN 'nan'::DOUBLE WHEN kind = 5 THEN -1 WHEN kind = 6 THEN 0 ELSE volume END, 1 FROM marked WHERE kind < 8)"""


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles on the whole grid of each series' time, of every grade by symbol: click without a defect, view with flat candles, error with closes
    above their highs, purchase with hours left out, and whatever else with a few outliers."""
    c, ms = candles(spark, sf_dir), F.unix_millis("timestamp")
    span = c.groupBy("exchange", "market_type", "symbol").agg(F.min(ms).alias("lo"), F.max(ms).alias("hi"))
    rows = span.select("exchange", "market_type", "symbol", F.explode(F.sequence("lo", "hi", F.lit(3_600_000))).alias("ts_ms"))
    h, of = F.floor(F.col("ts_ms") / F.lit(3_600_000)), F.col("symbol")
    flat, outlier = (of == "view") & (h % 5 == 0), ~of.isin("click", "view", "error", "purchase") & (h % 97 == 0)
    price = 100 + h % 24 * 0.1 + F.when(outlier, 50.0).otherwise(0.0)
    room = F.when(flat, 0.0).otherwise(1.0)
    rows = rows.where(~((of == "purchase") & (h % 40 == 0)))
    return rows.select(
        "exchange", "market_type", "symbol", F.lit("1h").alias("timeframe"), F.timestamp_millis("ts_ms").alias("timestamp"), price.alias("open"), (price + room).alias("high"), (price - room).alias("low"),
        F.when((of == "error") & (h % 3 == 0), price + 2).otherwise(price).alias("close"), F.lit(1.0).alias("volume"),
    )


GRADED_SQL = f"""WITH {TRADES_SQL}, {candles_sql(name="base")}, span AS (SELECT exchange, market_type, symbol, min(ts_ms) AS lo, max(ts_ms) AS hi FROM base GROUP BY ALL), grid AS (SELECT exchange, market_type, symbol, unnest(range(lo, hi + 1, 3600000)) AS ts_ms FROM span),
  p AS (SELECT *, ts_ms // 3600000 AS h, 100 + (ts_ms // 3600000) % 24 * 0.1::DOUBLE + CASE WHEN symbol NOT IN ('click', 'view', 'error', 'purchase') AND (ts_ms // 3600000) % 97 = 0 THEN 50.0 ELSE 0.0 END AS price, CASE WHEN symbol = 'view' AND (ts_ms // 3600000) % 5 = 0 THEN 0.0 ELSE 1.0 END AS room FROM grid),
  candles AS (SELECT exchange, market_type, symbol, '1h' AS timeframe, ts_ms, price AS open, price + room AS high, price - room AS low, CASE WHEN symbol = 'error' AND h % 3 = 0 THEN price + 2 ELSE price END AS close, 1.0::DOUBLE AS volume FROM p WHERE NOT (symbol = 'purchase' AND h % 40 = 0))"""
