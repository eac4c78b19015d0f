"""Landed raw data and wire events: JSON with declared schemas to rows, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.operators import rules
from tideframe.operators.trade_series import EXACT, parsed_side

#: Time that a message's bars span at most.
CHUNK_MS = 7 * 86_400_000
VERSION, SOURCES = 1, ["live", "backfill", "replay"]
BAR = "struct<ts:bigint,open:double,high:double,low:double,close:double,volume:double>"
# The declared wire schemas.
ENVELOPE = "event_id string, event_version int, occurred_at string, source string, run_id string, exchange string, symbol string"
SCHEMAS = {
    "ohlcv": f"{ENVELOPE}, timeframe string, batch_start_ts bigint, bars string, meta map<string,string>",
    "trade": f"{ENVELOPE}, market_type string, trade_id string, timestamp_ms bigint, price string, amount string, side string, meta map<string,string>",
}


def parsed(raw: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """SRC9/SRC10: the fields of a payload kind, with the raw text and why it is rejected (null if it is not).

    FLT19: a wrong version or an unknown source is rejected, as is what does not parse.
    """
    df = raw.withColumn("p", F.from_json(F.col(column), SCHEMAS[kind]))
    version, source = F.col("p.event_version"), F.col("p.source")
    reason = F.when(F.col("p").isNull() | F.col("p.event_id").isNull(), "undecodable").when(version.isNull() | (version != VERSION), "bad_version").when(source.isNull() | ~source.isin(SOURCES), "bad_source")
    return df.withColumn("reject_reason", reason).select("p.*", F.col(column).alias("raw"), "reject_reason")


def exploded_bars(events: DataFrame) -> DataFrame:
    """SRC9: a row for each bar of accepted candle events; bars may be an array or the text of one."""
    bars = F.coalesce(F.from_json("bars", f"array<{BAR}>"), F.from_json(F.from_json(F.concat(F.lit("["), F.col("bars"), F.lit("]")), "array<string>")[0], f"array<{BAR}>"))
    df = events.where("reject_reason IS NULL").withColumn("bar", F.explode(bars))
    return df.select("event_id", "exchange", "symbol", "timeframe", "source", F.timestamp_millis("bar.ts").alias("timestamp"), "bar.open", "bar.high", "bar.low", "bar.close", "bar.volume")


def exact_trades(events: DataFrame) -> DataFrame:
    """SRC10/SRC17: trades with exact price and amount; those that are not positive numbers go."""
    df = events.where("reject_reason IS NULL").withColumns({"price": F.col("price").try_cast(EXACT), "amount": F.col("amount").try_cast(EXACT), "side": parsed_side(F.col("side"))})
    return df.where("price > 0 AND amount > 0 AND trade_id IS NOT NULL AND timestamp_ms > 0")


def raw_candles(raw: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """SRC15: candle lists [[ts, o, h, l, c, v], ...] landed as text, with the columns to keep."""
    rows = raw.withColumn("c", F.explode(F.from_json(column, "array<array<double>>")))
    return rows.select(*(keep or []), F.timestamp_millis(F.get("c", F.lit(0)).cast("bigint")).alias("timestamp"), *(F.get("c", F.lit(i)).alias(n) for i, n in enumerate(["open", "high", "low", "close", "volume"], 1)))


def raw_trades(raw: DataFrame, column: str = "value") -> DataFrame:
    """SRC16: trade dicts landed as text; rows without id or time go, a missing cost is price times amount."""
    df = raw.select(F.from_json(column, "id string, timestamp bigint, price double, amount double, cost double, side string").alias("t")).select("t.*")
    return df.where("id IS NOT NULL AND timestamp IS NOT NULL").withColumn("cost", F.coalesce("cost", F.col("price") * F.col("amount")))


def raw_derivatives(raw: DataFrame, field: str, column: str = "value") -> DataFrame:
    """SRC18/PRJ8: funding or open-interest dicts landed as text; those without time or value go."""
    df = raw.select(F.from_json(column, f"symbol string, timestamp bigint, {field} double").alias("d")).select("d.*")
    return df.dropna(subset=["timestamp", field]).withColumnRenamed(field, "value_float")


def routing_key(*parts: str | Column) -> Column:
    """SNK8/SNK12: the parts with colons between."""
    return F.concat_ws(":", *parts)


def external_key() -> Column:
    """SNK11: source, metric and symbol, or global."""
    return routing_key("source_id", "metric", F.coalesce("symbol", F.lit("global")))


def candle_messages(candles: DataFrame, run_id: str, source: str = "backfill", chunk_ms: int = CHUNK_MS, strict: bool = True) -> DataFrame:
    """SNK8/SNK13: a message for each series and chunk of time, with its bars in order, under the series' key; so no
    message grows with the length of a series. With strict, a candle that is not valid is an error (PRJ10)."""
    key = ["exchange", "symbol", "timeframe"]
    df = rules.chunks(candles, key, chunk_ms, strict)
    body = F.struct(F.concat_ws("-", F.lit(run_id), *key, F.col("chunk").cast("string")).alias("event_id"), F.lit(VERSION).alias("event_version"), rules.wire_source(F.lit(source)).alias("source"), F.lit(run_id).alias("run_id"), *key, F.col("first_ms").alias("batch_start_ts"), "bars")
    return df.select(routing_key(*key).alias("key"), F.to_json(body).alias("value"))


def metric_rows(raw: DataFrame, source_id: str, metric: str, value: str, column: str = "value", symbols: DataFrame | None = None) -> DataFrame:
    """PRJ17-PRJ19, PRJ21: rows of an external source as long metrics, symbols with a slash, values as text; of some symbols, if given."""
    df = raw.select(F.from_json(column, f"symbol string, {value} string, updateTime string, createdTime string").alias("r")).select("r.*")
    ts = F.coalesce(F.col("updateTime").try_cast("bigint"), F.col("createdTime").try_cast("bigint"))
    df = df.select(F.lit(source_id).alias("source_id"), F.lit(metric).alias("metric"), slash_symbol(F.col("symbol")).alias("symbol"), ts.alias("timestamp_ms"), F.col(value).alias("value")).where("timestamp_ms IS NOT NULL AND value IS NOT NULL")
    return df if symbols is None else df.join(symbols.select(slash_symbol(F.col("symbol")).alias("symbol")), "symbol", "left_semi").select(*df.columns)


def slash_symbol(raw: Column) -> Column:
    """PRJ17: the first two segments of a dashed symbol."""
    parts = F.split(raw, "-")
    return F.when(F.size(parts) >= 2, F.concat_ws("/", F.slice(parts, 1, 2))).otherwise(raw)


def global_metrics(raw: DataFrame, source_id: str, ts: str, column: str = "value") -> DataFrame:
    """PRJ20: one row for each scalar of a wide record; nested values are left out."""
    pairs = F.explode(F.from_json(column, "map<string,string>")).alias("metric", "value")
    df = raw.select(F.lit(source_id).alias("source_id"), F.col(ts).alias("timestamp_ms"), pairs)
    return df.where(~F.col("value").rlike("^\\s*[\\[{]"))


#: UDF3/PRJ22: normalisers by source.
NORMALISERS = {"coinglass": metric_rows, "coinmarketcap": global_metrics}


def order_states(raw: DataFrame, column: str = "value") -> DataFrame:
    """PRJ30: landed order records as states, with the fee of the order or the sum of its parts."""
    df = raw.select(F.from_json(column, "id string, status string, filled double, average double, fee struct<cost:double>, fees array<struct<cost:double>>").alias("o")).select("o.*")
    s = F.lower("status")
    state = F.when(s.isin("closed", "filled"), "filled").when(s.isin("canceled", "cancelled"), "cancelled").when(s.isin("rejected", "expired"), "rejected").otherwise("submitted")
    parts = F.when(F.size("fees") > 0, F.aggregate("fees", F.lit(0.0), lambda a, x: a + F.coalesce(x["cost"], F.lit(0.0))))
    return df.select("id", state.alias("state"), F.col("filled").alias("filled_qty"), F.col("average").alias("avg_price"), F.coalesce("fee.cost", parts).alias("fee"))


def symbol_parts(symbol: Column) -> Column:
    """PRJ16: base and quote in upper case; null where the symbol is malformed."""
    parts = F.split(F.upper(F.trim(symbol)), "/")
    return F.when((F.size(parts) == 2) & (parts[0] != "") & (parts[1] != ""), F.concat_ws("/", parts))


def encoded_segment(c: Column) -> Column:
    """PRJ27: URL-safe base64 without padding."""
    return F.rtrim(F.translate(F.base64(c.cast("binary")), "+/", "-_"), F.lit("="))


def decoded_segment(c: Column) -> Column:
    padded = F.concat(F.translate(c, "-_", "+/"), F.repeat(F.lit("="), F.pmod(-F.length(c), F.lit(4))))
    return F.unbase64(padded).cast("string")


# What tells a passing error from a lasting one.
TRANSIENT_TYPES = ["TimeoutError", "ConnectionError", "BrokenPipeError", "OSError", "ClientConnectorError", "ServerDisconnectedError", "ClientOSError", "ClientResponseError"]
TRANSIENT_TEXTS = ["timeout", "timed out", "rate limit", "429", "503", "502", "connection", "network", "session is closed", "temporarily", "too many requests", "service unavailable"]


def is_transient(kind: Column, message: Column) -> Column:
    """PRJ28: passing errors by their type or text."""
    return F.coalesce(kind.isin(TRANSIENT_TYPES) | F.lower(message).rlike("|".join(TRANSIENT_TEXTS)), F.lit(False))
