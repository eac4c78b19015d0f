"""Validity rules and small projections of candles, trades, signals, positions and orders, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType
from pyspark.sql.window import Window

from tideframe.functions.timeframes import lookup

# A chunk's source on the wire.
WIRE_SOURCES = {"rest": "backfill", "backfill": "backfill", "live": "live", "replay": "replay"}


def first_problem(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that is not true, null if all are; an unknown answer is not true."""
    return reduce(lambda found, rule: found.when(~F.coalesce(rule[1], F.lit(False)), rule[0]), rules[1:], F.when(~F.coalesce(rules[0][1], F.lit(False)), rules[0][0]))


def _filled(c: str) -> Column:
    return F.length(F.col(c)) > 0


def trade_problem() -> Column:
    """FLT17: ids, positive time, price and amount, and a known source."""
    return first_problem(
        ("no_exchange", _filled("exchange")), ("no_market_type", _filled("market_type")), ("no_symbol", _filled("symbol")), ("no_trade_id", F.length(F.col("trade_id").cast("string")) > 0),
        ("bad_time", F.col("timestamp_ms") > 0), ("bad_price", F.col("price") > 0), ("bad_amount", F.col("amount") > 0), ("bad_source", F.col("source").isin("live", "backfill", "replay")),
    )


def signal_problem() -> Column:
    """FLT14: confidence in [0, 1], a positive price, symbol and timeframe, and a positive quantity where there is one."""
    return first_problem(("bad_confidence", F.col("confidence").between(0, 1)), ("bad_price", F.col("price") > 0), ("no_symbol", _filled("symbol")), ("no_timeframe", _filled("timeframe")), ("bad_quantity", F.col("quantity").isNull() | (F.col("quantity") > 0)))


def is_actionable(direction: Column) -> Column:
    """FLT14: a signal that calls for an order."""
    return F.coalesce(direction.isin("buy", "sell"), F.lit(False))


def position_problem() -> Column:
    """FLT16: side, positive quantity and entry, and a size in (0, 1]."""
    size = F.col("size_pct")
    return first_problem(("bad_side", F.col("side").isin("long", "short")), ("bad_quantity", F.col("quantity") > 0), ("bad_entry", F.col("avg_entry") > 0), ("bad_size", (size > 0) & (size <= 1)))


def order_problem() -> Column:
    """FLT16: a size in (0, 1], and a positive quantity where there is one."""
    size = F.col("size_pct")
    return first_problem(("bad_size", (size > 0) & (size <= 1)), ("bad_quantity", F.col("quantity").isNull() | (F.col("quantity") > 0)))


def sliced(trades: DataFrame, from_ms: int | None = None, to_ms: int | None = None, side: str | None = None) -> DataFrame:
    """FLT12: trades of an inclusive range of time and of a side; no row is an error."""
    ms = F.unix_millis("timestamp")
    for keep in ([ms >= from_ms] if from_ms is not None else []) + ([ms <= to_ms] if to_ms is not None else []) + ([F.col("side") == side] if side else []):
        trades = trades.where(keep)
    if trades.isEmpty():
        raise LookupError("no trade in that slice")
    return trades


def with_shape(candles: DataFrame) -> DataFrame:
    """PRJ11: body, wicks and direction."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return candles.withColumns({"body_size": F.abs(c - o), "wick_upper": h - F.greatest(o, c), "wick_lower": F.least(o, c) - lo, "is_bullish": c > o, "is_bearish": c < o})


def candle_is_valid() -> Column:
    """PRJ10/PRJ12: a positive time, ordered prices, and a volume that is a number and not negative."""
    lo, h, v = F.col("low"), F.col("high"), F.col("volume")
    return F.coalesce((F.unix_millis("timestamp") > 0) & (v >= 0) & ~F.isnan(v) & F.col("open").between(lo, h) & F.col("close").between(lo, h), F.lit(False))


def chunks(candles: DataFrame, by: list[str], width_ms: int, strict: bool = True) -> DataFrame:
    """PRJ10/PRJ13: bars of each series in chunks of a width of time, with count, first and last time and whether the chunk is
    the series' last. With strict, a candle that is not valid is an error for the whole batch."""
    ms = F.unix_millis("timestamp")
    bar = F.struct(ms.alias("ts"), "open", "high", "low", "close", "volume")
    if strict:
        bar = F.when(candle_is_valid(), bar).otherwise(F.raise_error(F.concat(F.lit("invalid candle at "), ms.cast("string"))).cast("struct<ts:bigint,open:double,high:double,low:double,close:double,volume:double>"))
    df = candles.groupBy(*by, F.floor(ms / width_ms).cast("long").alias("chunk")).agg(F.array_sort(F.collect_list(bar)).alias("bars"))
    return df.withColumns({
        "n": F.size("bars").cast("long"), "first_ms": F.element_at("bars", 1)["ts"], "last_ms": F.element_at("bars", -1)["ts"],
        "is_last_chunk": F.col("chunk") == F.max("chunk").over(Window.partitionBy(*by)),
    })


def with_cost(trades: DataFrame) -> DataFrame:
    """PRJ15: exact cost, and which side a trade is of."""
    cost = F.col("price").cast("decimal(18,8)") * F.col("amount").cast("decimal(18,8)")
    return trades.withColumns({"cost": cost, "is_buy": F.col("side") == "buy", "is_sell": F.col("side") == "sell"})


def coerced_ms(value: Column, kind: Column) -> Column:
    """PRJ18: milliseconds from an integer, a float or a numeric text, given as text with its JSON kind; anything else is null."""
    number = F.coalesce(value.try_cast("bigint"), F.when(kind == "float", value.try_cast("double").cast("bigint")))
    return F.when(kind.isin("int", "float", "string"), number)


def wire_source(source: Column) -> Column:
    """PRJ24: a chunk's source on the wire; an unknown one is a backfill."""
    return lookup(WIRE_SOURCES, source, "backfill")


def book_time(exchange_ms: Column, receipt_s: Column) -> Column:
    """OB6: the venue's time, else that of receipt."""
    return F.coalesce(exchange_ms, F.round(receipt_s * 1000).cast("long"))


def book_kind(delta: Column) -> Column:
    """OB6: an update without a delta is a snapshot."""
    return F.when(delta.isNull(), "snapshot").otherwise("delta")


def assert_utc(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """FLT10: df, or an error where the column is no instant in time."""
    if not isinstance(df.schema[column].dataType, TimestampType):
        raise TypeError(f"{column} must be a timestamp with a zone, not {df.schema[column].dataType.simpleString()}")
    return df


def assert_non_empty(df: DataFrame) -> DataFrame:
    """FLT10: df, or an error where it has no row."""
    if df.isEmpty():
        raise ValueError("an empty table cannot be validated")
    return df
