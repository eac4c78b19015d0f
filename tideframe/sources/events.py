"""Wire events of books, derivatives, signals, orders and positions: their schemas, why one is rejected, and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = 1
_HEAD = "event_id string, event_version int, occurred_at string, exchange string, symbol string"
_LEVELS = "array<array<string>>"
# The fields of each kind of payload, and those that one cannot do without.
FIELDS = {
    "trade_window": (f"{_HEAD}, market_type string, window_start_ms bigint, window_end_ms bigint, trade_count bigint, vwap string, total_volume string, total_cost string, buy_volume string, sell_volume string, open_price string, close_price string, high_price string, low_price string, buy_sell_imbalance double, source string, run_id string", "market_type window_start_ms window_end_ms trade_count vwap total_volume total_cost"),
    "snapshot": (f"{_HEAD}, payload_type string, timestamp_ms bigint, bids {_LEVELS}, asks {_LEVELS}, depth int, checksum bigint", "timestamp_ms"),
    "delta": (f"{_HEAD}, payload_type string, timestamp_ms bigint, side string, price string, size string", "timestamp_ms price size"),
    "funding": (f"{_HEAD}, market_type string, timestamp_ms bigint, funding_rate string, next_funding_ms bigint, interval_h int, predicted_rate string", "timestamp_ms funding_rate"),
    "open_interest": (f"{_HEAD}, market_type string, timestamp_ms bigint, open_interest_contracts string, open_interest_value string, mark_price string", "timestamp_ms open_interest_contracts"),
    "liquidation": (f"{_HEAD}, market_type string, timestamp_ms bigint, price string, quantity string, quantity_usd string, side string, order_type string", "timestamp_ms price quantity"),
    "signal": (f"{_HEAD}, timeframe string, direction string, price double, confidence double, strategy string, run_id string", "timeframe direction price"),
    "approved_signal": (f"{_HEAD}, timeframe string, direction string, price double, confidence double, strategy string, approved_size_pct double, risk_score double, original_event_id string, run_id string", "timeframe direction price"),
    "rejected_signal": (f"{_HEAD}, direction string, reason string, original_event_id string, run_id string", ""),
    "order_filled": (f"{_HEAD}, order_id string, side string, fill_price double, size_pct double, filled_at string, signal_event_id string, run_id string", "order_id side fill_price size_pct"),
    "order_rejected": (f"{_HEAD}, order_id string, side string, reason string, signal_event_id string, run_id string", "order_id side"),
    "position_opened": (f"{_HEAD}, order_id string, side string, entry_price double, size_pct double, opened_at string, run_id string", "order_id entry_price size_pct"),
    "position_closed": (f"{_HEAD}, order_id string, side string, entry_price double, exit_price double, size_pct double, pnl_pct double, opened_at string, closed_at string, run_id string", "order_id entry_price exit_price size_pct"),
}
# What stands for a field that is absent, by kind.
DEFAULTS = {
    "delta": {"side": "bid"}, "funding": {"market_type": "linear"}, "open_interest": {"market_type": "linear"}, "liquidation": {"market_type": "linear", "side": "buy", "order_type": "market"},
    "signal": {"confidence": 1.0}, "approved_signal": {"confidence": 1.0}, "rejected_signal": {"direction": "hold"}, "position_opened": {"side": "long"}, "position_closed": {"side": "long", "pnl_pct": 0.0}, "trade_window": {"source": "live"},
}
# Further rules, as SQL for a bad row.
_DIRECTION = ("bad_direction", "direction NOT IN ('buy', 'sell', 'hold')")
RULES = {
    "trade_window": [("bad_source", "source NOT IN ('live', 'backfill', 'replay')")],
    "delta": [("bad_side", "side NOT IN ('bid', 'ask')")],
    "liquidation": [("bad_side", "side NOT IN ('buy', 'sell')")],
    "signal": [_DIRECTION, ("bad_confidence", "NOT confidence BETWEEN 0 AND 1")],
    "approved_signal": [_DIRECTION, ("bad_confidence", "NOT confidence BETWEEN 0 AND 1")],
    "rejected_signal": [_DIRECTION],
}
# The kinds whose origin is known well enough for them to be consumed; no other kind is.
PROMOTED = ["ohlcv", "snapshot", "delta", "external_metric", "signal", "approved_signal", "rejected_signal", "order_filled", "order_rejected", "position_opened", "position_closed"]


def events(raw: DataFrame, kind: str, column: str = "value", keep: str | None = None) -> DataFrame:
    """SRC11-SRC14: the fields of a kind of payload with its defaults, the raw text, and why it is rejected (null if it is not), beside one column to keep."""
    schema, needed = FIELDS[kind]
    df = raw.select(F.from_json(column, schema).alias("p"), F.col(column).alias("raw"), *([keep] if keep else [])).select("p.*", "raw", *([keep] if keep else []))
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (DEFAULTS.get(kind, {}) | {"event_version": VERSION}).items()})
    missing = F.lit(False)
    for c in ("exchange", "symbol", *needed.split()):
        missing = missing | F.col(c).isNull()
    reason = F.when(F.col("event_id").isNull(), "undecodable").when(F.col("event_version") != VERSION, "bad_version").when(missing, "missing_field")
    for name, bad in RULES.get(kind, []):
        reason = reason.when(F.expr(bad), name)
    return df.withColumn("reject_reason", reason)


def book_events(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC12: snapshots, deltas, and what is neither, told apart by payload_type; levels are structs of price and qty."""
    kind = F.get_json_object(column, "$.payload_type")
    df = raw.withColumn("_kind", kind)
    level = lambda side: F.transform(side, lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("qty")))
    empty = F.array().cast("array<struct<price:double,qty:double>>")
    snapshots = events(df.where("_kind = 'snapshot'"), "snapshot", column).withColumns({"bids": F.coalesce(level("bids"), empty), "asks": F.coalesce(level("asks"), empty), "ts_ms": F.col("timestamp_ms")})
    deltas = events(df.where("_kind = 'delta'"), "delta", column).withColumns({"price": F.col("price").try_cast("double"), "qty": F.col("size").try_cast("double"), "ts_ms": F.col("timestamp_ms")})
    return snapshots, deltas, df.where("_kind IS NULL OR _kind NOT IN ('snapshot', 'delta')").drop("_kind")


def promoted(rows: DataFrame, kind: str = "kind") -> DataFrame:
    """FLT20: the rows whose kind of payload may be consumed; a kind that is not listed may not."""
    return rows.where(F.col(kind).isin(PROMOTED))


def require_promoted(*kinds: str) -> None:
    """FLT20: an error that names the kinds that may not be consumed."""
    if bad := [k for k in kinds if k not in PROMOTED]:
        raise ValueError(f"not promoted: {bad}")


def messages(rows: DataFrame, key: Column, *fields: str | Column) -> DataFrame:
    """SNK9-SNK11, SNK15: key and JSON value of each row; exact numbers are written as text."""
    kinds = dict(rows.dtypes)
    body = [F.col(c).cast("string").alias(c) if isinstance(c, str) and kinds[c].startswith("decimal") else c for c in fields]
    return rows.select(key.cast("string").alias("key"), F.to_json(F.struct(*body)).alias("value"))


def gap_messages(rows: DataFrame, now_ms: int) -> DataFrame:
    """SNK10: a message for each gap event; a detected gap is keyed by its series, what becomes of it by its own id.

    rows: event_type, event_id, gap_event_id, exchange_id, symbol, timeframe, and any further fields.
    """
    series = F.concat_ws(":", "exchange_id", "symbol", "timeframe")
    key = F.when(F.col("event_type") == "gap_detected", series).otherwise(F.col("gap_event_id"))
    return messages(rows.withColumn("published_at_ms", F.lit(now_ms).cast("long")), key, *rows.columns, "published_at_ms")
