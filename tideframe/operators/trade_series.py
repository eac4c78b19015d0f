"""Series of trades: totals, order and silence, deduplication, and order books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.operators.scan import previous, running
from tideframe.operators.sketch import log_histogram, quantiles

SERIES = ["exchange", "market_type", "symbol"]
SILENCE_MS = 30_000
EXACT = "decimal(38,18)"


def parsed_side(raw: Column) -> Column:
    """PRJ14: buy or sell after trimming and lowering, anything else is unknown."""
    side = F.lower(F.trim(raw))
    return F.when(side.isin("buy", "sell"), side).otherwise("unknown")


def series_totals(trades: DataFrame, by: list[Column | str]) -> DataFrame:
    """AGG6: totals of the trades of each group, in exact decimals: OHLC, volumes, cost, VWAP, imbalance as a share of the
    whole volume, trades of an unknown side included."""
    price, amount = F.col("price").cast("decimal(18,8)"), F.col("amount").cast("decimal(18,8)")
    order, sum_of = F.struct("timestamp", "trade_id"), lambda c, when=None: F.sum(c if when is None else F.when(when, c))
    df = trades.withColumns({"_p": price, "_a": amount, "_c": (price * amount).cast("decimal(28,12)")})
    out = df.groupBy(*by).agg(
        F.count("*").alias("trade_count"),
        sum_of(F.col("_a")).alias("total_volume"),
        sum_of(F.col("_c")).alias("total_cost"),
        F.coalesce(sum_of(F.col("_a"), F.col("side") == "buy"), F.lit(0)).alias("buy_volume"),
        F.coalesce(sum_of(F.col("_a"), F.col("side") == "sell"), F.lit(0)).alias("sell_volume"),
        F.min_by("_p", order).alias("open_price"),
        F.max("_p").alias("high_price"),
        F.min("_p").alias("low_price"),
        F.max_by("_p", order).alias("close_price"),
        (F.max(F.unix_millis("timestamp")) - F.min(F.unix_millis("timestamp"))).alias("duration_ms"),
    )
    imbalance = F.coalesce(F.try_divide((F.col("buy_volume") - F.col("sell_volume")).cast("double"), F.col("total_volume").cast("double")), F.lit(0.0))
    vwap = F.coalesce(F.try_divide(F.col("total_cost").cast("double"), F.col("total_volume").cast("double")), F.lit(0.0))
    return out.withColumns({"vwap": vwap, "buy_sell_imbalance": imbalance})


def in_order(trades: DataFrame, arrival: str = "trade_id", block: Column | None = None) -> DataFrame:
    """WIN21: the trades not older than any that arrived before them. block, a number that never falls with arrival, spreads a busy series; without one a series is a block."""
    rows = running(trades, SERIES, [arrival], {"_newest": ("max", F.col("timestamp"), False)}, F.lit(0) if block is None else block)
    return rows.where(F.col("_newest").isNull() | (F.col("timestamp") >= F.col("_newest"))).drop("_newest")


def disorder(trades: DataFrame, arrival: str = "trade_id", block: Column | None = None) -> DataFrame:
    """WIN22: for each series how many trades are older than the one that arrived before; block as for in_order()."""
    rows = previous(trades, SERIES, arrival, "timestamp", "_before", F.lit(0) if block is None else block)
    return rows.groupBy(*SERIES).agg(F.count("*").alias("trades"), F.count_if(F.col("_before") > F.col("timestamp")).alias("out_of_order"))


def silences(trades: DataFrame, threshold_ms: int = SILENCE_MS) -> DataFrame:
    """WIN23: spans without a trade longer than the threshold, from just after the last trade.

    Trades meet by series and day, so a busy series is spread; only each day's first and last time pass through one task of it.
    """
    rows = trades.select(*SERIES, F.unix_millis("timestamp").alias("ms")).withColumn("_day", F.floor(F.col("ms") / 86_400_000))
    inside = rows.withColumn("last", F.lag("ms").over(Window.partitionBy(*SERIES, "_day").orderBy("ms"))).where("last IS NOT NULL")
    days = rows.groupBy(*SERIES, "_day").agg(F.min("ms").alias("ms"), F.max("ms").alias("newest"))
    across = days.withColumn("last", F.lag("newest").over(Window.partitionBy(*SERIES).orderBy("_day"))).where("last IS NOT NULL")
    df = inside.select(*SERIES, "last", "ms").union(across.select(*SERIES, "last", "ms"))
    return df.select(*SERIES, (F.col("last") + 1).alias("from_ms"), F.col("ms").alias("to_ms"), (F.col("ms") - F.col("last")).alias("silence_ms")).where(F.col("silence_ms") > threshold_ms)


def across_sources(trades: DataFrame) -> DataFrame:
    """DED8: one trade for each exchange, symbol, time and id; a replay before a socket before a request."""
    rank = F.when(F.col("source") == "replay", 0).when(F.col("source") == "ws", 1).otherwise(2)
    key = ["exchange", "symbol", "timestamp", "trade_id"]
    rest = [c for c in trades.columns if c not in key]
    return trades.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in rest))


def lateness(delays: DataFrame, exact: bool = False) -> DataFrame:
    """AGG10: 95th and 99th percentile of the candles' delay for each venue and timeframe, kept between a minute and an hour."""
    if not exact:
        return lateness_of(log_histogram(delays, ["exchange", "timeframe"], "delay_ms"))
    df = delays.groupBy("exchange", "timeframe").agg(F.percentile("delay_ms", F.array(F.lit(0.95), F.lit(0.99))).alias("p"), F.count("*").alias("n"))
    return df.select("exchange", "timeframe", "n", _kept(F.col("p")[0]).alias("p95_ms"), _kept(F.col("p")[1]).alias("p99_ms"))


def _kept(delay: Column) -> Column:
    return F.least(F.greatest(delay.cast("double"), F.lit(60_000.0)), F.lit(3_600_000.0))


def lateness_of(histogram: DataFrame) -> DataFrame:
    """AGG10/STR7: the same from a histogram of delays (sketch.log_histogram), which batches and streams add to, so that no delay is read again; within a hundredth."""
    df = quantiles(histogram, ["exchange", "timeframe"], {"p95_ms": 0.95, "p99_ms": 0.99})
    return df.withColumns({c: _kept(F.col(c)) for c in ("p95_ms", "p99_ms")})


# ---- order books ----------------------------------------------------------------------------------


def sorted_book(books: DataFrame) -> DataFrame:
    """SRT6: bids from the highest, asks from the lowest price; levels are structs of price and qty."""
    return books.withColumns({"bids": F.sort_array("bids", asc=False), "asks": F.sort_array("asks", asc=True)})


def book_problem() -> Column:
    """FLT15: the first rule that a snapshot breaks, null if none: it has a venue, a symbol, a positive time and a level;
    prices are positive and quantities not negative; bids fall and asks rise by price, equal prices allowed."""
    prices = lambda side: F.transform(side, lambda x: x["price"])
    bad = lambda side: F.exists(side, lambda x: ~((x["price"] > 0) & (x["qty"] >= 0)) | x["price"].isNull() | x["qty"].isNull())
    return (
        F.when(F.coalesce("exchange", F.lit("")) == "", "no_exchange").when(F.coalesce("symbol", F.lit("")) == "", "no_symbol").when(~(F.coalesce("ts_ms", F.lit(0)) > 0), "bad_time")
        .when(F.size("bids") + F.size("asks") <= 0, "empty").when(bad("bids") | bad("asks"), "bad_level")
        .when(prices("bids") != F.sort_array(prices("bids"), asc=False), "bids_not_falling").when(prices("asks") != F.sort_array(prices("asks"), asc=True), "asks_not_rising")
    )


def delta_problem() -> Column:
    """FLT15: the first rule that a change of a level breaks, null if none."""
    return (
        F.when(F.coalesce("exchange", F.lit("")) == "", "no_exchange").when(F.coalesce("symbol", F.lit("")) == "", "no_symbol").when(~(F.coalesce("ts_ms", F.lit(0)) > 0), "bad_time")
        .when(F.col("side").isNull() | ~F.col("side").isin("bid", "ask"), "bad_side").when(F.col("price").isNull() | ~(F.col("price") > 0), "bad_price").when(F.col("qty").isNull() | ~(F.col("qty") >= 0), "bad_size")
    )


def book_measures(books: DataFrame) -> DataFrame:
    """OB1-OB3: best prices, mid, spread, spread in basis points, crossed flag and depths of sorted books."""
    bid, ask = F.get("bids", F.lit(0))["price"], F.get("asks", F.lit(0))["price"]
    df = books.withColumns({"best_bid": bid, "best_ask": ask})
    df = df.withColumns({"mid": (F.col("best_bid") + F.col("best_ask")) / 2, "spread": F.col("best_ask") - F.col("best_bid")})
    return df.withColumns({
        "spread_bps": F.try_divide(F.col("spread"), F.nullif("mid", F.lit(0.0))) * 10_000,
        "crossed": F.coalesce(F.col("best_bid") >= F.col("best_ask"), F.lit(False)),
        "bid_depth": F.size("bids"),
        "ask_depth": F.size("asks"),
    })


def delta_kind(qty: Column) -> Column:
    """OB4: no quantity deletes a level, any other replaces it."""
    return F.when(qty == 0, "delete").otherwise("upsert")


def book_at(snapshots: DataFrame, deltas: DataFrame, at_ms: int) -> DataFrame:
    """OB5: the levels of each book at a time: its last snapshot, overlaid by the deltas since.

    snapshots: exchange, symbol, ts_ms, bids, asks. deltas: exchange, symbol, ts_ms, seq, side, price,
    qty. Levels are dealt by (series, side, price), so a busy book is spread.
    """
    key = ["exchange", "symbol"]
    levels = lambda side: F.transform(f"{side}s", lambda x: F.struct(F.lit(side).alias("side"), x["price"].alias("price"), x["qty"].alias("qty")))
    past = snapshots.where(F.col("ts_ms") <= at_ms)
    base = past.groupBy(*key).agg(F.max("ts_ms").alias("base_ms"))
    rows = past.join(base, key).where("ts_ms = base_ms").select(*key, "ts_ms", F.lit(-1).cast("long").alias("seq"), F.inline(F.concat(levels("bid"), levels("ask"))))
    later = deltas.join(base, key).where((F.col("ts_ms") > F.col("base_ms")) & (F.col("ts_ms") <= at_ms)).select(*key, "ts_ms", F.col("seq").cast("long").alias("seq"), "side", "price", "qty")
    last = rows.union(later).groupBy(*key, "side", "price").agg(F.max_by("qty", F.struct("ts_ms", "seq")).alias("qty"))
    return last.where("qty > 0")
