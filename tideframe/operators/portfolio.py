"""Fills to positions and closed trades; their performance; risk rules and rebalancing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.operators.scan import by_day, running

ACCOUNT = ["account", "symbol"]
# The risk limits.
MIN_CONFIDENCE, MAX_POSITIONS, DAILY_DRAWDOWN, TOTAL_DRAWDOWN = 0.8, 3, 0.05, 0.15
POSITION_PCT, MIN_ORDER_USD, MAX_ORDER_USD, STOP_PCT, DRIFT = 0.05, 10.0, 1000.0, 0.02, 0.05
YEAR_DAYS = 252
# The states that an order may go to from each state.
TRANSITIONS = {
    "pending": ["submitted", "cancelled"],
    "submitted": ["filled", "rejected", "cancelling", "cancelled"],
    "cancelling": ["filled", "rejected", "cancelled"],
    "filled": [],
    "rejected": [],
    "cancelled": [],
}


def fold_fills(fills: DataFrame) -> DataFrame:
    """ANL1/ANL2/JN9: for each account and symbol its open position at weighted-average cost, and its closed trades.

    fills: account, symbol, timestamp, trade_id, side, price, amount. A sale closes at most what is
    held. The fold needs a position's fills in order, so they are sorted within partitions by account and
    symbol and pass through a task with one position's state in hand; no history is ever one row or one array.
    """
    closed = "trade_id bigint, entry_at timestamp, exit_at timestamp, closed_qty double, avg_entry_price double, exit_price double"
    kinds = ", ".join(f"{c} {fills.schema[c].dataType.simpleString()}" for c in ACCOUNT)
    schema = f"{kinds}, is_open boolean, {closed}, quantity double, avg_entry double, opened_at timestamp"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, qty, avg, entry = None, 0.0, 0.0, None
        names = [x.split()[0] for x in schema.split(", ")]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], names=names)

        types = None
        stamp = pa.timestamp("us", "UTC")
        for batch in batches:
            types = types or [*(batch.column(i).type for i in range(2)), pa.bool_(), pa.int64(), stamp, stamp, *[pa.float64()] * 5, stamp]
            rows = []
            columns = [c.cast(pa.int64()) if pa.types.is_timestamp(c.type) else c for c in batch.columns]
            for account, symbol, at, trade_id, side, price, amount in zip(*(c.to_pylist() for c in columns), strict=True):
                if (account, symbol) != key:
                    if key is not None and qty > 0:
                        rows.append((*key, True, None, None, None, None, None, None, qty, avg, entry))
                    key, qty, avg, entry = (account, symbol), 0.0, 0.0, None
                if side == "buy":
                    entry = at if qty == 0 else entry
                    avg = (qty * avg + amount * price) / (qty + amount)
                    qty += amount
                else:
                    held = min(amount, qty)
                    if held > 0:
                        rows.append((*key, False, trade_id, entry, at, held, avg, price, None, None, None))
                    qty -= held
                    if qty <= 0:
                        avg, entry = 0.0, None
            yield made(rows)
        if key is not None and qty > 0:
            yield made([(*key, True, None, None, None, None, None, None, qty, avg, entry)])

    rows = fills.select(*ACCOUNT, "timestamp", F.col("trade_id").cast("long").alias("trade_id"), "side", F.col("price").cast("double").alias("price"), F.col("amount").cast("double").alias("amount"))
    return rows.repartition(*ACCOUNT).sortWithinPartitions(*ACCOUNT, "timestamp", "trade_id").mapInArrow(run, schema)


def positions(folded: DataFrame) -> DataFrame:
    """ANL2: open positions."""
    return folded.where("is_open").select(*ACCOUNT, "quantity", "avg_entry", "opened_at")


def closed_trades(folded: DataFrame) -> DataFrame:
    """ANL1: closed trades."""
    return folded.where("NOT is_open").select(*ACCOUNT, "trade_id", "entry_at", "exit_at", "closed_qty", "avg_entry_price", "exit_price")


def settled(closed: DataFrame, fee: Column, fee_status: Column) -> DataFrame:
    """ANL3/ANL4: gross result, net where the fee is known or provisional, and the shares of cost; a winner is judged by net if there is one.

    The gross share is 0 without a cost, and so such a close is no winner; the net share and that of fees are null there.
    """
    df = closed.withColumn("fee_status", fee_status)
    df = df.withColumn("fee_amount_usd", F.when(F.col("fee_status").isin("known", "provisional"), fee)).withColumn("gross_realized_usd", F.col("closed_qty") * (F.col("exit_price") - F.col("avg_entry_price")))
    cost = F.when((F.col("closed_qty") > 0) & (F.col("avg_entry_price") > 0), F.col("closed_qty") * F.col("avg_entry_price"))
    df = df.withColumn("net_realized_usd", F.col("gross_realized_usd") - F.col("fee_amount_usd"))
    pnl = F.coalesce("net_realized_usd", "gross_realized_usd")
    return df.withColumns({
        "pnl_usd": pnl,
        "pnl_pct": F.coalesce(F.try_divide("gross_realized_usd", cost), F.lit(0.0)),
        "net_pnl_pct": F.try_divide("net_realized_usd", cost),
        "fees_pct": F.try_divide("fee_amount_usd", cost),
        "is_winner": F.coalesce(F.try_divide("net_realized_usd", cost), F.try_divide("gross_realized_usd", cost), F.lit(0.0)) > 0,
        "duration_s": (F.unix_millis("exit_at") - F.unix_millis("entry_at")) / 1000,
    })


def performance(trades: DataFrame, capital: float, by: list[str] = ["account"]) -> DataFrame:  # noqa: B006
    """ANL5/ANL6: counts, results, win rate, averages, profit factor, mean duration, Sharpe ratio; null where undefined.

    The profit factor compares summed shares of cost, not sums of money.
    """
    win, pnl = F.col("is_winner"), F.col("pnl_usd")
    df = trades.groupBy(*by).agg(
        F.count("*").alias("trades"),
        F.count_if(win).alias("winners"),
        F.sum(pnl).alias("total_usd"),
        F.avg(F.when(win, F.col("pnl_pct"))).alias("avg_win"),
        F.avg(F.when(~win, F.col("pnl_pct"))).alias("avg_loss"),
        F.coalesce(F.sum(F.when(win, F.col("pnl_pct"))), F.lit(0.0)).alias("won"),
        F.sum(F.when(~win, F.col("pnl_pct"))).alias("lost"),
        F.avg("duration_s").alias("avg_duration_s"),
        F.avg("pnl_pct").alias("mean_pct"),
        F.stddev_samp("pnl_pct").alias("std_pct"),
    )
    sharpe = F.when(F.col("trades") >= 2, F.try_divide("mean_pct", F.nullif("std_pct", F.lit(0.0))) * F.sqrt(F.lit(float(YEAR_DAYS))))
    return df.select(
        *by, "trades", "winners", "total_usd", (F.col("total_usd") / capital).alias("return_pct"), F.try_divide("winners", "trades").alias("win_rate"), "avg_win", "avg_loss",
        F.try_divide("won", F.abs(F.nullif("lost", F.lit(0.0)))).alias("profit_factor"), "avg_duration_s", sharpe.alias("sharpe"),
    )


#: Steps in a block of a curve.
STEPS = 4096


def equity_curve(trades: DataFrame, capital: float, by: list[str] = ["account"]) -> DataFrame:  # noqa: B006
    """WIN19/ANL7: equity after each closed trade; step 0 is the capital. An account's trades are told in blocks of a day."""
    values = {"step": ("sum", F.lit(1)), "_sum": ("sum", F.col("pnl_usd"))}
    rows = running(trades.select(*by, "exit_at", "trade_id", "pnl_usd"), by, ["exit_at", "trade_id"], values, by_day("exit_at"))
    seed = trades.select(*by).distinct().select(*by, F.lit(0).alias("step"), F.lit(float(capital)).alias("equity"))
    return seed.union(rows.select(*by, F.col("step").cast("int"), (capital + F.col("_sum")).alias("equity")))


def max_drawdown(curve: DataFrame, by: list[str] = ["account"]) -> DataFrame:  # noqa: B006
    """WIN20: the largest fall from a peak so far, as a share of the peak; a curve's steps are told in even blocks."""
    curve = running(curve, by, ["step"], {"peak": ("max", F.col("equity"))}, F.floor(F.col("step") / STEPS))
    fall = F.when(F.col("peak") > 0, (F.col("peak") - F.col("equity")) / F.col("peak")).otherwise(0.0)
    return curve.groupBy(*by).agg(F.max(fall).alias("max_drawdown"))


def compounded(trades: DataFrame, by: list[str] = ["account"]) -> DataFrame:  # noqa: B006
    """WIN20 without capital: equity compounds from 1 by each trade's share. The product so far is a running sum of
    logarithms, with running counts of zeros and of negative factors for its sign; step 0 is the 1."""
    factor = 1 + F.col("pnl_pct")
    values = {
        "step": ("sum", F.lit(1)), "_zeros": ("sum", F.when(factor == 0, 1).otherwise(0)), "_negative": ("sum", F.when(factor < 0, 1).otherwise(0)),
        "_log": ("sum", F.when(factor != 0, F.log(F.abs(factor))).otherwise(0.0)),
    }
    rows = running(trades.select(*by, "exit_at", "trade_id", "pnl_pct"), by, ["exit_at", "trade_id"], values, by_day("exit_at"))
    sign = F.when(F.col("_zeros") > 0, 0.0).when(F.col("_negative") % 2 == 1, -1.0).otherwise(1.0)
    rows = rows.select(*by, F.col("step").cast("int"), (sign * F.exp("_log")).alias("equity"))
    return trades.select(*by).distinct().select(*by, F.lit(0).alias("step"), F.lit(1.0).alias("equity")).union(rows)


def daily_pnl(trades: DataFrame, by: list[str] = ["account"]) -> DataFrame:  # noqa: B006
    """ANL14: realised result of each day and in total so far; closes of unknown result are counted apart."""
    day = trades.groupBy(*by, F.to_date("exit_at").alias("day")).agg(F.sum("net_realized_usd").alias("daily_usd"), F.count_if(F.col("net_realized_usd").isNull()).alias("unknown"))
    total = F.sum(F.coalesce("daily_usd", F.lit(0.0))).over(Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return day.withColumn("total_usd", total)


def stop_loss_breached(side: Column, entry: Column, price: Column, pct: float = STOP_PCT) -> Column:
    """ANL10: a long at or below its stop, a short at or above."""
    return F.when(side == "long", price <= entry * (1 - pct)).when(side == "short", price >= entry * (1 + pct))


def with_last_price(held: DataFrame, candles: DataFrame) -> DataFrame:
    """Positions with their symbol's last close; the price table is one row for each symbol."""
    last = candles.groupBy("symbol").agg(F.max_by("close", F.struct("timestamp", "exchange")).alias("last_price"))
    return held.join(last, "symbol", "left")


def unrealised(held: DataFrame) -> DataFrame:
    """ANL8: cost basis and unrealised result by side."""
    sign = F.when(F.col("side") == "long", 1).otherwise(-1)
    pct = sign * F.try_divide(F.col("last_price") - F.col("avg_entry"), F.nullif("avg_entry", F.lit(0.0)))
    return held.withColumns({"cost_basis": F.col("quantity") * F.col("avg_entry"), "unrealised_pct": pct, "unrealised_usd": sign * (F.col("last_price") - F.col("avg_entry")) * F.col("quantity")})


def exposure(held: DataFrame, by: list[str] = ["account"]) -> DataFrame:  # noqa: B006
    """AGG12/AGG13: notional exposure, positions of unknown price, open count."""
    return held.groupBy(*by).agg(F.sum(F.when(F.col("avg_entry") > 0, F.col("quantity") * F.col("avg_entry"))).alias("exposure_usd"), F.count_if(F.col("avg_entry").isNull()).alias("unknown_price"), F.count("*").alias("open_positions"))


def risk_decisions(signals: DataFrame, closes: DataFrame, capital: float, by: str = "account") -> DataFrame:
    """ANL9: approved or the first rule that refuses, for each signal in its account's order of time.

    signals: account, timestamp, signal_id, direction, confidence, actionable, open_positions.
    closes: account, exit_at, pnl_usd. Drawdown is looked at when a signal has passed the rules before it;
    a breach refuses that signal and halts the account for all later ones. One account and day is one window partition.
    """
    event = closes.select(by, F.col("exit_at").alias("at"), F.lit(0).alias("kind"), "pnl_usd", F.lit(None).cast("long").alias("signal_id"), F.lit(None).cast("string").alias("direction"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("boolean").alias("actionable"), F.lit(None).cast("long").alias("open_positions"))
    ask = signals.select(by, F.col("timestamp").alias("at"), F.lit(1).alias("kind"), F.lit(0.0).alias("pnl_usd"), "signal_id", "direction", "confidence", "actionable", F.col("open_positions").cast("long").alias("open_positions"))
    rows = event.unionByName(ask).withColumn("day", F.to_date("at"))
    # an account's days are blocks: what a day begins with is the sum of the days before
    today = Window.partitionBy(by, "day").orderBy("at", "kind", "signal_id").rowsBetween(Window.unboundedPreceding, 0)
    earlier_days = F.sum("_day_pnl").over(Window.partitionBy("_of").orderBy("_on").rowsBetween(Window.unboundedPreceding, -1))
    days = rows.groupBy(F.col(by).alias("_of"), F.col("day").alias("_on")).agg(F.sum("pnl_usd").alias("_day_pnl")).select("_of", "_on", F.coalesce(earlier_days, F.lit(0.0)).alias("_carried"))
    rows = rows.withColumn("daily", F.sum("pnl_usd").over(today)).join(days, F.col(by).eqNullSafe(F.col("_of")) & F.col("day").eqNullSafe(F.col("_on")))
    rows = rows.withColumns({"total": (F.col("_carried") + F.col("daily")) / capital, "daily": F.col("daily") / capital}).drop("_of", "_on", "_carried")
    rows = rows.where("kind = 1")
    buy = F.col("direction") != "sell"
    refused = (
        F.when(~F.col("actionable"), "signal_not_actionable").when(F.col("confidence") < MIN_CONFIDENCE, "confidence_too_low").when(buy & (F.col("open_positions") >= MAX_POSITIONS), "max_positions_reached")
        .when(F.col("daily") <= -DAILY_DRAWDOWN, "daily_drawdown_breached").when(F.col("total") <= -TOTAL_DRAWDOWN, "total_drawdown_breached")
    )
    rows = rows.withColumn("refused", refused)
    place = F.struct("at", "kind", "signal_id")
    halts = rows.where(F.col("refused").endswith("drawdown_breached")).groupBy(F.col(by).alias("_of")).agg(F.min(place).alias("_halt"))
    rows = rows.join(halts, F.col(by).eqNullSafe(F.col("_of")), "left").withColumn("halted", F.coalesce(place > F.col("_halt"), F.lit(False))).drop("_of", "_halt")
    order_usd = capital * POSITION_PCT
    reason = F.when(F.col("halted"), "system_halted").when(F.col("refused").isNotNull(), F.col("refused")).when(buy & F.lit(order_usd < MIN_ORDER_USD), "order_too_small").otherwise("ok")
    size = F.when(F.col("reason") == "ok", F.when(buy & F.lit(order_usd > MAX_ORDER_USD), MAX_ORDER_USD / capital).otherwise(POSITION_PCT))
    return rows.withColumn("reason", reason).select(by, "signal_id", (F.col("reason") == "ok").alias("approved"), "reason", size.alias("size_pct"))


def rebalance(held: DataFrame, targets: DataFrame, drift: float = DRIFT) -> DataFrame:
    """ANL12/JN8: buys and sells that bring each symbol's weight to its target, where they are a drift apart."""
    df = held.groupBy("symbol").agg(F.sum("size_pct").alias("current")).join(targets.select("symbol", "target"), "symbol", "full").fillna(0.0, ["current", "target"])
    delta = F.col("target") - F.col("current")
    return df.withColumn("delta_pct", F.abs(delta)).withColumn("side", F.when(delta > 0, "buy").otherwise("sell")).where(F.col("delta_pct") >= drift)


def by_drift(actions: DataFrame) -> DataFrame:
    """SRT3: actions with their place by drift, the largest first; equal drifts in the order of symbols."""
    return actions.orderBy(F.desc("delta_pct"), "symbol").withColumn("place", F.row_number().over(Window.orderBy(F.desc("delta_pct"), "symbol")))


def target_problems(targets: DataFrame) -> DataFrame:
    """ANL13: whether targets are missing, outside [0, 1], or more than all together."""
    t = F.col("target")
    return targets.agg((F.count("*") == 0).alias("empty"), F.count_if(~t.between(0, 1)).alias("outside"), (F.coalesce(F.sum(t), F.lit(0.0)) > 1 + 1e-9).alias("too_much"))


def illegal_transitions(orders: DataFrame) -> DataFrame:
    """ANL15: changes of state that an order must not make."""
    before = F.lag("status").over(Window.partitionBy("order_id").orderBy("seq"))
    pairs = [f"{a}>{b}" for a, bs in TRANSITIONS.items() for b in bs]
    df = orders.withColumn("from_status", before).where("from_status IS NOT NULL")
    return df.where(~F.concat_ws(">", "from_status", "status").isin(pairs)).select("order_id", "seq", "from_status", "status")


def id_collisions(held: DataFrame) -> DataFrame:
    """ANL16: order ids that stand for more than one symbol, venue or side."""
    n = F.count_distinct("symbol", "exchange", "side")
    return held.groupBy("order_id").agg(n.alias("n")).where("n > 1")


def sized(orders: DataFrame, capital: float) -> DataFrame:
    """ANL17: the given quantity, else what the capital's share buys."""
    return orders.withColumn("order_qty", F.coalesce("quantity", F.try_divide(capital * F.col("size_pct"), F.nullif("price", F.lit(0.0)))))


def clamped_sells(sells: DataFrame, held: DataFrame) -> DataFrame:
    """ANL18: sells limited to what is held; those of nothing are dropped."""
    h = held.select(*ACCOUNT, F.col("quantity").alias("held"))
    df = sells.join(h, ACCOUNT, "left").fillna(0.0, ["held"])
    return df.withColumn("sell_qty", F.least(F.coalesce("requested", "held"), "held")).where("sell_qty > 0")


def current_positions(updates: DataFrame, now_ms: int, days: int = 7) -> DataFrame:
    """ANL19: the last state of each order id, unless it is closed or older than some days."""
    last = updates.groupBy("order_id").agg(F.max_by(F.struct("symbol", "quantity", "closed", "ts_ms"), F.struct("ts_ms", "seq")).alias("s")).select("order_id", "s.*")
    return last.where(~F.col("closed") & (F.col("ts_ms") > now_ms - days * 86_400_000))
