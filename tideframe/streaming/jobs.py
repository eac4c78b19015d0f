"""Structured Streaming jobs: landing with dead letters, windowed candles, late data, and keyed state.

Every job takes a streaming DataFrame and returns one, or a foreachBatch function, so the source may be
files or, where the connector is on the class path, Kafka. The state of the keyed jobs is per series,
partitioned by Spark and kept in its state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideframe.functions.timeframes import YEARLY, YEARLY_DEFAULT
from tideframe.operators import portfolio as p
from tideframe.operators import quality
from tideframe.operators.features import FEATURES, LEAST, ROLLING, without_nan
from tideframe.operators.resample import KEY
from tideframe.operators.trade_series import SERIES, SILENCE_MS, series_totals
from tideframe.sources.landed import SCHEMAS, exact_trades, exploded_bars, parsed
from tideframe.sources.log_source import PROFILES
from tideframe.sources.snapshots import Lake, wall_clock_ms


#: What a batch reads at most, unless one file is larger; so no key's part of a batch is larger than that.
BATCH_BYTES = "256m"


def source(spark: SparkSession, folder: str, files_per_batch: int | None = 8, bytes_per_batch: str = BATCH_BYTES) -> DataFrame:
    """SRC9-SRC14: landed JSON lines as a stream of texts, so many files a batch, or, without that, so many bytes."""
    limit = ("maxBytesPerTrigger", bytes_per_batch) if files_per_batch is None else ("maxFilesPerTrigger", files_per_batch)
    return spark.readStream.format("text").option(*limit).load(folder)


def kafka_source(spark: SparkSession, servers: str, topic: str, profile: str, most: int = 500_000) -> DataFrame:
    """STR13: a topic as a stream of texts; needs the Kafka connector."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": PROFILES[profile], "maxOffsetsPerTrigger": most}
    return spark.readStream.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))


def stream_name(batch: DataFrame) -> str:
    """STR1: the id that a stream keeps in its checkpoint, by which a restarted stream is known again."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "unnamed"


def land_candles(lake: Lake, table: str, dead_letters: str, writer: str | None = None, clock: Callable[[], int] = wall_clock_ms) -> Callable[[DataFrame, int], None]:
    """STR1, STR2, SNK14: each batch is parsed once; accepted bars are committed as this stream's batch of that number, the
    rest goes to the dead letters with its reason.

    The table's log knows each stream (by its checkpoint, or the name given) and the last batch that it landed: a batch that is run again is skipped, so a
    crash between write and checkpoint duplicates nothing, and streams into one table do not stand in each other's way. A stream with a
    new checkpoint lands all it reads again, as newer rows of the same keys, which reads give once. Commits have the time of the clock, so a stream's
    corrections are newer than what was there. Ids repeated within the batch count once; first_seen() before it drops those of earlier batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name, events = writer or stream_name(batch), parsed(batch, "ohlcv").persist()
        bars = exploded_bars(events.dropDuplicates(["event_id"])).withColumn("market_type", F.lit("spot"))
        lake.commit(bars, table, None, clock(), run_id=f"batch-{batch_id}", writer=name, writer_version=batch_id)
        dead(events, table, batch_id, f"{dead_letters}/stream={name}")
        events.unpersist()

    return write


def dead(events: DataFrame, topic: str, batch_id: int, folder: str) -> None:
    """SNK14: a batch's rejected events, raw and with the reason."""
    events.where("reject_reason IS NOT NULL").select("raw", "reject_reason", F.lit(topic).alias("topic")).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def first_seen(raw: DataFrame, horizon: str = "7 days", column: str = "value") -> DataFrame:
    """DED7: each event id once within the horizon of arrival, across batches; texts without an id all pass, on their way to the dead letters."""
    own = F.coalesce(F.get_json_object(column, "$.event_id"), F.concat(F.lit("no id "), F.uuid()))
    seen = raw.withColumns({"_id": own, "_at": F.current_timestamp()}).withWatermark("_at", horizon).dropDuplicatesWithinWatermark(["_id"])
    return seen.drop("_id", "_at")


def land_trades(lake: Lake, table: str, dead_letters: str, writer: str | None = None, clock: Callable[[], int] = wall_clock_ms) -> Callable[[DataFrame, int], None]:
    """SNK6, SNK14: accepted trades are committed as the stream's batch (see land_candles); undecodable ones and those without a
    positive price, amount, time or an id go to the dead letters."""

    def write(batch: DataFrame, batch_id: int) -> None:
        name, events = writer or stream_name(batch), parsed(batch, "trade")
        good = (F.col("price").try_cast("double") > 0) & (F.col("amount").try_cast("double") > 0) & F.col("trade_id").isNotNull() & (F.col("timestamp_ms") > 0)
        reason = F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason")).when(~F.coalesce(good, F.lit(False)), "bad_trade")
        events = events.withColumn("reject_reason", reason).persist()
        lake.commit(exact_trades(events).withColumn("timestamp", F.timestamp_millis("timestamp_ms")).select(*SERIES, "timestamp", "trade_id", "price", "amount", "side", "source").dropDuplicates([*SERIES, "timestamp", "trade_id"]), table, None, clock(), run_id=f"batch-{batch_id}", writer=name, writer_version=batch_id)
        dead(events, table, batch_id, f"{dead_letters}/stream={name}")
        events.unpersist()

    return write


def quality_gate(now_ms: int, folder: str, policy: quality.Policy | None = None) -> Callable[[DataFrame, int], None]:
    """STR3/DQ18: each candle event is judged by itself, however events fall into batches; candles of events that are not rejected go to
    validated, with their tier, the others to rejected, and each event leaves a lineage step: success without an issue, else partial. An event sent twice in a batch counts once."""
    by = [*KEY, "event_id"]

    def write(batch: DataFrame, batch_id: int) -> None:
        bars = exploded_bars(parsed(batch, "ohlcv")).withColumn("market_type", F.lit("spot")).dropDuplicates([*by, "timestamp"]).persist()
        told = quality.decisions(quality.checks(bars, now_ms, by), policy=policy, by=by).persist()
        both = bars.join(told.select(*by, "tier"), by).persist()
        both.where("tier != 'rejected'").write.mode("overwrite").parquet(f"{folder}/validated/batch={batch_id}")
        both.where("tier = 'rejected'").write.mode("overwrite").parquet(f"{folder}/rejected/batch={batch_id}")
        kept = F.when(F.col("tier") == "rejected", 0).otherwise(F.col("rows"))
        steps = told.select(F.lit(f"batch-{batch_id}").alias("run_id"), F.lit("silver").alias("layer"), *by, F.col("rows").alias("rows_in"), kept.alias("rows_out"), F.when(F.size("reasons") == 0, "success").otherwise("partial").alias("status"), F.col("score").alias("quality_score"), F.lit(now_ms).alias("ts_ms"))
        steps.write.mode("overwrite").parquet(f"{folder}/lineage/batch={batch_id}")
        for df in (bars, told, both):
            df.unpersist()

    return write


def trade_rows(raw: DataFrame) -> DataFrame:
    """Accepted trade events as rows, on a stream or not; land_trades keeps what is rejected here."""
    df = raw.select(F.from_json("value", SCHEMAS["trade"]).alias("p")).where("p.event_version = 1 AND p.source IN ('live', 'backfill', 'replay')").select("p.*")
    df = df.withColumns({"timestamp": F.timestamp_millis("timestamp_ms"), "price": F.col("price").try_cast("double"), "amount": F.col("amount").try_cast("double"), "side": F.lower("side")})
    return df.where("price > 0 AND amount > 0")


def calibrated_delay(late: DataFrame, share: str = "p99_ms") -> str:
    """STR7: how long a stream waits for late rows: the largest calibrated lateness (AGG10) of its venues and timeframes."""
    found = late.agg(F.max(share)).first()[0]
    return f"{int(found or 60_000)} milliseconds"


def once(trades: DataFrame, horizon: str = "7 days") -> DataFrame:
    """DED7/DED8: each trade of a venue once within the horizon."""
    return trades.withWatermark("timestamp", horizon).dropDuplicatesWithinWatermark(["exchange", "symbol", "timestamp_ms", "trade_id"])


def window_totals(trades: DataFrame, width: str, late: str) -> DataFrame:
    """STR4/STR7: trade-series totals of tumbling windows, given out when no later trade is allowed any more."""
    df = series_totals(trades.withWatermark("timestamp", late), [F.window("timestamp", width).alias("w"), *SERIES])
    return df.withColumn("window_start_ms", F.unix_millis("w.start")).drop("w")


def window_candles(trades: DataFrame, timeframe: str, width: str, late: str) -> DataFrame:
    """STR5: candles of tumbling windows."""
    order = F.struct("timestamp", F.col("trade_id").cast("long"))
    df = trades.withWatermark("timestamp", late).groupBy(F.window("timestamp", width).alias("w"), *SERIES)
    df = df.agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("amount").alias("volume"))
    return df.select(*SERIES, F.lit(timeframe).alias("timeframe"), F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume")


# Which source of a series' trades is taken where there are several: a replay before a socket before requests.
SOURCE_RANK = {"replay": 0, "ws": 1, "live": 1}
LEAST_RANK = 2


def monotonic(trades: DataFrame) -> DataFrame:
    """STR8: of each series the trades of one source, not older than any of an earlier batch, and each id once at its newest time.

    The source is decided by the first batch that has a trade of the series, the best one there, and stays; trades of others are left out.
    Spark has no order of arrival within a batch, so a batch is taken in the order of time. State is the
    source's rank, the newest time and the ids at that time.
    """

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, ids, rank = state.get if state.exists else (-1, [], -1)
        rows = pd.concat(list(frames), ignore_index=True)
        ranks = rows["source"].map(SOURCE_RANK).fillna(LEAST_RANK).astype(int)
        rank = int(ranks.min()) if rank < 0 else rank
        rows = rows[(ranks == rank) & (rows["timestamp_ms"] >= newest)].sort_values("timestamp_ms", kind="stable").drop_duplicates(["timestamp_ms", "trade_id"])
        rows = rows[(rows["timestamp_ms"] > newest) | ~rows["trade_id"].isin(ids)]
        if len(rows):
            last = int(rows["timestamp_ms"].iloc[-1])
            ids = [*(ids if last == newest else []), *rows.loc[rows["timestamp_ms"] == last, "trade_id"]]
            newest = last
        state.update((int(newest), list(ids), rank))
        yield rows[["exchange", "symbol", "trade_id", "timestamp_ms", "price", "source"]]

    source = F.coalesce("source", F.lit("")) if "source" in trades.columns else F.lit("")
    rows = trades.select("exchange", "symbol", "trade_id", "timestamp_ms", "price", source.alias("source"))
    out = "exchange string, symbol string, trade_id string, timestamp_ms long, price double, source string"
    return rows.groupBy("exchange", "symbol").applyInPandasWithState(keep, out, "newest long, ids array<string>, rank int", "append", GroupStateTimeout.NoTimeout)


def silence_gaps(events: DataFrame, threshold_ms: int = SILENCE_MS, late: str = "0 seconds") -> DataFrame:
    """STR9: a record for each span without a trade that is longer than the threshold, or that a disconnect opened, with its cause.

    events: exchange, symbol, timestamp_ms, and event (trade where it is null, disconnect, or tick: time has passed, whatever the key).
    A gap is told as soon as time says so, not when the next trade comes: a timer of the series in the state store goes off when the stream's watermark is
    more than the threshold past its last trade, and a disconnect needs no timer. The record is then open, from just after the last trade to
    the time known; the next trade tells it again, closed, to that trade. A gap that begins and ends within a batch is told closed only. The
    watermark is that of all series and ticks, behind by late; events later than that are left out.
    """

    def gaps(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, cut, told = state.get if state.exists else (-1, False, False)
        now, found = state.getCurrentWatermarkMs(), []
        for pdf in [] if state.hasTimedOut else [pd.concat(list(frames), ignore_index=True)]:
            pdf = pdf[pdf["event"] != "tick"]
            pdf = pdf.iloc[np.lexsort((pdf["event"] == "trade", pdf["timestamp_ms"]))]
            ms, trade = pdf["timestamp_ms"].to_numpy(), (pdf["event"] == "trade").to_numpy()
            now = max(now, int(ms.max(initial=-1)))
            cuts = np.cumsum(~trade)[trade] + cut  # disconnects so far, at each trade
            ms, open_cut = ms[trade], bool(cut or not trade.all())
            if len(ms):
                ms = np.maximum(ms, last)
                before, was_cut = np.append(last, ms[:-1]), np.diff(cuts, prepend=0) > 0
                for i in np.flatnonzero((before >= 0) & (ms > before + 1) & (was_cut | (ms - before > threshold_ms))):
                    found.append((*key, int(before[i]) + 1, int(ms[i]), "disconnect" if was_cut[i] else "silence", "closed"))
                last, told, open_cut = int(ms[-1]), False, bool(len(trade) and np.cumsum(~trade)[-1] + cut > cuts[-1])
            cut = open_cut
        if last >= 0 and not told and now > last + 1 and (cut or now - last > threshold_ms):
            found.append((*key, last + 1, int(now), "disconnect" if cut else "silence", "open"))
            told = True
        state.update((int(last), bool(cut), bool(told)))
        if last >= 0 and not told:
            state.setTimeoutTimestamp(max(last + threshold_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(found, columns=["exchange", "symbol", "from_ms", "to_ms", "cause", "status"])

    out = "exchange string, symbol string, from_ms long, to_ms long, cause string, status string"
    event = F.coalesce("event", F.lit("trade")) if "event" in events.columns else F.lit("trade")
    rows = events.select("exchange", "symbol", "timestamp_ms", event.alias("event"), F.timestamp_millis("timestamp_ms").alias("_at")).withWatermark("_at", late)
    return rows.groupBy("exchange", "symbol").applyInPandasWithState(gaps, out, "last long, cut boolean, told boolean", "append", GroupStateTimeout.EventTimeTimeout)


def latest_gaps(records: DataFrame) -> DataFrame:
    """STR9: each gap as it is known now: closed, or still open and up to the latest time told."""
    best = F.max_by(F.struct("to_ms", "cause", "status"), F.struct(F.col("status") == "closed", "to_ms")).alias("r")
    return records.groupBy("exchange", "symbol", "from_ms").agg(best).select("exchange", "symbol", "from_ms", "r.*")


def recovered(trades: DataFrame, gaps: DataFrame) -> DataFrame:
    """STR9: landed trades that lie in a gap, tagged as recovered; they must not count as live ones."""
    g = gaps.select(F.col("exchange").alias("_exchange"), F.col("symbol").alias("_symbol"), "from_ms", "to_ms")
    inside = (F.col("exchange") == F.col("_exchange")) & (F.col("symbol") == F.col("_symbol")) & (F.col("timestamp_ms") >= F.col("from_ms")) & (F.col("timestamp_ms") < F.col("to_ms"))
    return trades.join(g, inside, "left_semi").withColumn("source", F.lit("recovery"))


#: STR10: rows of deltas that a book keeps while it waits.
PENDING = 1000
BOOK = ["seq", "seen", "ready", "best_bid", "best_ask", "levels"]


def book_stream(events: DataFrame, pending: int = PENDING) -> DataFrame:
    """STR10/SNK10: books rebuilt from snapshots and deltas, and their sequence gaps, from one state.

    events: exchange, symbol, seq, kind (snapshot or delta), side, price, qty; a snapshot's rows share its seq. A delta is applied only if it
    follows on what the book holds; one further ahead waits, and all that follow on without a hole are applied when the
    missing one or a snapshot beyond it comes. A book is ready if it has a snapshot and nothing waits. More than so many waiting rows
    are let go: the book is then not ready before a snapshot as new as all of them. Events not newer than the book are left out.

    Rows: kind `book`, each book after each batch (seq: the last applied, seen: the newest known); `gap_detected`, once for each hole between events as they come,
    and for each range of deltas that were let go, with from_seq and to_seq; `gap_healed`, when a book has got beyond one. Levels, waiting deltas and open
    gaps are arrays in the state store. A batch is taken in the order of seq, and costs no more for what waits; source() bounds its size.
    """

    def rebuild(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, seen, lost, sides, prices, sizes, w_seq, w_side, w_price, w_qty, g_from, g_to = state.get if state.exists else (-1, -1, -1, *([] for _ in range(9)))
        book = dict(zip(zip(sides, prices, strict=True), sizes, strict=True))
        gaps, told = list(zip(g_from, g_to, strict=True)), []
        waiting: dict[int, list] = {}
        for s, *level in zip(w_seq, w_side, w_price, w_qty, strict=True):
            waiting.setdefault(s, []).append(level)
        line, held = sorted(waiting), len(w_seq)  # a heap of what waits or has waited, and how many rows wait

        def put(levels: list) -> None:
            for side, price, qty in levels:
                if qty > 0:
                    book[side, price] = qty
                else:
                    book.pop((side, price), None)

        def gap(first: int, last: int) -> None:
            gaps.append((first, last))
            told.append(("gap_detected", first, last))

        rows = pd.concat(list(frames), ignore_index=True).dropna(subset=["seq"])
        rows = rows.iloc[np.lexsort((rows["price"], rows["seq"]))]
        found, at = np.unique(rows["seq"].to_numpy(np.int64), return_index=True)
        whole = np.logical_or.reduceat(rows["whole"].to_numpy(bool), at).tolist()
        rows = list(zip(rows["side"], rows["price"].tolist(), rows["qty"].tolist(), strict=True))
        at = [*at.tolist(), len(rows)]
        for i, s in enumerate(found.tolist()):
            if 0 <= seen < s - 1:
                gap(seen + 1, s - 1)
            seen = max(seen, s)
            if s <= seq:
                continue
            levels = rows[at[i] : at[i + 1]]
            if whole[i]:
                book.clear()
                put(levels)
                seq = s
                while line and line[0] <= s:
                    held -= len(waiting.pop(heappop(line), ()))
            elif 0 <= seq == s - 1:
                put(levels)
                seq = s
            elif s not in waiting:
                waiting[s] = levels
                heappush(line, s)
                held += len(levels)
            while waiting and seq >= 0 and seq + 1 in waiting:
                seq += 1
                levels = waiting.pop(seq)
                put(levels)
                held -= len(levels)
            if held > pending:
                gap(min(waiting), max(waiting))
                lost = max(lost, *waiting)
                waiting.clear()
                line.clear()
                held = 0
        told += [("gap_healed", *g) for g in gaps if g[1] <= seq]
        gaps = [g for g in gaps if g[1] > seq]
        ready = seq >= 0 and not waiting and lost <= seq
        w = list(zip(*((s, *level) for s, levels in waiting.items() for level in levels), strict=True)) or [[], [], [], []]
        g = list(zip(*gaps, strict=True)) or [[], []]
        state.update((seq, seen, lost, [k[0] for k in book], [k[1] for k in book], list(book.values()), *(list(x) for x in w), *(list(x) for x in g)))
        bids, asks = ([p for side, p in book if side == which] for which in ("bid", "ask"))
        head = {"exchange": key[0], "symbol": key[1]}
        now = head | {"kind": "book", "seq": seq, "seen": seen, "ready": ready, "best_bid": max(bids, default=None), "best_ask": min(asks, default=None), "levels": len(book)}
        out = pd.DataFrame([now, *(head | {"kind": kind, "from_seq": first, "to_seq": last} for kind, first, last in told)], columns=["kind", "exchange", "symbol", *BOOK, "from_seq", "to_seq"])
        yield out.astype({c: "Int64" for c in ("seq", "seen", "levels", "from_seq", "to_seq")} | {"ready": "boolean", "best_bid": "float64", "best_ask": "float64"})

    out = "kind string, exchange string, symbol string, seq long, seen long, ready boolean, best_bid double, best_ask double, levels long, from_seq long, to_seq long"
    kept = "seq long, seen long, lost long, sides array<string>, prices array<double>, sizes array<double>, w_seq array<long>, w_side array<string>, w_price array<double>, w_qty array<double>, g_from array<long>, g_to array<long>"
    rows = events.select("exchange", "symbol", "seq", F.coalesce(F.col("kind") == "snapshot", F.lit(False)).alias("whole"), "side", "price", "qty")
    return rows.groupBy("exchange", "symbol").applyInPandasWithState(rebuild, out, kept, "append", GroupStateTimeout.NoTimeout)


def books(told: DataFrame) -> DataFrame:
    """STR10: each book as it was last told."""
    best = told.where("kind = 'book'").groupBy("exchange", "symbol").agg(F.max_by(F.struct(*BOOK), F.struct("seen", "seq")).alias("r"))
    return best.select("exchange", "symbol", *(F.nanvl(f"r.{c}", F.lit(None).cast("double")).alias(c) if c.startswith("best") else F.col(f"r.{c}") for c in BOOK))


def book_gaps(told: DataFrame) -> DataFrame:
    """SNK10: the gap events of books, in the fields of gap_messages(): a hole's id is its book and range, so that it is one message however often it is told."""
    hole = F.concat_ws(":", "exchange", "symbol", F.col("from_seq").cast("string"), F.col("to_seq").cast("string"))
    rows = told.where("kind != 'book'").withColumn("gap_event_id", hole)
    return rows.select(F.col("kind").alias("event_type"), F.concat_ws(":", "kind", "gap_event_id").alias("event_id"), "gap_event_id", F.col("exchange").alias("exchange_id"), "symbol", F.lit("book").alias("timeframe"), "from_seq", "to_seq").dropDuplicates(["event_id"])


def risk_gate(events: DataFrame, capital: float, buckets: int = 256) -> DataFrame:
    """STR11: ANL9 on a stream, account by account: each signal approved, with the share of capital that it may take, or the first rule that refuses it.

    events: account, at_ms, kind (close or signal), pnl_usd, signal_id, direction, confidence, actionable, open_positions.
    State is the day, its result and the whole one, and whether the account is halted. Accounts share a state by buckets of their hash, as a state for each
    costs more than its events; a checkpoint keeps to its number of buckets, so give more for many millions of accounts. A batch is taken in order of
    time, closes first and what has no time before all; a close of a day before the state's counts for the whole result alone.
    """
    order_usd = capital * p.POSITION_PCT
    most_pct = p.MAX_ORDER_USD / capital if order_usd > p.MAX_ORDER_USD else p.POSITION_PCT

    def decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {account: of for account, *of in zip(*state.get, strict=True)} if state.exists else {}
        accounts, ids, reasons, sizes = [], [], [], []
        pdfs = list(frames)
        rows = pdfs[0] if len(pdfs) == 1 else pd.concat(pdfs)
        columns = [rows[c].to_numpy() for c in ("at_ms", "asks", "signal_id", "account", "pnl_usd", "direction", "confidence", "actionable", "open_positions")]
        order = np.lexsort(columns[2::-1])
        for at, asks, signal_id, account, pnl, direction, confidence, actionable, held in zip(*(c[order].tolist() for c in columns), strict=True):
            today, (day, daily, total, halted) = at // 86_400_000, known.get(account, (-1, 0.0, 0.0, False))
            if today > day:
                day, daily = today, 0.0
            if not asks:
                known[account] = (day, daily + (pnl if today == day else 0.0), total + pnl, halted)
                continue
            buy, reason = direction != "sell", "ok"
            if halted:
                reason = "system_halted"
            elif not actionable:
                reason = "signal_not_actionable"
            elif confidence < p.MIN_CONFIDENCE:
                reason = "confidence_too_low"
            elif buy and held >= p.MAX_POSITIONS:
                reason = "max_positions_reached"
            elif daily / capital <= -p.DAILY_DRAWDOWN:
                reason, halted = "daily_drawdown_breached", True
            elif total / capital <= -p.TOTAL_DRAWDOWN:
                reason, halted = "total_drawdown_breached", True
            elif buy and order_usd < p.MIN_ORDER_USD:
                reason = "order_too_small"
            known[account] = (day, daily, total, halted)
            accounts.append(account)
            ids.append(signal_id)
            reasons.append(reason)
            sizes.append(np.nan if reason != "ok" else most_pct if buy else p.POSITION_PCT)
        state.update((list(known), *(list(c) for c in zip(*known.values(), strict=True))))
        if ids:
            yield pd.DataFrame({"account": accounts, "signal_id": ids, "approved": [r == "ok" for r in reasons], "reason": reasons, "size_pct": np.array(sizes)})

    kind = events.schema["account"].dataType.simpleString()
    asks = F.coalesce(F.col("kind") != "close", F.lit(True)).alias("asks")
    bucket = F.pmod(F.xxhash64("account"), F.lit(buckets)).alias("bucket")
    rows = events.select(bucket, F.col("account").cast("string").alias("account"), F.coalesce("at_ms", F.lit(0)).alias("at_ms"), asks, F.coalesce("pnl_usd", F.lit(0.0)).alias("pnl_usd"), F.coalesce("signal_id", F.lit(-1)).alias("signal_id"), "direction", "confidence", F.coalesce("actionable", F.lit(False)).alias("actionable"), "open_positions")
    kept = "account array<string>, day array<long>, daily array<double>, total array<double>, halted array<boolean>"
    told = rows.groupBy("bucket").applyInPandasWithState(decide, "account string, signal_id long, approved boolean, reason string, size_pct double", kept, "append", GroupStateTimeout.NoTimeout)
    return told.withColumn("account", F.col("account").cast(kind))


def fan_out(*handlers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """STR12: several sinks of one batch, which is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for handle in handlers:
            handle(batch, batch_id)
        batch.unpersist()

    return write


def _moments(x: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of the last rows that have a value, updated a value at a time so that equal values deviate by nothing; NaN below the least number."""
    padded = np.concatenate([np.full(width - 1, np.nan), x])
    n, total, mean, squares = (np.zeros(len(x)) for _ in range(4))
    for k in range(width):
        v = padded[k : k + len(x)]
        held = ~np.isnan(v)
        n = n + held
        off = np.where(held, v - mean, 0.0)
        step = off / np.maximum(n, 1)
        squares = squares + off * (off - step)
        mean, total = mean + step, total + np.where(held, v, 0.0)
    with np.errstate(all="ignore"):
        return np.where(n >= least, total / n, np.nan), np.where((n >= least) & (n > 1), np.sqrt(squares / (n - 1)), np.nan)


def _total(x: np.ndarray, width: int, least: int) -> np.ndarray:
    mean, _ = _moments(x, width, least)
    padded = np.concatenate([np.full(width - 1, np.nan), x])
    total = sum(np.nan_to_num(padded[k : k + len(x)]) for k in range(width))
    return np.where(np.isnan(mean), np.nan, total)


def features_of_rows(timeframe: str, o: np.ndarray, h: np.ndarray, low: np.ndarray, c: np.ndarray, v: np.ndarray) -> dict[str, np.ndarray]:
    """The eight numeric features of a series' rows in order, NaN for null; the same as gold_features()."""
    zero = lambda x: np.where(x == 0, np.nan, x)
    before = np.concatenate([[np.nan], c[:-1]])[: len(c)]
    with np.errstate(all="ignore"):
        ratio = zero(c) / zero(before)
        log_return = np.where(ratio > 0, np.log(np.where(ratio > 0, ratio, 1)), np.nan)
        typical, volume = (h + low + c) / 3, zero(v)
        found = {
            "log_return": log_return, "return_1": c / zero(before) - 1, "volatility_20": _moments(log_return, ROLLING, LEAST)[1] * np.sqrt(float(YEARLY.get(timeframe, YEARLY_DEFAULT))),
            "vwap": _total(typical * volume, ROLLING, LEAST) / zero(_total(volume, ROLLING, LEAST)), "high_low_spread": (h - low) / zero(c), "price_range_pct": (h - low) / zero(o), "body_pct": np.abs(c - o) / zero(o),
        }
        mean, deviation = _moments(v, ROLLING, LEAST)
        found["volume_z"] = (v - mean) / zero(deviation)
    return {k: np.where(np.isinf(x), np.nan, x) for k, x in found.items()}


def features_stream(candles: DataFrame) -> DataFrame:
    """STR6: the nine features of candles on a stream, from the last rows of each series in the state store; no table is read.

    A candle of a known time is a correction. After a batch every candle from its oldest one on is told again, with a higher version, as its windows may
    have changed. State is the 2 * ROLLING newest candles of a series, so gaps of any length are gaps in time only, and corrections among the ROLLING newest are
    exact; an older one is told with late true and without features, for a rebuild of that series from the table (build_all).
    """
    values = ["open", "high", "low", "close", "volume"]

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, *held, suspect, version, whole = state.get if state.exists else ([], *([] for _ in values), [], 0, True)
        old = pd.DataFrame(dict(zip(["ms", *values, "suspect"], [times, *held, suspect], strict=True))).astype({"ms": "int64", "suspect": "bool"} | {c: "float64" for c in values})
        new = pd.concat(list(frames), ignore_index=True)[["ms", *values, "suspect"]]
        edge = -(1 << 62) if whole else int(old["ms"].iloc[ROLLING])  # what is before has no whole window any more
        late, new = new[new["ms"] < edge], new[new["ms"] >= edge]
        rows = pd.concat([x for x in (old, new) if len(x)]).drop_duplicates("ms", keep="last").sort_values("ms", ignore_index=True)
        known = features_of_rows(key[3], *(rows[c].to_numpy(np.float64) for c in values))
        told = rows[["ms", *values]].assign(**known, is_suspect=rows["suspect"], late=False)
        told = told[told["ms"] >= new["ms"].min()]
        unknown = late[["ms", *values]].assign(**dict.fromkeys(known, np.nan), is_suspect=late["suspect"], late=True)
        told = pd.concat([x for x in (told, unknown) if len(x)]).assign(version=version + 1)
        for name, value in zip(KEY, key, strict=True):
            told[name] = value
        yield told[[*KEY, "ms", *values, *FEATURES, "late", "version"]]
        kept = rows.tail(2 * ROLLING)
        state.update(([int(x) for x in kept["ms"]], *([float(x) for x in kept[c]] for c in values), [bool(x) for x in kept["suspect"]], version + 1, bool(whole and len(kept) == len(rows))))

    flag = F.coalesce(F.col("quality_flag") == "suspect", F.lit(False)) if "quality_flag" in candles.columns else F.lit(False)
    rows = candles.select(*KEY, F.unix_millis("timestamp").alias("ms"), *(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in values), flag.alias("suspect"))
    doubles = lambda names: ", ".join(f"{c} double" for c in names)
    out = f"{', '.join(f'{c} string' for c in KEY)}, ms long, {doubles([*values, *FEATURES[:-1]])}, is_suspect boolean, late boolean, version long"
    kept = f"ms array<long>, {', '.join(f'{c} array<double>' for c in values)}, suspect array<boolean>, version long, whole boolean"
    told = rows.groupBy(*KEY).applyInPandasWithState(advance, out, kept, "append", GroupStateTimeout.NoTimeout)
    return without_nan(told.withColumn("timestamp", F.timestamp_millis("ms")).drop("ms"), [*values, *FEATURES[:-1]])


def latest_features(told: DataFrame) -> DataFrame:
    """STR6: the features of each candle as they were last told."""
    rest = [c for c in told.columns if c not in (*KEY, "timestamp", "version")]
    return told.groupBy(*KEY, "timestamp").agg(F.max_by(F.struct(*rest), "version").alias("r")).select(*KEY, "timestamp", "r.*")


def drain(stream: DataFrame, folder: str, schema_from: DataFrame | None = None) -> DataFrame:
    """Run a stream over all that is there and read what it appended."""
    q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], folder: str) -> None:
    """Run a foreachBatch function over all that is there."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
