"""Tables under streams, and keyed stream state, case by case."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideframe.operators.features import FEATURES, gold_features
from tideframe.sources.snapshots import Lake
from tideframe.streaming import jobs

CANDLE = "exchange string, market_type string, symbol string, timeframe string, timestamp timestamp, open double, high double, low double, close double, volume double"
HOUR = 3_600_000


def hours(spark, closes, symbol="a", first=0):
    rows = spark.createDataFrame([(symbol, (first + i) * HOUR, float(c)) for i, c in enumerate(closes)], "symbol string, ms long, close double")
    return rows.select(F.lit("x").alias("exchange"), F.lit("spot").alias("market_type"), "symbol", F.lit("1h").alias("timeframe"), F.timestamp_millis("ms").alias("timestamp"), F.col("close").alias("open"), (F.col("close") + 1).alias("high"), (F.col("close") - 1).alias("low"), "close", F.lit(1.0).alias("volume"))


def closes(df):
    return [r["close"] for r in df.orderBy("symbol", "timestamp").collect()]


def event(bars, event_id, symbol="a"):
    return json.dumps({"event_id": event_id, "event_version": 1, "source": "live", "exchange": "x", "symbol": symbol, "timeframe": "1h", "bars": [{"ts": ms, "open": c, "high": c, "low": c, "close": c, "volume": 1.0} for ms, c in bars]})


# --- tables


def test_batches_of_named_streams(spark, tmp_path):
    lake, now = Lake(spark, str(tmp_path / "lake")), iter(range(10_000, 20_000))
    land = {w: jobs.land_candles(lake, "t", str(tmp_path / "dead"), w, lambda: next(now)) for w in ("one", "two")}
    text = lambda *events: spark.createDataFrame([(e,) for e in events], "value string")
    land["one"](text(event([(0, 1.0)], "e1")), 0)
    land["two"](text(event([(HOUR, 2.0)], "e2"), "{broken"), 0)  # another stream's first batch
    land["one"](text(event([(0, 9.0)], "e3")), 0)  # a batch that is run again
    assert closes(lake.candles("t")) == [1.0, 2.0] and lake.log().count() == 2
    land["one"](text(event([(0, 5.0)], "e4")), 1)  # a correction
    assert closes(lake.candles("t")) == [5.0, 2.0] and lake.last_version("t", "one") == 1 and lake.last_version("t", "none") is None
    assert lake.fresh("t", 10_010) and spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_failed_batches_leave_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.commit(hours(spark, [1, 2]), "t", 1, 1_000)
    hours(spark, [8]).withColumn("ts_month", F.lit("1970-01")).write.partitionBy("exchange", "symbol", "timeframe", "ts_month").parquet(f"{lake.folder}/t/commit_id=77")
    assert lake.commit(hours(spark, [3], first=2), "t", None, 2_000, writer="w", writer_version=0)
    assert not lake.commit(hours(spark, [4], first=3), "t", None, 3_000, writer="w", writer_version=0)
    assert closes(lake.candles("t")) == [1.0, 2.0, 3.0]
    assert lake.sweep("t", grace_ms=86_400_000) == (0, 0) and lake.sweep("t", grace_ms=-86_400_000) == (0, 1)
    assert not Path(f"{lake.folder}/t/commit_id=77").exists() and closes(lake.candles("t")) == [1.0, 2.0, 3.0]


def test_reads_list_only_files_that_can_match(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    odd = "A+B/C D%é"
    both = hours(spark, range(1500)).unionByName(hours(spark, range(100, 1600), odd))
    lake.commit(both, "t", 1, 1_000)
    some = lake.newest_rows("t", [odd], start_ms=800 * HOUR, end_ms=801 * HOUR)
    assert closes(some) == [900.0, 901.0] and ["1970-02" in f and "symbol=A" in f for f in some.inputFiles() if "/t/" in f] == [True]
    assert closes(lake.newest_rows("t", [odd], start_ms=10**13)) == [] and closes(lake.newest_rows("t", ["none"])) == []
    told = {r["symbol"]: (r["rows"], r["files"], r["oldest"].timestamp(), r["newest"].timestamp()) for r in lake.manifest("t").collect()}
    assert told == {s: (1500, 3, 0.0, 1499 * 3600.0) for s in ("a", odd)}
    lake.commit(hours(spark, [7], odd), "t", 2, 2_000, "replace")
    assert {r["symbol"]: r["newest"].timestamp() for r in lake.bounds("t").collect()} == {"a": 1499 * 3600.0, odd: 0.0}
    assert lake.manifest("t", 1).where("rows = 1500").count() == 2


def test_folded_logs_say_the_same(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    state = lambda: (closes(lake.candles("t")), lake.log().count(), sorted(tuple(r) for r in lake.versions("t").collect()), lake.last_version("t", "w"))
    for k in range(3):
        lake.commit(hours(spark, [k, k]), "t", None, 1_000 + k, writer="w", writer_version=k)
    lake.retention("t", 10 * 86_400_000, 3, dry_run=False)
    told = state()
    lake.fold_log()  # what it took up is still there: entries are in both
    assert state() == told and len(list(Path(f"{lake.folder}/_log").glob("part-*.parquet"))) == 4
    Path(f"{lake.folder}/_folded/fold=000000009").mkdir()  # a fold that stopped half-way
    assert state() == told
    lake.commit(hours(spark, [9]), "t", None, 5_000, writer="w", writer_version=3)
    told = state()
    lake.fold_log()
    assert state() == told and told[0] == [9.0, 2.0] and len(list(Path(f"{lake.folder}/_log").glob("part-*.parquet"))) == 1
    lake.fold_log()
    assert state() == told and not lake.commit(hours(spark, [8]), "t", None, 6_000, writer="w", writer_version=3)


def test_sweep_keeps_what_a_version_reaches(spark, tmp_path):
    lake, day = Lake(spark, str(tmp_path / "lake")), 86_400_000
    lake.commit(hours(spark, [1, 1]).unionByName(hours(spark, [1], "b")), "t", 1, 1 * day)
    lake.commit(hours(spark, [2]), "t", 2, 2 * day, "replace")  # of a alone
    lake.commit(hours(spark, [3]), "t", 3, 3 * day, "replace")
    assert lake.sweep("t", dry_run=True) == (0, 0)
    lake.retention("t", 6 * day, 4, dry_run=False)  # the first version expires
    assert lake.sweep("t", dry_run=True)[0] == 1 and closes(lake.candles("t", version=2)) == [2.0, 1.0]
    lake.retention("t", 9 * day, 3, dry_run=False)
    gone = lake.unreached("t").first()["path"]
    Path(f"{lake.folder}/t/{gone}").unlink()  # as a sweep that stopped half-way left it
    assert lake.sweep("t") == (1, 0) and lake.sweep("t") == (0, 0)
    assert closes(lake.candles("t")) == [3.0, 1.0]


# --- keyed state


def run(spark, folder, batches, schema, make):
    """What a stream tells over batches of rows, one file each, restarted between them."""
    told = None
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        told = jobs.drain(make(stream), str(folder))
    return told


def test_silence_is_told_without_a_later_trade(spark, tmp_path):
    schema = "exchange string, symbol string, timestamp_ms long, event string"
    at = lambda ms, event=None, symbol="a": ("x", symbol, ms, event)
    batches = [[at(1_000), at(2_000), at(9_000), at(1_000, symbol="b")], [at(60_000, "tick", "clock")], [at(70_000, symbol="b")], [at(71_000, "disconnect", "b")], [at(72_000, symbol="b")]]
    told = run(spark, tmp_path, batches, schema, lambda s: jobs.silence_gaps(s, 5_000))
    rows = sorted((r["symbol"], r["from_ms"], r["to_ms"], r["cause"], r["status"]) for r in jobs.latest_gaps(told).collect())
    assert rows == [("a", 2_001, 9_000, "silence", "closed"), ("a", 9_001, 60_000, "silence", "open"), ("b", 1_001, 70_000, "silence", "closed"), ("b", 70_001, 72_000, "disconnect", "closed")]
    opened = {(r["symbol"], r["from_ms"]) for r in told.where("status = 'open'").collect()}
    assert opened == {("a", 9_001), ("b", 1_001), ("b", 70_001)}  # each once told before it closed
    assert told.where("status = 'open'").count() == 3


BOOK = "exchange string, symbol string, seq long, kind string, side string, price double, qty double"


def delta(seq, price=10.0, qty=1.0, side="bid"):
    return ("x", "a", seq, "delta", side, price, qty)


def snapshot(seq, *prices):
    return [("x", "a", seq, "snapshot", "bid", p, 1.0) for p in prices]


def books(spark, folder, batches, pending=1000):
    told = run(spark, folder, batches, BOOK, lambda s: jobs.book_stream(s, pending))
    last = jobs.books(told).first()
    return last, sorted((r["kind"], r["from_seq"], r["to_seq"]) for r in told.where("kind != 'book'").collect())


def test_books_are_not_ready_across_a_hole(spark, tmp_path):
    first = [[*snapshot(1, 1.0), delta(3, 3.0), delta(6, 6.0)]]
    last, gaps = books(spark, tmp_path / "1", [*first, snapshot(2, 2.0)])
    assert (last["seq"], last["seen"], last["ready"], last["best_bid"]) == (3, 6, False, 3.0)
    assert gaps == [("gap_detected", 2, 2), ("gap_detected", 4, 5), ("gap_healed", 2, 2)]
    last, gaps = books(spark, tmp_path / "2", [*first, snapshot(2, 2.0), [delta(4, 4.0), delta(5, 5.0)]])
    assert (last["seq"], last["ready"], last["best_bid"], last["levels"]) == (6, True, 6.0, 5) and gaps[-1] == ("gap_healed", 4, 5)
    last, _ = books(spark, tmp_path / "3", [*first, snapshot(9, 9.0)])
    assert (last["seq"], last["ready"], last["levels"]) == (9, True, 1)
    last, gaps = books(spark, tmp_path / "4", [[delta(5), delta(6)], [delta(5), delta(2)], snapshot(4, 4.0)])
    assert (last["seq"], last["ready"]) == (6, True) and gaps == []


def test_books_that_let_deltas_go_wait_for_a_newer_snapshot(spark, tmp_path):
    waiting = [delta(s) for s in range(5, 12)]
    last, gaps = books(spark, tmp_path / "1", [[*snapshot(1, 1.0), *waiting], snapshot(6, 6.0), [delta(12), delta(13)]], pending=3)
    assert not last["ready"] and last["seq"] == 6 and ("gap_detected", 2, 4) in gaps and ("gap_detected", 5, 8) in gaps
    last, gaps = books(spark, tmp_path / "2", [[*snapshot(1, 1.0), *waiting], snapshot(6, 6.0), snapshot(11, 11.0), [delta(12)]], pending=3)
    assert last["ready"] and last["seq"] == 12 and ("gap_healed", 5, 8) in gaps


def test_many_waiting_deltas_cost_what_they_are(spark, tmp_path):
    n, started = 40_000, time.monotonic()
    last, gaps = books(spark, tmp_path, [[*snapshot(1, 1.0), *(delta(s, s % 50 + 1.0) for s in range(3, n))], [delta(2), delta(n)]], pending=2 * n)
    assert (last["seq"], last["ready"]) == (n, True) and gaps == [("gap_detected", 2, 2), ("gap_healed", 2, 2)]
    assert time.monotonic() - started < 20  # 40,000 times what waits would be minutes


def test_gap_events_are_one_message_each(spark, tmp_path):
    told = run(spark, tmp_path, [[*snapshot(1, 1.0), delta(4)], [delta(2), delta(3)]], BOOK, jobs.book_stream)
    rows = jobs.book_gaps(told.union(told)).collect()
    assert sorted((r["event_type"], r["gap_event_id"], r["event_id"]) for r in rows) == [("gap_detected", "x:a:2:3", "gap_detected:x:a:2:3"), ("gap_healed", "x:a:2:3", "gap_healed:x:a:2:3")]


def test_features_from_state_equal_the_batch(spark, tmp_path):
    values = [100 + (i * 7919 % 31) for i in range(90)]
    values[30:60] = [50.0] * 30  # nothing deviates: a null score
    values[70] = 0.0
    c = hours(spark, values).where(F.hour("timestamp") != 5).withColumn("volume", F.when(F.hour("timestamp") == 7, None).otherwise(F.col("close")))
    far = c.withColumn("timestamp", F.timestamp_millis(F.unix_millis("timestamp") + F.when(F.unix_millis("timestamp") > 60 * HOUR, 9000 * HOUR).otherwise(0)))  # a gap of a year
    rows = far.orderBy("timestamp").collect()
    wrong = [r if k % 5 else r.asDict() | {"close": 1.0} for k, r in enumerate(rows)]
    late = [rows[2]]
    batches = [wrong[:40], rows[25:40] + rows[40:41], rows[41:], late]
    corrected = [r if k >= 25 else w for k, (r, w) in enumerate(zip(rows, wrong, strict=True))]
    batches = [[tuple(r.asDict().values()) if not isinstance(r, dict) else tuple(r.values()) for r in b] for b in batches]
    told = run(spark, tmp_path, batches, CANDLE, jobs.features_stream)
    assert [r["is_suspect"] for r in told.where("late").collect()] == [False]
    got = {r["timestamp"]: r for r in jobs.latest_features(told.where("NOT late")).collect()}
    wanted = gold_features(spark.createDataFrame([tuple(r.asDict().values()) if not isinstance(r, dict) else tuple(r.values()) for r in corrected], CANDLE)).collect()
    assert len(got) == len(wanted)
    for w in wanted:
        for f in FEATURES:
            assert got[w["timestamp"]][f] == (pytest.approx(w[f], rel=1e-9, abs=1e-12) if isinstance(w[f], float) else w[f]), (w["timestamp"], f)


def test_late_closes_do_not_reset_the_day(spark, tmp_path):
    day, schema = 86_400_000, "account string, at_ms long, kind string, pnl_usd double, signal_id long, direction string, confidence double, actionable boolean, open_positions long"
    close = lambda at, usd: ("a", at, "close", usd, None, None, None, None, None)
    ask = lambda at, i: ("a", at, "signal", None, i, "buy", 0.9, True, 0)
    told = run(spark, tmp_path, [[close(2 * day, -490.0), ask(2 * day + 1, 1)], [close(day, -1.0)], [close(2 * day + 2, -20.0), ask(2 * day + 3, 2)]], schema, lambda s: jobs.risk_gate(s, 10_000.0))
    rows = {r["signal_id"]: (r["reason"], r["size_pct"]) for r in told.collect()}
    assert rows[1] == ("ok", 0.05) and rows[2] == ("daily_drawdown_breached", None)


def test_accounts_are_told_apart_in_few_states(spark, tmp_path):
    schema, n = "account long, at_ms long, kind string, pnl_usd double, signal_id long, direction string, confidence double, actionable boolean, open_positions long", 2000
    ask = lambda at: [(a, at, "signal", None, a, "buy", 0.9, True, 0) for a in [*range(n), None]]
    lost = [(a, 5, "close", -600.0 if a % 3 == 0 else -1.0, None, None, None, None, None) for a in range(n)]
    told = run(spark, tmp_path, [[*ask(1), *lost], ask(6)], schema, lambda s: jobs.risk_gate(s, 10_000.0, buckets=8))
    assert dict(told.groupBy("reason").count().collect()) == {"ok": 2 * n + 2 - 667, "daily_drawdown_breached": 667}
    assert told.where("reason != 'ok'").agg(F.max(F.col("account") % 3)).first()[0] == 0
    assert spark.read.format("statestore").load(f"{tmp_path}/ck").count() == 8
