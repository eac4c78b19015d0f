"""Running values in blocks, quantiles that merge, and the landed log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tideframe.operators import portfolio
from tideframe.operators.scan import previous, running
from tideframe.operators.sketch import LATENCY_BOUNDS, bound_quantiles, log_histogram, merged, quantiles
from tideframe.operators.trade_series import disorder, in_order
from tideframe.sources.log_source import consume, publish
from tideframe.streaming.jobs import drain

ROWS = "k string, i long, v double"


def test_running_values_in_any_blocks(spark):
    rng = random.Random(3)
    rows = [(k, i, None if rng.random() < 0.1 else float(rng.randint(-9, 9))) for k in ("a", "b", None) for i in range(50)]
    df = spark.createDataFrame(rows, ROWS)
    values = {"total": ("sum", F.col("v")), "before": ("sum", F.col("v"), False), "low": ("min", F.col("v")), "high": ("max", F.col("v"), False)}
    for width in (1, 7, 1000):
        got = {(r["k"], r["i"]): r for r in running(df, ["k"], ["i"], values, F.floor(F.col("i") / width)).collect()}
        last = {(r["k"], r["i"]): r["p"] for r in previous(df, ["k"], "i", "v", "p", F.floor(F.col("i") / width)).collect()}
        assert len(got) == len(rows) == len(last)
        for k in ("a", "b", None):
            mine = [v for key, _, v in rows if key == k]
            for i in range(50):
                upto, past = [v for v in mine[: i + 1] if v is not None], [v for v in mine[:i] if v is not None]
                r = got[k, i]
                assert (r["total"], r["before"], r["low"], r["high"]) == (sum(upto), sum(past), min(upto, default=None), max(past, default=None))
                assert last[k, i] == (mine[i - 1] if i else None)


def test_one_hot_account_in_many_days(spark):
    rng = random.Random(5)
    pnl = [float(rng.randint(-50, 60)) for _ in range(300)]
    rows = [("a", i * 7_200_000, i, p) for i, p in enumerate(pnl)]
    trades = spark.createDataFrame(rows, "account string, ms long, trade_id long, pnl_usd double").withColumn("exit_at", F.timestamp_millis("ms"))
    curve = portfolio.equity_curve(trades, 1000.0)
    got = [r["equity"] for r in curve.orderBy("step").collect()]
    wanted, peak, fall = [1000.0], 1000.0, 0.0
    for p in pnl:
        wanted.append(wanted[-1] + p)
        peak = max(peak, wanted[-1])
        fall = max(fall, (peak - wanted[-1]) / peak)
    assert got == wanted and portfolio.max_drawdown(curve).first()["max_drawdown"] == pytest.approx(fall)


def test_order_of_arrival_in_blocks(spark):
    rng = random.Random(7)
    times = [rng.randint(0, 40) for _ in range(120)]
    rows = [("x", "spot", "s", i, t) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "exchange string, market_type string, symbol string, trade_id long, s long").withColumn("timestamp", F.timestamp_seconds("s"))
    wanted = [i for i, t in enumerate(times) if t >= max(times[:i], default=0)]
    out = sum(a > b for a, b in zip(times, times[1:], strict=False))
    for block in (None, F.floor(F.col("trade_id") / 9)):
        assert sorted(r["trade_id"] for r in in_order(df, block=block).collect()) == wanted
        assert disorder(df, block=block).first()["out_of_order"] == out


def test_quantiles_merge_and_keep_their_error(spark):
    rng = random.Random(9)
    values = [("a", rng.lognormvariate(3, 2)) for _ in range(5000)] + [("b", 0.0), ("b", -3.0), ("b", None), ("b", float("nan"))]
    df = spark.createDataFrame(values, "k string, v double")
    parts = [log_histogram(df.where(F.pmod(F.xxhash64("v"), F.lit(3)) == i), ["k"], "v") for i in range(3)]
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "top": 1.0}
    told = {r["k"]: r for r in quantiles(merged(["k"], *parts), ["k"], shares).collect()}
    exact = sorted(v for k, v in values if k == "a")
    assert told["a"]["n"] == 5000 and (told["b"]["n"], told["b"]["p99"]) == (2, 0.0)
    for name, share in shares.items():
        assert told["a"][name] == pytest.approx(exact[int(share * 4999)], rel=0.01)
    counts = spark.createDataFrame([("t", 2, 10), ("t", 3, 80), ("t", 11, 10)], "k string, bucket int, n long")
    p = bound_quantiles(counts, ["k"], {"p50": 0.5, "p99": 0.99}, LATENCY_BOUNDS).first()
    assert (p["p50"], p["p99"]) == (17.5, 5000.0)  # half-way in 10 to 25; above the last bound


def test_log_restarts_and_leaves_unfinished_batches(spark, tmp_path):
    log, send = str(tmp_path / "log"), lambda *v: spark.createDataFrame([("k", x) for x in v], "key string, value string")
    assert drain(consume(spark, log, "bronze"), str(tmp_path / "early")).count() == 0
    assert (publish(send("a", "b"), log), publish(send("c"), log)) == (0, 1)
    (tmp_path / "log" / "seq=000000000001" / "_SUCCESS").unlink()  # it was not completed
    assert [r["value"] for r in drain(consume(spark, log, "bronze"), str(tmp_path / "b")).orderBy("value").collect()] == ["a", "b"]
    assert drain(consume(spark, log, "trading"), str(tmp_path / "t")).count() == 0
    assert publish(send("c", "é\u2028d"), log) == 1
    for name, wanted in (("b", ["a", "b", "c", "é\u2028d"]), ("t", ["c", "é\u2028d"]), ("early", ["a", "b", "c", "é\u2028d"])):
        told = drain(consume(spark, log, "trading" if name == "t" else "bronze"), str(tmp_path / name))
        assert sorted(r["value"] for r in told.collect()) == wanted and told.count() == len(wanted)
