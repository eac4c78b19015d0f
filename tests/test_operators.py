"""Closed-form cases and edges of the operators."""

import math

import pytest
from pyspark.sql import functions as F

from tideframe.functions.timeframes import floor_time, ms_of, to_ms
from tideframe.operators import features, gaps, portfolio, quality, resample, silver, strategy
from tideframe.operators import trade_series as t
from tideframe.sources import landed
from tideframe.sources.snapshots import Lake

H = 3_600_000
CANDLE = "exchange string, market_type string, symbol string, timeframe string, ms long, open double, high double, low double, close double, volume double, seq int"


def candles(spark, closes, volumes=None, start=1_704_067_200_000, step=H, seq=0):
    rows = [("ex", "spot", "BTC/USDT", "1h", start + i * step, c, c + 10 if c is not None else None, c - 5 if c is not None else None, c, (volumes or [1000.0] * len(closes))[i], seq) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, CANDLE).withColumn("timestamp", F.timestamp_millis("ms")).drop("ms")


def one(df, column):
    return [r[column] for r in df.orderBy("timestamp").collect()]


def test_timeframes(spark):
    assert to_ms("1M") == 30 * 86_400_000
    with pytest.raises(ValueError):
        to_ms("7m")
    df = spark.range(1).select(F.unix_millis(floor_time(F.timestamp_millis(F.lit(-1)), F.lit(H))).alias("x"), ms_of(F.lit("1h")).alias("h"))
    assert df.first() == (-H, H)
    with pytest.raises(Exception, match="unknown timeframe"):
        spark.range(1).select(ms_of(F.lit("7m"))).collect()


def test_log_return_and_zero_close(spark):
    out = one(features.gold_features(candles(spark, [100.0, 110.0, 0.0, 120.0])), "log_return")
    assert out[0] is None and math.isclose(out[1], math.log(1.1)) and out[2] is None and out[3] is None


def test_rolling_needs_five_values(spark):
    out = one(features.gold_features(candles(spark, [100.0 + i for i in range(8)])), "vwap")
    assert out[:4] == [None] * 4 and out[4] is not None


def test_zero_volume_and_constant_volume(spark):
    df = features.gold_features(candles(spark, [100.0] * 8, [0.0] * 8))
    assert one(df, "vwap") == [None] * 8 and one(df, "volume_z") == [None] * 8
    assert not any(v is not None and math.isinf(v) for r in df.select("return_1", "volatility_20").collect() for v in r)


def test_vwap_is_not_cumulative(spark):
    out = one(features.gold_features(candles(spark, [100.0] * 20 + [200.0] * 20)), "vwap")
    assert math.isclose(out[-1], (210 + 195 + 200) / 3)


@pytest.mark.parametrize("change, code", [({"close": None}, "C2"), ({"volume": float("nan")}, "C2"), ({"high": 1.0}, "C3"), ({"close": 999.0}, "C4"), ({"open": 1.0}, "C5"), ({"volume": -1.0}, "C6"), ({}, None)])
def test_corrupt_codes(spark, change, code):
    df = candles(spark, [100.0]).withColumns({k: F.lit(v).cast("double") for k, v in change.items()})
    assert silver.classified(df).first()["corrupt"] == code


def test_suspicions_skip_corrupt_neighbours(spark):
    df = candles(spark, [100.0, 101.0, 102.0, 103.0]).withColumn("close", F.when(F.col("close") == 101, 999.0).otherwise(F.col("close")))
    rows = silver.classified(df).orderBy("timestamp").collect()
    assert [r["label"] for r in rows] == ["clean", "corrupt", "suspect", "clean"] and rows[2]["violations"] == ["S3"]


def test_silver_of_strings_and_empty(spark):
    df = candles(spark, [100.0, 101.0]).withColumns({"timestamp": F.unix_millis("timestamp").cast("string"), "close": F.col("close").cast("string")})
    assert silver.silver_candles(df).count() == 2
    assert silver.silver_candles(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="missing columns"):
        silver.silver_candles(df.drop("close"))


def test_resample_drops_the_open_bucket(spark):
    df = candles(spark, [float(i + 1) for i in range(9)])
    four = resample.resample(df, ["4h"]).orderBy("timestamp").collect()
    assert [(r["open"], r["close"], r["volume"]) for r in four] == [(1.0, 4.0, 4000.0), (5.0, 8.0, 4000.0)]
    assert resample.resample(df, ["4h"], 1_704_067_200_000 + 12 * H).count() == 3


def test_gap_of_three(spark):
    df = candles(spark, [100.0] * 10).where(~F.hour("timestamp").isin(4, 5, 6))
    g = gaps.scan_gaps(df).collect()
    assert [(r["expected"], r["severity"]) for r in g] == [(3, "medium")]
    assert gaps.scan_gaps(candles(spark, [100.0] * 10)).count() == 0


def test_heal_counts_only_inside(spark):
    full = candles(spark, [100.0] * 10)
    g = gaps.scan_gaps(full.where(~F.hour("timestamp").isin(4, 5)))
    out = gaps.repair_outcome(g, gaps.healed(g, full.union(full.withColumn("seq", F.lit(1))))).first()
    assert (out["filled"], out["fill_ratio"], out["outcome"]) == (2, 1.0, "full")
    assert gaps.repair_outcome(g, gaps.healed(g, full.limit(0))).first()["outcome"] == "failed"


def test_scores(spark):
    clean = quality.checks(candles(spark, [100.0 + i % 3 for i in range(60)]), 4_000_000_000_000)
    assert quality.decisions(clean, quality.issues(clean)).first()["decision"] == "accept"
    late = quality.checks(candles(spark, [100.0 + i % 3 for i in range(60)]), 0)
    assert quality.decisions(late, quality.issues(late)).first()["decision"] == "reject"


def test_ema_across_blocks(spark):
    closes = [100.0 + (i * 37) % 11 for i in range(40)]
    want, y = [], None
    for c in closes:
        y = c if y is None else y * 0.8 + c * 0.2
        want.append(y)
    got = one(strategy.ema(candles(spark, closes), {"e": 9}, block=7), "e")
    assert all(math.isclose(a, b) for a, b in zip(got, want, strict=True))


def test_crosses(spark):
    golden = strategy.crossovers(candles(spark, [100.0 - i for i in range(30)] + [71.0 + 5 * i for i in range(12)]))
    assert [r["signal"] for r in golden.where("signal != 'hold'").collect()] == ["buy"]
    assert strategy.crossovers(candles(spark, [100.0] * 10)).count() == 0
    with pytest.raises(ValueError, match="unknown strategy"):
        strategy.run_strategy("nothing", candles(spark, [1.0]))


def fills(spark, rows):
    return spark.createDataFrame([(1, "BTC", i, s, p, a) for i, (s, p, a) in enumerate(rows)], "account int, symbol string, trade_id long, side string, price double, amount double").withColumn("timestamp", F.timestamp_seconds("trade_id"))


def test_weighted_average_cost(spark):
    folded = portfolio.fold_fills(fills(spark, [("buy", 100.0, 1.0), ("buy", 200.0, 1.0), ("sell", 180.0, 1.5), ("sell", 180.0, 9.0), ("sell", 1.0, 1.0)]))
    closed = portfolio.closed_trades(folded).collect()
    assert [(r["closed_qty"], r["avg_entry_price"]) for r in closed] == [(1.5, 150.0), (0.5, 150.0)]
    assert portfolio.positions(folded).count() == 0
    done = portfolio.settled(portfolio.closed_trades(folded), F.lit(5.0), F.lit("unknown")).collect()
    assert done[0]["net_realized_usd"] is None and done[0]["pnl_usd"] == 45.0


def test_drawdown(spark):
    df = spark.createDataFrame([(1, 1, 100.0), (1, 2, -50.0), (1, 3, 10.0)], "account int, trade_id int, pnl_usd double").withColumn("exit_at", F.timestamp_seconds("trade_id"))
    assert math.isclose(portfolio.max_drawdown(portfolio.equity_curve(df, 900.0)).first()["max_drawdown"], 0.05)


def test_book(spark):
    level = "array<struct<price:double,qty:double>>"
    df = spark.sql(f"SELECT cast(array(named_struct('price', 99D, 'qty', 1D), named_struct('price', 100D, 'qty', 1D)) AS {level}) AS bids, cast(array() AS {level}) AS asks")
    df = df.selectExpr("*", "'x' AS exchange", "'s' AS symbol", "1L AS ts_ms")
    assert df.select(t.book_problem().alias("v")).first()["v"] == "bids_not_falling"
    row = t.book_measures(t.sorted_book(df)).first()
    assert (row["best_bid"], row["best_ask"], row["mid"], row["crossed"]) == (100.0, None, None, False)


def test_wire_round_trip_and_rejects(spark):
    c = candles(spark, [1.0, 2.0])
    sent = landed.candle_messages(c, "r")
    again = landed.exploded_bars(landed.parsed(sent, "ohlcv"))
    assert again.count() == 2
    bad = spark.createDataFrame([("{",), ('{"event_id":"a","event_version":2,"source":"live"}',), ('{"event_id":"a","event_version":1,"source":"x"}',)], "value string")
    assert [r["reject_reason"] for r in landed.parsed(bad, "ohlcv").collect()] == ["undecodable", "bad_version", "bad_source"]


def test_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(LookupError):
        lake.resolve("t")
    lake.commit(candles(spark, [1.0, 2.0]).drop("seq"), "t", 1, 1000)
    lake.commit(candles(spark, [5.0]).drop("seq"), "t", 2, 2000)
    lake.commit(candles(spark, [9.0]).drop("seq"), "t", 2, 3000)
    assert one(lake.candles("t"), "close") == [5.0, 2.0]
    assert one(lake.candles("t", as_of_ms=1500), "close") == [1.0, 2.0]
    assert lake.fresh("t", 2500) and not lake.fresh("t", 10**9)
    with pytest.raises(ValueError, match="version"):
        lake.resolve("t", "v3")


def test_rows_of_failed_commits_are_not_read(spark, tmp_path):
    """A commit that crashed before its log entry leaves files that no read gives, also after later commits."""
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.commit(candles(spark, [1.0, 2.0]).drop("seq"), "t", 1, 1000)
    crashed = candles(spark, [7.0, 7.0, 7.0]).drop("seq").withColumn("ts_month", F.date_format("timestamp", "yyyy-MM"))
    crashed.write.partitionBy("exchange", "symbol", "timeframe", "ts_month").parquet(f"{lake.folder}/t/commit_id=2")
    assert one(lake.candles("t"), "close") == [1.0, 2.0]
    lake.commit(candles(spark, [5.0]).drop("seq"), "t", 3, 900)  # logged with an earlier time: not the newest
    assert one(lake.candles("t"), "close") == [1.0, 2.0]
    lake.commit(candles(spark, [6.0]).drop("seq"), "t", 0, 2000)  # a lower id, but newer
    assert one(lake.candles("t"), "close") == [6.0, 2.0]
    with pytest.raises(LookupError):
        lake.found("t", ["no such symbol"])


def test_retention_expires_versions_not_rows(spark, tmp_path):
    lake, day = Lake(spark, str(tmp_path / "lake")), 86_400_000
    for k in (1, 2, 3):
        lake.commit(candles(spark, [float(k)] * k).drop("seq"), "t", k, k * day)
    rows = one(lake.candles("t"), "close")
    assert tuple(lake.retention("t", 9 * day, 3, dry_run=False).first()) == (3, 2)
    assert one(lake.candles("t"), "close") == rows and tuple(lake.retention("t", 9 * day, 3).first()) == (1, 0)
    with pytest.raises(LookupError):
        lake.resolve("t", 1)


def test_rules_name_the_first_fault(spark):
    from tideframe.operators import rules

    df = spark.createDataFrame([("ex", "spot", "s", "1", 1, 1.0, 1.0, "live"), ("ex", "spot", "s", "1", 1, float("nan"), 1.0, "live"), ("ex", "", None, "1", 1, 1.0, 1.0, "live"), ("ex", "spot", "s", "1", 1, 1.0, None, "x")], "exchange string, market_type string, symbol string, trade_id string, timestamp_ms long, price double, amount double, source string")
    assert [r[0] for r in df.select(rules.trade_problem()).collect()] == [None, None, "no_market_type", "bad_amount"]  # NaN is above every number
    with pytest.raises(LookupError):
        rules.sliced(df.withColumn("timestamp", F.timestamp_millis("timestamp_ms")), from_ms=5)
    with pytest.raises(TypeError):
        rules.assert_utc(df.withColumn("timestamp", F.lit("2024-01-01")))
    bad = candles(spark, [1.0, 2.0]).withColumn("high", F.col("low") - 1)
    with pytest.raises(Exception, match="invalid candle"):
        rules.chunks(bad, ["symbol"], H).collect()


def test_kinds_that_may_be_consumed():
    from tideframe.sources import events

    events.require_promoted("snapshot", "order_filled")
    with pytest.raises(ValueError, match="liquidation"):
        events.require_promoted("snapshot", "liquidation")


def test_policies_are_parameters(spark):
    found = quality.checks(candles(spark, [100.0 + i % 3 for i in range(60)]), 0)
    lenient = quality.Policy(weights={"future_timestamps": 0.0}, critical_share=2.0)
    assert quality.decisions(found).first()["decision"] == "reject" and quality.decisions(found, policy=lenient).first()["decision"] == "accept"


def test_compounding_with_losses_of_all_and_more(spark):
    rows = [(1, i, f) for i, f in enumerate([0.5, -1.5, -1.2, 0.1])] + [(2, 9, -1.0), (2, 10, 3.0)]
    df = spark.createDataFrame(rows, "account int, trade_id int, pnl_pct double").withColumn("exit_at", F.timestamp_seconds("trade_id"))
    got = {(r["account"], r["step"]): r["equity"] for r in portfolio.compounded(df).collect()}
    want = {(1, 0): 1.0, (1, 1): 1.5, (1, 2): -0.75, (1, 3): 0.15, (1, 4): 0.165, (2, 0): 1.0, (2, 1): 0.0, (2, 2): 0.0}
    assert got == pytest.approx(want)
