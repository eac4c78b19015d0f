"""Market rows through the publishers: order, repeated batches, refused rows and defaults."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tideframe.sources.events import book_events, events
from tideframe.streaming.publishers import market_messages, publisher

ROWS = "kind string, exchange string, symbol string, timestamp_ms long, bids array<array<string>>, side string, price decimal(18,4), size string, extra string"


def sent(folder, topic, seq):
    found = {}
    for path in sorted((folder / topic / f"seq={seq:012d}").glob("part-*")):
        for line in path.read_text().splitlines():
            record = json.loads(line)
            found.setdefault(record["key"], []).append((path.name, json.loads(record["value"])))
    return found


def test_books_keep_their_order_and_batches_replace_themselves(spark, tmp_path):
    rows = [("delta", "x", s, at, None, "bid", 1.5, "2", "left out") for s in "abc" for at in (7, 5, 6)] + [("snapshot", "x", s, 6, [["1", "2"]], None, None, None, None) for s in "abc"]
    df = spark.createDataFrame(rows, ROWS.replace("decimal(18,4)", "double")).withColumn("price", F.col("price").cast("decimal(18,4)"))
    write = publisher(["snapshot", "delta"], str(tmp_path))
    write(df, 0)
    first = sent(tmp_path, "orderbook.raw", 0)
    write(df.repartition(5), 0)  # run again, in another order
    assert sorted(first) == ["x:a", "x:b", "x:c"] and {k: [v for _, v in x] for k, x in sent(tmp_path, "orderbook.raw", 0).items()} == {k: [v for _, v in x] for k, x in first.items()}
    for events_ in first.values():
        assert len({name for name, _ in events_}) == 1
        assert [(v["timestamp_ms"], v["payload_type"]) for _, v in events_] == [(5, "delta"), (6, "snapshot"), (6, "delta"), (7, "delta")]
        assert events_[0][1]["price"] == "1.5000" and "extra" not in events_[0][1]
    metrics = spark.read.parquet(f"{tmp_path}/metrics").collect()
    assert {(r["kind"], r["outcome"], r["n"]) for r in metrics} == {("snapshot", "published", 3), ("delta", "published", 9)}
    snapshots, deltas, others = book_events(spark.createDataFrame([(json.dumps(v),) for x in first.values() for _, v in x], "value string"))
    assert (snapshots.count(), deltas.count(), others.count()) == (3, 9, 0) and snapshots.where("bids[0].price = 1.0").count() == 3


def test_refused_rows_are_told_and_not_sent(spark, tmp_path):
    rows = [("delta", "x", "a", 1, None, "up", None, "2", ""), ("delta", None, "a", 1, None, "bid", None, "2", ""), ("delta", "x", "a", None, None, None, None, None, "")]
    df = spark.createDataFrame(rows, ROWS)
    write = publisher(["snapshot", "delta"], str(tmp_path))
    write(df, 0)
    write(df.limit(0), 1)
    assert sent(tmp_path, "orderbook.raw", 0) == {} and (tmp_path / "orderbook.raw" / "seq=000000000001" / "_SUCCESS").exists()
    assert [r["reject_reason"] for r in spark.read.parquet(f"{tmp_path}/failed").collect()] == ["missing_field"] * 3


def test_defaults_and_ids(spark):
    df = spark.createDataFrame([("x", "a", 1, "0.1"), ("x", "a", 1, "0.1"), ("x", "a", 2, "0.1")], "exchange string, symbol string, timestamp_ms long, funding_rate string")
    told = events(market_messages(df, "funding").select("value"), "funding").collect()
    assert {r["market_type"] for r in told} == {"linear"} and len({r["event_id"] for r in told}) == 2 and {r["reject_reason"] for r in told} == {None}


def test_a_log_is_read_in_arrow_batches(spark, tmp_path):
    from tideframe.sources import log_source

    log_source.publish(spark.range(5000).selectExpr("'k' AS key", "CAST(id AS STRING) AS value").coalesce(1), f"{tmp_path}/log")
    reader = log_source._Reader({"path": f"{tmp_path}/log"})
    batches = [b for part in reader.partitions({"next": 0}, {"next": 1}) for b in reader.read(part)]
    assert [b.num_rows for b in batches] == [4096, 904]
    assert sorted(int(v) for b in batches for v in b.column("value").to_pylist()) == list(range(5000))
