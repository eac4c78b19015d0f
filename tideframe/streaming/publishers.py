"""SNK15: rows of books, funding, open interest and liquidations as wire events of landed logs, batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideframe.sources.events import DEFAULTS, FIELDS, VERSION, events
from tideframe.sources.landed import routing_key
from tideframe.sources.log_source import publish

# The topic of each kind of event; a book's snapshots and deltas share one, so that they stay in order.
TOPICS = {"snapshot": "orderbook.raw", "delta": "orderbook.raw", "funding": "funding.raw", "open_interest": "oi.raw", "liquidation": "liquidations.raw"}
#: Kinds whose events name themselves, as their topic has several.
NAMED = ["snapshot", "delta"]


def market_messages(rows: DataFrame, kind: str) -> DataFrame:
    """key (venue and symbol), value (JSON), at_ms, kind, exchange, and why a consumer would reject the event (null if it would not).

    Fields are taken by name and cast to the kind's types (give exact numbers as decimals or text); those that rows lack, or that are null, get the kind's
    default. An event's id is a hash of what it says, so an event that is sent again keeps its id. Other columns are left out.
    """
    schema = StructType.fromDDL(FIELDS[kind][0])
    known = DEFAULTS.get(kind, {}) | ({"payload_type": kind} if kind in NAMED else {})
    given = {f.name: F.coalesce(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType), F.lit(known.get(f.name)).cast(f.dataType)) for f in schema.fields}
    body = rows.select(*(v.alias(n) for n, v in given.items() if n not in ("event_id", "event_version")))
    own = F.sha2(F.concat_ws("|", F.lit(kind), F.to_json(F.struct(*body.columns))), 256)
    sent = body.select(routing_key("exchange", "symbol").alias("key"), F.col("timestamp_ms").alias("at_ms"), F.to_json(F.struct(own.alias("event_id"), F.lit(VERSION).alias("event_version"), *body.columns)).alias("value"), "exchange")
    head = F.struct("key", "at_ms", "exchange", "value").alias("_head")
    return events(sent.select("value", head), kind, keep="_head").select("_head.*", F.lit(kind).alias("kind"), "reject_reason")


def publisher(kinds: list[str], folder: str) -> Callable[[DataFrame, int], None]:
    """Each batch of rows (kind and the fields of its kind) becomes the next batch of its topic's log, folder/<topic>.

    The kinds are those of one topic, and a log has one stream, whose batch numbers are the log's: a batch that is run again replaces itself.
    All of a symbol's events of a batch are in one file, in order of time, a snapshot before the deltas of its time. Rows that
    a consumer would reject are not sent: they stay in folder/failed with the reason; folder/metrics has the events of each
    batch by venue, kind and outcome, for stream_metrics() and health().
    """
    (topic,) = {TOPICS[k] for k in kinds}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        parts = [market_messages(batch.where(F.col("kind") == k), k) for k in kinds]
        told = reduce(DataFrame.unionByName, parts).persist()
        good = told.where("reject_reason IS NULL").repartition("key").sortWithinPartitions("key", "at_ms", F.col("kind") != "snapshot")
        publish(good, f"{folder}/{topic}", batch_id)
        told.where("reject_reason IS NOT NULL").select("key", "value", "kind", "reject_reason").write.mode("overwrite").parquet(f"{folder}/failed/topic={topic}/batch={batch_id}")
        outcome = F.when(F.col("reject_reason").isNull(), "published").otherwise("failed")
        told.groupBy("exchange", "kind", outcome.alias("outcome")).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{folder}/metrics/topic={topic}/batch={batch_id}")
        told.unpersist()
        batch.unpersist()

    return write
