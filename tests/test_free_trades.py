"""Queries against their SQL where some events have a value of nothing, which the smaller tables lack."""

from __future__ import annotations

import duckdb
import pytest
from tests.conftest import SF, same

from tideframe.plans import registry

QUERIES = [
    "anl3_anl4_settlement",
    "anl5_anl6_performance",
    "ded7_str_once",
    "flt15_deltas",
    "flt17_trade_rules",
    "snk6_str_trades",
    "src10_src17_trade_events",
    "src12_snk15_book_events",
    "str12_fan_out",
    "str4_str7_window_totals",
    "str5_window_candles",
    "str8_monotonic",
]


@pytest.fixture(scope="module")
def free(tmp_path_factory):
    """A folder whose events have one value in seven of nothing, a position's first ones too, and the newest event among them; the other tables stay."""
    folder = tmp_path_factory.mktemp("free")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 7 = 3 OR ts = max(ts) OVER () THEN 0.0 ELSE value END AS value) FROM '{SF}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_free_trades(spark, free, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{free}/events.parquet'")
    same(registry.QUERIES[name](spark, free), con.sql(registry.ORACLE_SQL[name]))
