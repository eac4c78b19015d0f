"""One local session for all tests, and comparison with DuckDB."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

REPO = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = f"{REPO}:{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in sorted(Path(SF).glob("*.parquet")):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v) -> str:
    """A value as text that both engines share."""
    if v is None or isinstance(v, (bool, str)):
        return str(v)
    f = float(v)
    return "nan" if math.isnan(f) else str(int(f)) if f == int(f) and abs(f) < 1e15 else f"{f:.6f}"


def same(df, relation) -> None:
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    wanted = sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == wanted
