"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from tideframe.plans import analytics, core, market, streams, tables, wire
from tideframe.plans.register import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "analytics", "core", "market", "streams", "tables", "wire"]
