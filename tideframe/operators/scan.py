"""Running values of long series in blocks, so that one key is not one task.

A running sum, count, minimum or maximum is told within each block of a key's order, and the blocks' own totals, one row
each, tell what comes before every block. Rows are shuffled once, by key and block; only totals pass one task of a key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: How two totals become one.
JOIN = {
    "sum": (F.sum, lambda before, here: F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))),
    "min": (F.min, lambda before, here: F.least(before, here)),
    "max": (F.max, lambda before, here: F.greatest(before, here)),
}


def by_day(at: str = "timestamp") -> Column:
    """Blocks of a day."""
    return F.floor(F.unix_millis(at) / 86_400_000)


def _same(key: list[str]) -> Column:
    return reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*key, "_block")))


def running(rows: DataFrame, key: list[str], order: list[str | Column], values: dict[str, tuple], block: Column) -> DataFrame:
    """rows with each named value running over a key's order: a kind of JOIN, what it is of, and False if the row itself does not count.

    block is a number that never falls in that order. Rows of a null key are a key; where nothing has a value a sum is 0, the others are null.
    """
    rows = rows.withColumn("_block", block)
    inside = Window.partitionBy(*key, "_block").orderBy(*order)
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*key, "_block").agg(*(JOIN[kind][0](c).alias(n) for n, (kind, c, *_) in values.items()))
    carried = totals.select(*(F.col(c).alias(f"_of_{c}") for c in (*key, "_block")), *(JOIN[kind][0](F.col(n)).over(before).alias(f"_before_{n}") for n, (kind, *_) in values.items()))
    frame = lambda own: inside.rowsBetween(Window.unboundedPreceding, -1 if own == [False] else 0)
    told = rows.withColumns({f"_here_{n}": JOIN[kind][0](c).over(frame(own)) for n, (kind, c, *own) in values.items()}).join(carried, _same(key), "left")
    told = told.withColumns({n: JOIN[kind][1](F.col(f"_before_{n}"), F.col(f"_here_{n}")) for n, (kind, *_) in values.items()})
    return told.drop("_block", *(f"_of_{c}" for c in (*key, "_block")), *(f"_{x}_{n}" for n in values for x in ("before", "here")))


def previous(rows: DataFrame, key: list[str], order: str, value: str, name: str, block: Column) -> DataFrame:
    """rows with the value of the row before in a key's order; null for the first."""
    rows = rows.withColumn("_block", block)
    inside = Window.partitionBy(*key, "_block").orderBy(order)
    last = rows.groupBy(*key, "_block").agg(F.max_by(F.struct(value), order).alias("_last"))
    carried = last.select(*(F.col(c).alias(f"_of_{c}") for c in (*key, "_block")), F.lag(f"_last.{value}").over(Window.partitionBy(*key).orderBy("_block")).alias("_carried"))
    told = rows.withColumns({"_first": F.row_number().over(inside) == 1, "_here": F.lag(value).over(inside)})
    told = told.join(carried, _same(key), "left").withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_here")))
    return told.drop("_block", "_first", "_here", "_carried", *(f"_of_{c}" for c in (*key, "_block")))
