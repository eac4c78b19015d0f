"""Quantiles that merge: counts by bucket are kept, so batches and streams add up and no value is read twice."""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The widest that a value of a log histogram may be off, as a share of itself.
ERROR = 0.01
#: The bucket of all values that are not positive.
ZERO = -(1 << 30)
# Upper bounds in milliseconds of the latency histogram.
LATENCY_BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0]


def log_bucket(value: Column, error: float = ERROR) -> Column:
    """The bucket of a value: buckets are powers of 1 + error, so a bucket's values differ by that share at most; null for null and NaN."""
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.when(v <= 0, F.lit(ZERO)).when(v > 0, F.ceil(F.ln(v) / log(1 + error)).cast("int"))


def log_histogram(rows: DataFrame, by: list[str], value: str, error: float = ERROR) -> DataFrame:
    """by, bucket, n: as many rows as a key has different magnitudes, however many values. On a stream it is a state that Spark merges batch by batch."""
    return rows.withColumn("bucket", log_bucket(F.col(value), error)).where("bucket IS NOT NULL").groupBy(*by, "bucket").agg(F.count("*").alias("n"))


def merged(by: list[str], *histograms: DataFrame) -> DataFrame:
    """Histograms of parts as one of the whole."""
    return reduce(DataFrame.unionByName, histograms).groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def quantiles(histogram: DataFrame, by: list[str], shares: dict[str, float], error: float = ERROR) -> DataFrame:
    """by, n and each named quantile of a log histogram, linear between a bucket's ends; within the error of the value at that rank."""
    order = Window.partitionBy(*by).orderBy("bucket")
    rows = histogram.withColumns({"_upto": F.sum("n").over(order), "_all": F.sum("n").over(Window.partitionBy(*by))})
    low = F.pow(F.lit(1 + error), F.col("bucket") - 1)
    told = []
    for name, share in shares.items():
        rank = share * (F.col("_all") - 1)  # from 0
        before = F.col("_upto") - F.col("n")
        here = (F.col("_upto") > rank) & (before <= rank)
        value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(low * (1 + error * (rank - before + 0.5) / F.col("n")))
        told.append(F.max(F.when(here, value)).alias(name))
    return rows.groupBy(*by).agg(F.sum("n").alias("n"), *told)


def bound_quantiles(counts: DataFrame, by: list[str], shares: dict[str, float], bounds: list[float]) -> DataFrame:
    """AGG20: quantiles of a histogram by upper bounds (bucket: how many bounds are below), linear within a bucket; what is above the last bound counts as it."""
    edges = F.array(*map(F.lit, [0.0, *bounds, bounds[-1]]))
    rows = counts.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by).orderBy("bucket")
    rows = rows.withColumns({"_upto": F.sum("n").over(order), "_all": F.sum("n").over(Window.partitionBy(*by)), "_low": F.get(edges, F.col("bucket")), "_high": F.get(edges, F.col("bucket") + 1)})
    told = []
    for name, share in shares.items():
        rank = share * F.col("_all")
        before = F.col("_upto") - F.col("n")
        here = (F.col("_upto") >= rank) & (before < rank)
        told.append(F.max(F.when(here, F.col("_low") + (F.col("_high") - F.col("_low")) * (rank - before) / F.col("n"))).alias(name))
    return rows.groupBy(*by).agg(F.sum("n").alias("n"), *told)
