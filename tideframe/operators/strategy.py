"""Strategies over candles: exponential averages, crossovers, and a registry of strategies."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideframe.functions.timeframes import ms_of
from tideframe.operators.resample import KEY
from tideframe.operators.silver import require_columns

BLOCK = 128


def ema(candles: DataFrame, spans: dict[str, int], value: str = "close", block: int = BLOCK) -> DataFrame:
    """WIN16: recursive exponential averages, seeded with the first value; one column for each name in spans.

    y = (1 - a) y' + a x is an affine map of y', and maps compose. Blocks, each of the time of so many
    candles, are folded side by side, only their coefficients pass through one task of a series, and each block
    then runs from its carried-in value; the first one from its first value, which leaves that value as it is.
    """
    rest = [c for c in candles.columns if c not in KEY]
    rows = candles.withColumn("_block", F.floor(F.unix_millis("timestamp") / (ms_of(F.col("timeframe")) * block)))
    blocks = rows.groupBy(*KEY, "_block").agg(F.array_sort(F.collect_list(F.struct("timestamp", *(c for c in rest if c != "timestamp")))).alias("_rows"))
    names = list(spans)
    alpha = {n: 2.0 / (spans[n] + 1) for n in names}

    def fold(n: str) -> list:
        a = alpha[n]
        return [F.aggregate("_rows", F.lit(0.0), lambda y, x: y * (1 - a) + x[value] * a).alias(f"b_{n}"), F.pow(F.lit(1 - a), F.size("_rows")).alias(f"a_{n}")]

    folds = [c for n in names for c in fold(n)]
    summary = blocks.select(*KEY, "_block", F.get("_rows", F.lit(0))[value].cast("double").alias("first"), *folds)

    def carried(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        out = {f"in_{n}": [] for n in names}
        y = dict.fromkeys(names, pdf["first"].iloc[0])
        for values in pdf.to_dict("records"):
            for n in names:
                out[f"in_{n}"].append(y[n])
                y[n] = y[n] * values[f"a_{n}"] + values[f"b_{n}"]
        return pdf[[*KEY, "_block"]].assign(**out)

    kind = ", ".join(f"{c} string" for c in KEY) + ", _block long, " + ", ".join(f"in_{n} double" for n in names)
    ins = summary.groupBy(*KEY).applyInPandas(carried, kind)
    joined = blocks.join(ins, [*KEY, "_block"])

    def running(n: str):
        a = alpha[n]

        def step(ys, x):
            before = F.coalesce(F.try_element_at(ys, F.lit(-1)), F.col(f"in_{n}"))
            return F.concat(ys, F.array(before + (x[value] - before) * a))

        return F.aggregate("_rows", F.array().cast("array<double>"), step)

    joined = joined.withColumns({f"_{n}": running(n) for n in names})
    zipped = F.arrays_zip("_rows", *(f"_{n}" for n in names))
    flat = joined.select(*KEY, F.explode(zipped).alias("z"))
    return flat.select(*KEY, *(F.col(f"z._rows.{c}").alias(c) for c in rest), *(F.col(f"z._{n}").alias(n) for n in names))


def crossovers(candles: DataFrame, fast: int = 9, slow: int = 21, last_only: bool = False) -> DataFrame:
    """WIN17: buy where the fast average rises above the slow one, sell where it falls below.

    last_only gives a signal for the newest candle of each series alone; series shorter than slow + 1 give none.
    """
    order = Window.partitionBy(*KEY).orderBy("timestamp")
    df = ema(candles, {"ema_fast": fast, "ema_slow": slow}).withColumn("above", F.col("ema_fast") > F.col("ema_slow"))
    df = df.withColumn("_n", F.count("*").over(Window.partitionBy(*KEY))).withColumn("_i", F.row_number().over(order))
    df = df.withColumn("_before", F.lag("above").over(order))
    signal = F.when(F.col("above") & ~F.col("_before"), "buy").when(~F.col("above") & F.col("_before"), "sell").otherwise("hold")
    df = df.withColumn("signal", signal).where(F.col("_n") >= slow + 1)
    if last_only:
        df = df.where(F.col("_i") == F.col("_n"))
    return df.drop("_n", "_i", "_before")


Strategy = Callable[[DataFrame], DataFrame]
_STRATEGIES: dict[str, tuple[Strategy, list[str]]] = {}


def strategy(name: str, columns: list[str]):
    """WIN18/UDF1: register a function of candles to signals; it needs the named columns."""

    def add(function: Strategy) -> Strategy:
        if name in _STRATEGIES:
            raise ValueError(f"strategy {name!r} is registered already")
        _STRATEGIES[name] = (function, columns)
        return function

    return add


def run_strategy(name: str, candles: DataFrame) -> DataFrame:
    if name not in _STRATEGIES:
        raise ValueError(f"unknown strategy {name!r}; known: {sorted(_STRATEGIES)}")
    function, columns = _STRATEGIES[name]
    return function(require_columns(candles, columns))


strategy("ema_crossover", [*KEY, "timestamp", "close"])(crossovers)


@strategy("range_breakout", [*KEY, "timestamp", "high", "low", "close"])
def range_breakout(candles: DataFrame, rows: int = 20) -> DataFrame:
    """Buy above the highest high of the rows before, sell below the lowest low."""
    before = Window.partitionBy(*KEY).orderBy("timestamp").rowsBetween(-rows, -1)
    signal = F.when(F.col("close") > F.max("high").over(before), "buy").when(F.col("close") < F.min("low").over(before), "sell").otherwise("hold")
    return candles.withColumn("signal", signal)
