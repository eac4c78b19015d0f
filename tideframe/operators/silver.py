"""Bronze to Silver: casts, deduplication, candle classification and schema rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, TimestampNTZType
from pyspark.sql.window import Window

from tideframe.functions.timeframes import ms_of
from tideframe.operators.resample import KEY, OHLCV, align_to_grid

#: The first day that a candle may be of.
GENESIS = "2009-01-03"
REQUIRED = ["timestamp", *OHLCV]


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """PRJ5: df, or an error that names the missing columns."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def normalize_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """PRJ1/PRJ2: integers and numeric strings are epoch milliseconds, times without zone are UTC; microseconds."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, IntegralType):
        c = F.timestamp_millis(c.cast("long"))
    elif isinstance(kind, StringType):
        c = F.coalesce(F.timestamp_millis(c.try_cast("bigint")), c.try_cast("timestamp"))
    elif isinstance(kind, TimestampNTZType):
        c = c.cast("timestamp")
    return df.withColumn(column, c)


def convert_types(df: DataFrame) -> DataFrame:
    """PRJ1: timestamps as above, prices and volume leniently to doubles, NaN to null."""
    df = normalize_timestamps(df)
    return df.withColumns({c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")) for c in OHLCV if c in df.columns})


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """PRJ3/PRJ4: constant columns, only where df has none of that name."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def bronze_rows(df: DataFrame, now: Column | None = None, **identity: str) -> DataFrame:
    """PRJ6: UTC timestamps, arrival time, identity, fixed column order."""
    require_columns(df, REQUIRED)
    df = with_defaults(normalize_timestamps(df), {k: v for k, v in identity.items()})
    return df.withColumn("ingestion_ts", now if now is not None else F.current_timestamp()).select(*KEY, "timestamp", *OHLCV, "ingestion_ts")


def deduplicated(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """DED1-DED6: one row for each key: the first in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def first_by_arrival(df: DataFrame, seq: str = "seq") -> DataFrame:
    return deduplicated(df, [*KEY, "timestamp"], [F.col(seq).asc()])


def last_by_arrival(df: DataFrame, seq: str = "seq") -> DataFrame:
    return deduplicated(df, [*KEY, "timestamp"], [F.col(seq).desc()])


def latest_trades(trades: DataFrame, seq: str = "timestamp") -> DataFrame:
    """DED4: of each trade id of a venue the last row; a maximum of structs, so it aggregates before it shuffles."""
    rest = [c for c in trades.columns if c not in ("exchange", "symbol", "trade_id")]
    best = F.max(F.struct(F.col(seq).alias("_seq"), *rest)).alias("_r")
    return trades.groupBy("exchange", "symbol", "trade_id").agg(best).select("exchange", "symbol", "trade_id", *(F.col(f"_r.{c}").alias(c) for c in rest))


# ---- classification ---------------------------------------------------------------------------


def corrupt_code() -> Column:
    """FLT1: the first rule that a candle breaks, or null. C0 is a row that is not a candle at all."""
    o, h, lo, c, v = (F.col(x) for x in OHLCV)
    nothing = lambda x: x.isNull() | F.isnan(x)
    return (
        F.when(F.col("timestamp").isNull() | (F.unix_millis("timestamp") <= 0), "C1")
        .when(nothing(o) | nothing(h) | nothing(lo) | nothing(c) | nothing(v), "C2")
        .when(h < lo, "C3")
        .when(~c.between(lo, h), "C4")
        .when(~o.between(lo, h), "C5")
        .when(v < 0, "C6")
    )


def classified(candles: DataFrame, seq: str = "seq") -> DataFrame:
    """FLT1-FLT4: corrupt code, suspicions, label and reason; only accepted candles are the previous one of others."""
    order = Window.partitionBy(*KEY).orderBy("timestamp", seq)
    df = candles.withColumn("corrupt", corrupt_code())
    accepted = F.when(F.col("corrupt").isNull(), F.unix_millis("timestamp"))
    df = df.withColumn("previous_ms", F.last(accepted, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    off_step = F.abs(F.unix_millis("timestamp") - F.col("previous_ms") - ms_of(F.col("timeframe"))) > 1
    found = F.array_compact(F.array(F.when(F.col("volume") == 0, "S1"), F.when(F.col("high") == F.col("low"), "S2"), F.when(off_step, "S3")))
    df = df.withColumn("violations", F.when(F.col("corrupt").isNull(), found).otherwise(F.array(F.col("corrupt"))))
    label = F.when(F.col("corrupt").isNotNull(), "corrupt").when(F.size("violations") > 0, "suspect").otherwise("clean")
    return df.withColumn("label", label).drop("previous_ms")


def silver_candles(bronze: DataFrame, seq: str = "seq", told: Observation | None = None) -> DataFrame:
    """FLT7: cast, deduplicate by arrival, align to the grid, classify, drop what is corrupt; the label stays as quality_flag.

    One shuffle by series serves every step. told is filled by whatever first writes the result, without a pass of its own: rows on the
    grid, the rows that were moved to it and those that met there (AGG2, UDF4), rows that break each schema rule (FLT8/FLT9), and rows of each label.
    """
    df = convert_types(require_columns(bronze, REQUIRED)).repartition(*KEY)
    df = align_to_grid(first_by_arrival(df, seq), seq).withColumn(seq, F.lit(0))
    df = classified(df, seq)
    if told is not None:
        rules = [F.count_if(F.coalesce(bad, F.lit(True))).alias(name) for name, bad in row_rules().items()]
        labels = [F.count_if(F.col("label") == name).alias(name) for name in ("clean", "suspect", "corrupt")]
        df = df.observe(told, F.count("*").alias("rows"), F.sum("drifted").alias("drifted"), F.sum("collided").alias("collided"), *rules, *labels)
    return df.where("label != 'corrupt'").dropna(subset=REQUIRED).withColumnRenamed("label", "quality_flag").select(*KEY, "timestamp", *OHLCV, "quality_flag")


def validation_summary(candles: DataFrame) -> DataFrame:
    """AGG7: for each series how many candles have each label, their quality ratio, and whether over a tenth is corrupt."""
    n = F.count("*")
    return candles.groupBy(*KEY).agg(
        n.alias("total"),
        F.count_if(F.col("label") == "clean").alias("clean"),
        F.count_if(F.col("label") == "suspect").alias("suspect"),
        F.count_if(F.col("label") == "corrupt").alias("corrupt"),
        (F.count_if(F.col("label") == "clean") / n).alias("quality_ratio"),
        (F.count_if(F.col("label") == "corrupt") / n > 0.1).alias("too_corrupt"),
    )


def row_rules() -> dict[str, Column]:
    """FLT9: the schema rules that a row alone can break."""
    o, h, lo, c, v = (F.col(x) for x in OHLCV)
    return {
        "before_genesis": F.col("timestamp") < F.lit(GENESIS).cast("timestamp"),
        "price_not_positive": (o <= 0) | (h <= 0) | (lo <= 0) | (c <= 0),
        "volume_negative": v < 0,
        "low_not_lowest": (lo > o) | (lo > c) | (lo > h),
        "high_not_highest": (h < o) | (h < c) | (h < lo),
    }


def schema_report(candles: DataFrame) -> DataFrame:
    """FLT8/FLT9: for each series how many rows break each rule. One pass and one shuffle for all rules."""
    stamp = Window.partitionBy(*KEY, "timestamp")
    df = candles.withColumn("_same", F.count("*").over(stamp))
    ms = ms_of(F.col("timeframe"), strict=False)
    return df.groupBy(*KEY).agg(
        *(F.count_if(F.coalesce(bad, F.lit(True))).alias(name) for name, bad in row_rules().items()),
        F.count_if(F.col("_same") > 1).alias("timestamp_repeated"),
        F.count_if(F.coalesce(F.unix_millis("timestamp") % ms != 0, F.lit(False))).alias("off_grid"),
    )


def order_report(candles: DataFrame, seq: str) -> DataFrame:
    """FLT8: for each series how many rows are not later than the one that arrived before."""
    back = F.col("timestamp") <= F.lag("timestamp").over(Window.partitionBy(*KEY).orderBy(seq))
    return candles.withColumn("_back", back).groupBy(*KEY).agg(F.count_if("_back").alias("not_increasing"))


def extra_columns(candles: DataFrame) -> list[str]:
    """FLT8: the columns that a candle does not have."""
    return [c for c in candles.columns if c not in (*KEY, "timestamp", *OHLCV)]


def labelled(candles: DataFrame) -> DataFrame:
    """PRJ9: Silver rows of landed candles: classified, without what is corrupt, in the fixed order of columns."""
    df = classified(candles.withColumn("_seq", F.lit(0)), "_seq")
    return df.where("label != 'corrupt'").withColumnRenamed("label", "quality_flag").select(*KEY, "timestamp", *OHLCV, "quality_flag")


def append_bronze(lake, candles: DataFrame, commit_id: int, now_ms: int, **identity: str) -> None:
    """SNK1/PRJ6: candles with identity and time of arrival into the Bronze table; none at all is an error."""
    if candles.isEmpty():
        raise ValueError("an empty table cannot be appended")
    lake.commit(bronze_rows(candles, F.timestamp_millis(F.lit(now_ms)), **identity), "bronze", commit_id, now_ms)
