"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, or chunk: a maximal run of bytes that are not ASCII white space.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset on a local master (tests), one of our own."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if given is None and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="tideframe-"))
        found = sc.getCheckpointDir()
    return found


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again.

    This cuts the lineage like checkpoint(), computes the plan once instead of twice, and
    leaves compressed columns that any executor can reread after another is lost.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that no plan reads any more."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm, True)


def broadcast_if_small(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A table to join with: stored, and marked for broadcast if it has so many rows at most; else joined by a shuffle."""
    table = stored(df)
    return F.broadcast(table) if table.count() <= most else table


def content_key(*columns: str) -> Column:
    """128 bits of what rows hold in some columns, by which verdicts on equal contents meet their rows however those are read."""
    held = [x for c in columns for x in (F.isnull(c), F.col(c))]
    return F.struct(F.xxhash64(*held).alias("a"), F.xxhash64(F.lit(1), *held).alias("b"))


def without(df: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """The rows of df whose key is not among those in the one column of gone, which is broadcast if it is small, as a
    check of its count says; else df is shuffled once by key."""
    name = fresh(df, "key")
    rest = broadcast_if_small(gone.toDF(name).distinct())
    return df.withColumn(name, key).join(rest, name, "left_anti").drop(name)


def frequent(table: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows of a table that are above the smallest frequency n that so many of them reach at most, and the others.

    The frequency is found from a histogram in steps of 2**(1/8), which has a few hundred rows.
    """
    stepped = table.withColumn("step", F.floor(F.log2("n") * 8).cast("int"))
    least, above = 0, 0
    for step, n in sorted(stepped.groupBy("step").count().collect(), reverse=True):
        above += n
        if above > most:
            least = step + 1
            break
    return tuple(stepped.where(F.col("step") >= least if head else F.col("step") < least).drop("step") for head in (True, False))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of df clashes with, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows that models may learn labels from: a known id outside the held-out fifth."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def byte_values(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string column."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


_held: dict = {}


def held_in_worker(key: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps for all its tasks of one stage; it lets go when it takes up another stage (see sliced)."""
    _let_go()
    if key not in _held:
        _held[key] = make()
    return _held[key]


def _let_go() -> None:
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if _held.get("stage") != stage:
        _held.clear()
        _held["stage"] = stage


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the worker gives memory that it has freed back to the system; workers are kept for later stages,
    and several of them share an executor's memory with the JVM."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def sliced(batches: Iterator[pa.RecordBatch], place: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the text column at that place has about so many bytes in each; a longer text comes alone."""
    _let_go()
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.maximum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False), 512))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def with_arrow_columns(df: DataFrame, inputs: list[str], fields: list[pa.Field], make: Callable[[], Callable[..., list]], drop: list[str] | None = None, most: int = 1 << 20) -> DataFrame:
    """df with further columns that Python computes a batch at a time from some input columns.

    make() runs once in each task and returns the function of the inputs' Arrow columns; the
    columns of df pass through as they are, but for those to drop. The first input is a text column, and
    a batch has about most bytes of it. Names of fields must be free in df.
    """
    from pyspark.sql.pandas.types import from_arrow_type
    from pyspark.sql.types import StructField, StructType

    places = [df.columns.index(c) for c in inputs]
    types = [f.type for f in fields]
    passed = [i for i, c in enumerate(df.columns) if c not in (drop or ())]
    names = [*(df.columns[i] for i in passed), *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in sliced(batches, places[0], most):
            added = compute(*(batch.column(i) for i in places))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in passed), *(v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(added, types, strict=True))], names=names)

    schema = StructType([*(df.schema.fields[i] for i in passed), *(StructField(f.name, from_arrow_type(f.type)) for f in fields)])
    return df.mapInArrow(tidied(run), schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
