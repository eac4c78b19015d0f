"""Parquet tables with a snapshot log: appends, scoped replaces, versions, as-of reads, file statistics, retention."""

from __future__ import annotations

import tempfile
import time
import zlib
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ["exchange", "market_type", "symbol", "timeframe"]
LOG = "commit_id long, committed_ms long, table string, kind string, exchange string, market_type string, symbol string, timeframe string, run_id string, feature_version string, source_commit_id long, added_rows long, files long, writer string, writer_version long, parts array<struct<path:string,rows:bigint,min_us:bigint,max_us:bigint>>"
GOLD_COLUMNS = ["timestamp", "open", "high", "low", "close", "volume", "log_return", "return_1", "volatility_20", "vwap", "high_low_spread", "volume_z", "price_range_pct", "body_pct", "is_suspect"]
#: So many files of the log are read beside its last fold at most, and those of one fold again.
FOLD_FILES = 128
#: What tells the rows of a series apart, by table; other tables have one row for each time.
ROW_KEYS = {"trades": ["timestamp", "trade_id"], "derivatives": ["timestamp", "metric"]}


def new_folder(spark: SparkSession) -> str:
    """A folder for tables that no location is given for: in the shared checkpoint folder, or, where none is set on a local master (tests), one of our own."""
    import uuid

    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base or tempfile.mkdtemp(prefix='tideframe-')}/lake-{uuid.uuid4().hex}"


def _series(df: DataFrame) -> DataFrame:
    """df with its series' columns named apart, to be joined by _same_series."""
    return df.withColumnsRenamed({c: f"_{c}" for c in KEY})


def _same_series() -> Column:
    """Equal series; tables without a timeframe have a null one."""
    return reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY))


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def wall_clock_ms() -> int:
    return time.time_ns() // 1_000_000


def new_commit_id(now_ms: int, writer: str, version: int) -> int:
    """A commit id that no other writer or version takes: its time, and 20 bits of who writes what."""
    return now_ms << 20 | zlib.crc32(f"{writer}/{version}".encode()) & 0xFFFFF


def _time(us: Column) -> Column:
    return F.timestamp_micros(us)


class Lake:
    """Tables under one folder. A row belongs to the commit that wrote it; the log says which commits are live.

    Rows that a commit wrote before it failed are in no log entry, so no read gives them. Of commits
    the one logged later is newer, and those of one time go by id. A log entry has the rows and the
    bounds of time of each file that it added, so that a read lists only files that can hold what it asks for, and
    bounds and manifests read no data file.

    A stream names itself and numbers its batches (writer, writer_version): a batch that is not above the last one
    logged by that writer is skipped, whatever other writers do, so what is run again adds nothing.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _listed(self, folder: str) -> dict[str, str]:
        """Names and paths of what lies in a folder of the lake."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{folder}")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(at)} if fs.exists(at) else {}

    def _last_fold(self) -> str | None:
        done = [path for name, path in sorted(self._listed("_folded").items()) if "_SUCCESS" in self._listed(f"_folded/{name}")]
        return done[-1] if done else None

    def _entries(self) -> DataFrame:
        """The last fold of the log and what was logged since. An entry that a reader finds in both counts once."""
        fold, since = self._last_fold(), [p for n, p in self._listed("_log").items() if n.startswith("part-")]
        read = self.spark.read.schema(LOG)
        if fold is None:
            return read.parquet(*since) if since else self.spark.createDataFrame([], LOG)
        both = read.parquet(fold)
        return both.unionByName(read.parquet(*since)).dropDuplicates(["table", "commit_id", "kind", *KEY]) if since else both

    def fold_log(self) -> None:
        """The whole log as one table, so that reads do not open a file for each commit there ever was. What a fold has taken up is
        removed by the next one, so that readers that have listed it can still read it; a fold that stopped half-way is not used."""
        last, files = self._last_fold(), self._listed("_log")
        names = [n for n in files if n.startswith("part-")]
        taken = {r["name"] for r in self.spark.read.parquet(last.replace("/_folded/", "/_folded_names/")).collect()} if last else set()  # names of files, FOLD_FILES about
        number = max((int(n.split("=")[1]) for n in self._listed("_folded")), default=0) + 1
        self.spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/_folded_names/fold={number:09d}")
        self._entries().coalesce(1).write.parquet(f"{self.folder}/_folded/fold={number:09d}")
        for name in taken & set(names):
            removed(self.spark, files[name])
        for kind in ("_folded", "_folded_names"):
            for name, path in self._listed(kind).items():
                if int(name.split("=")[1]) < number and path.rsplit("=", 1)[1] != (last or "=").rsplit("=", 1)[1]:
                    removed(self.spark, path)

    def log(self) -> DataFrame:
        """The log of commits; empty before the first one."""
        return self._entries().where("kind != 'expire'")

    def snapshots(self, table: str) -> DataFrame:
        """The commits of a table that can still be read as versions: those that have not expired."""
        gone = self._entries().where((F.col("table") == table) & (F.col("kind") == "expire")).select("commit_id")
        return self.log().where(F.col("table") == table).join(gone, "commit_id", "left_anti")

    def has(self, table: str, commit_id: int) -> bool:
        return not self.log().where((F.col("table") == table) & (F.col("commit_id") == commit_id)).isEmpty()

    def last_version(self, table: str, writer: str) -> int | None:
        """STR1: the last batch that a stream has logged in a table."""
        return self.log().where((F.col("table") == table) & (F.col("writer") == writer)).agg(F.max("writer_version")).first()[0]

    def commit(self, df: DataFrame, table: str, commit_id: int | None, now_ms: int, kind: str = "append", run_id: str = "run", feature_version: str | None = None, source_commit_id: int | None = None, writer: str | None = None, writer_version: int | None = None) -> bool:
        """SNK1-SNK7, SNK16: write rows and log the commit for each series; a commit that is logged already is skipped,
        and one without a row leaves no entry. True if rows were written and logged.

        kind replace: the commit stands for all of a series' rows before it. Trades and derivatives have no timeframe.
        With a writer and its version the commit id may be None; what such a commit wrote before it failed is an orphan, which sweep() removes.
        Files are about as large as AQE's advisory size: a hot symbol's month is cut into several.
        """
        if writer is not None:
            last = self.last_version(table, writer)
            if last is not None and last >= writer_version:
                return False
            commit_id = new_commit_id(now_ms, writer, writer_version) if commit_id is None else commit_id
        elif self.has(table, commit_id):
            return False
        month = F.date_format("timestamp", "yyyy-MM")
        path = f"{self.folder}/{table}/commit_id={commit_id}"
        parts = [c for c in ("exchange", "symbol", "timeframe") if c in df.columns]
        df = df.withColumn("ts_month", month)
        df.hint("rebalance", F.col("symbol"), F.col("ts_month")).sortWithinPartitions("timestamp").write.mode("overwrite").partitionBy(*parts, "ts_month").parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
        written = written if "timeframe" in parts else written.withColumn("timeframe", F.lit(None).cast("string"))
        us = F.unix_micros("timestamp")
        files = written.groupBy(*KEY, "_file").agg(F.count("*").alias("rows"), F.min(us).alias("min_us"), F.max(us).alias("max_us"))
        plain = F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B")))  # file paths are told as URIs
        files = files.withColumn("path", F.regexp_extract(plain, f"/(commit_id={commit_id}/.*)$", 1))
        entry = files.groupBy(*KEY).agg(F.sum("rows").alias("added_rows"), F.count("*").alias("files"), F.array_sort(F.collect_list(F.struct("path", "rows", "min_us", "max_us"))).alias("parts"))
        constants = {"commit_id": commit_id, "committed_ms": now_ms, "table": table, "kind": kind, "run_id": run_id, "feature_version": feature_version, "source_commit_id": source_commit_id, "writer": writer, "writer_version": writer_version}
        types = dict(part.split() for part in LOG.split(", "))
        entry.select(*((F.lit(constants[c]) if c in constants else F.col(c)).cast(t).alias(c) for c, t in types.items())).coalesce(1).write.mode("append").parquet(f"{self.folder}/_log")
        if sum(n.startswith("part-") for n in self._listed("_log")) > FOLD_FILES:
            self.fold_log()
        return True

    def resolve(self, table: str, version: int | str = "latest", as_of_ms: int | None = None) -> tuple[int, int]:
        """SRC4/SRC22/SRT7: time and id of the commit that a version means: latest, a commit id, or the last one at a time."""
        log = self.snapshots(table)
        if as_of_ms is not None:
            log = log.where(F.col("committed_ms") <= as_of_ms)
        elif version != "latest":
            if not isinstance(version, int):
                raise ValueError(f"a version is 'latest' or a commit id, not {version!r}")
            log = log.where(F.col("commit_id") == version)
        found = log.agg(F.max(F.struct("committed_ms", "commit_id"))).first()[0]
        if found is None:
            raise LookupError(f"{table} has no such snapshot")
        return found["committed_ms"], found["commit_id"]

    def live(self, table: str, version: int | str = "latest", as_of_ms: int | None = None) -> DataFrame:
        """The log entries of a version: for each series its commits since the last replace, with their place in time."""
        at_ms, at_id = self.resolve(table, version, as_of_ms)
        place = F.struct("committed_ms", "commit_id")
        log = self.log().where((F.col("table") == table) & (place <= F.struct(F.lit(at_ms).cast("long").alias("committed_ms"), F.lit(at_id).cast("long").alias("commit_id")))).withColumn("place", place)
        since = log.where("kind = 'replace'").groupBy(*KEY).agg(F.max("place").alias("since"))
        return log.join(_series(since), _same_series(), "left").where(F.col("since").isNull() | (F.col("place") >= F.col("since"))).select(*KEY, "commit_id", "place", "run_id", "parts")

    def read(self, table: str, version: int | str = "latest", as_of_ms: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """SRC1-SRC3, SRC6: rows of the live commits of a version, or some of their columns.

        Filters on series, month and time given to the result reach the scan as partition and Parquet filters.
        """
        df = self._placed(table, version, as_of_ms).drop("place")
        return df.select(*columns) if columns else df

    def files(self, table: str, version: int | str = "latest", as_of_ms: int | None = None, symbols: list[str] | None = None, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
        """SRC1/SRC21: the files of a version that can hold rows of some symbols in an inclusive range, with their rows and bounds, from the log alone."""
        df = self.live(table, version, as_of_ms)
        df = df if symbols is None else df.where(F.col("symbol").isin(symbols))
        df = df.select(*KEY, "commit_id", "run_id", "place", F.inline("parts"))
        df = df if start_ms is None else df.where(F.col("max_us") >= start_ms * 1000)
        return df if end_ms is None else df.where(F.col("min_us") <= end_ms * 1000)

    def manifest(self, table: str, version: int | str = "latest", as_of_ms: int | None = None) -> DataFrame:
        """SRC21: what a version is made of: for each series its last commit and run, rows and files, bounds, and its parts in order of time. Reads the log alone."""
        part = F.struct("min_us", "max_us", "rows", "path")
        last = lambda c: F.max_by(c, "place").alias(c)
        df = self.files(table, version, as_of_ms).groupBy(*KEY).agg(last("commit_id"), last("run_id"), F.sum("rows").alias("rows"), F.count_distinct("path").alias("files"), F.min("min_us").alias("min_us"), F.max("max_us").alias("max_us"), F.array_sort(F.collect_list(part)).alias("parts"))
        return df.select(*KEY, "commit_id", "run_id", "rows", "files", _time(F.col("min_us")).alias("oldest"), _time(F.col("max_us")).alias("newest"), "parts")

    def _placed(self, table: str, version: int | str = "latest", as_of_ms: int | None = None, **some) -> DataFrame:
        found = self.files(table, version, as_of_ms, **some)
        paths = sorted(r["path"] for r in found.select("path").distinct().collect())  # those that the scan plans itself
        empty = not paths
        paths = paths or [self.files(table, version, as_of_ms).first()["path"]]  # its footer has the columns
        base = f"{self.folder}/{table}"
        rows = self.spark.read.option("basePath", base).parquet(*(f"{base}/{p}" for p in paths))
        rows = rows.where("false") if empty else rows
        rows = rows if "timeframe" in rows.columns else rows.withColumn("timeframe", F.lit(None).cast("string"))
        entries = _series(self.live(table, version, as_of_ms).select(*KEY, "commit_id", "place")).withColumnRenamed("commit_id", "_commit_id")
        return rows.join(entries, _same_series() & (F.col("commit_id") == F.col("_commit_id"))).select(*rows.columns, "place")

    def newest_rows(self, table: str, symbols: list[str] | None = None, start_ms: int | None = None, end_ms: int | None = None, columns: list[str] | None = None, **version) -> DataFrame:
        """SRC1, SRC5-SRC8, SNK6, SNK7, DED3: rows of some symbols in an inclusive range, or some of their columns; of rows with
        one key (see ROW_KEYS) the one of the latest commit wins, so a commit of a known key is an upsert. No row is an error."""
        df = self._placed(table, symbols=symbols, start_ms=start_ms, end_ms=end_ms, **version)
        if symbols is not None:
            df = df.where(F.col("symbol").isin(symbols))
        for bound, after in ((start_ms, True), (end_ms, False)):
            if bound is not None:
                t, edge = F.col("timestamp"), F.timestamp_millis(F.lit(bound))
                month = F.date_format(edge, "yyyy-MM")
                df = df.where((t >= edge) & (F.col("ts_month") >= month) if after else (t <= edge) & (F.col("ts_month") <= month))
        key = [*KEY, *ROW_KEYS.get(table, ["timestamp"])]
        rest = [c for c in df.columns if c not in (*key, "commit_id", "ts_month", "place") and (columns is None or c in columns)]
        best = df.groupBy(*key).agg(F.max_by(F.struct(F.lit(0).alias("_"), *rest), "place").alias("r"))
        return best.select(*key, *(F.col(f"r.{c}").alias(c) for c in rest))

    def candles(self, table: str, *given, **more) -> DataFrame:
        """The newest rows of a table of candles."""
        return self.newest_rows(table, *given, **more)

    def found(self, table: str, *given, **more) -> DataFrame:
        """SRC3: the newest rows, or LookupError where there is none."""
        df = self.newest_rows(table, *given, **more)
        if df.isEmpty():
            raise LookupError(f"{table} has no row of that selection")
        return df

    def datasets(self, table: str) -> DataFrame:
        """SRC19."""
        return self.log().where(F.col("table") == table).select(*KEY).distinct()

    def versions(self, table: str) -> DataFrame:
        """SRC20/SRC21: commits of each series with their rows, run and origin."""
        return self.snapshots(table).select(*KEY, "commit_id", "committed_ms", "kind", "run_id", "feature_version", "source_commit_id", "added_rows", "files")

    def bounds(self, table: str) -> DataFrame:
        """SRC23: oldest and newest time of each series, from the log alone."""
        return self.manifest(table).select(*KEY, "oldest", "newest")

    def fresh(self, table: str, now_ms: int, max_age_ms: int = 3_600_000) -> bool:
        """SNK18."""
        newest = self.log().where(F.col("table") == table).agg(F.max("committed_ms")).first()[0]
        return newest is not None and now_ms - newest <= max_age_ms

    def expirable(self, table: str, now_ms: int, days: int, keep_days: int = 2) -> DataFrame:
        """SNK17: versions with the verdict on each: those older than the limit expire, but the newest never does."""
        limit = now_ms - max(days, keep_days) * 86_400_000
        commits = self.snapshots(table).groupBy("commit_id").agg(F.max("committed_ms").alias("committed_ms"))
        newest = commits.agg(F.max(F.struct("committed_ms", "commit_id"))["commit_id"].alias("newest"))
        old = (F.col("committed_ms") < limit) & (F.col("commit_id") != F.col("newest"))
        return commits.crossJoin(newest).select("commit_id", "committed_ms", old.alias("expired"))  # newest is one row

    def retention(self, table: str, now_ms: int, days: int, keep_days: int = 2, dry_run: bool = True) -> DataFrame:
        """SNK17: scanned and eligible versions. Without dry_run the eligible ones expire: they can no longer be read as
        versions, while their rows stay in the versions after them. The log is only added to."""
        told = self.expirable(table, now_ms, days, keep_days)
        counted = self.spark.createDataFrame([told.agg(F.count("*").alias("scanned"), F.count_if("expired").alias("eligible")).first()])
        if not dry_run:
            marks = {"committed_ms": F.lit(now_ms), "table": F.lit(table), "kind": F.lit("expire"), "commit_id": F.col("commit_id")}
            types = dict(part.split() for part in LOG.split(", "))
            told.where("expired").select(*(marks.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items())).write.mode("append").parquet(f"{self.folder}/_log")
        return counted

    def compact(self, table: str, commit_id: int, now_ms: int, run_id: str = "compaction") -> bool:
        """SNK17: one commit that replaces every series by its newest rows, so that what upserts superseded is no longer reached by later versions."""
        return self.commit(self.newest_rows(table), table, commit_id, now_ms, "replace", run_id)

    def unreached(self, table: str) -> DataFrame:
        """SNK17: commit_id and path of logged files that no readable version reaches.

        A commit of a series is in the versions from itself up to the next replace of that series. It is unreached if
        none of those can be read any more, that is if the last readable version before that replace is older than it.
        """
        place = F.struct("committed_ms", "commit_id").alias("place")
        log = self.log().where(F.col("table") == table).select(*KEY, "commit_id", "kind", "parts", place)
        later = Window.partitionBy(*KEY).orderBy("place").rowsBetween(1, Window.unboundedFollowing)
        log = log.withColumn("until", F.min(F.when(F.col("kind") == "replace", F.col("place"))).over(later))
        readable = self.snapshots(table).select(place).distinct()
        # for each replace, the last readable version before it: one row a replace and version, in order
        marks = readable.select("place", F.col("place").alias("version")).unionByName(log.where("until IS NOT NULL").select(F.col("until").alias("place"), F.lit(None).cast(readable.schema["place"].dataType).alias("version")).distinct())
        before = Window.orderBy("place", F.col("version").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)  # a replace comes before the version that it is
        last = marks.withColumn("last", F.max("version").over(before)).where("version IS NULL").select(F.col("place").alias("until"), "last")
        told = log.where("until IS NOT NULL").join(F.broadcast(last), "until", "left").where(F.col("last").isNull() | (F.col("last") < F.col("place")))
        dead = told.select("commit_id", F.inline("parts")).select("commit_id", "path").distinct()
        kept = log.join(told.select(*KEY, "commit_id").transform(_series).withColumnRenamed("commit_id", "_commit_id"), _same_series() & (F.col("commit_id") == F.col("_commit_id")), "left_anti")
        return dead.join(kept.select(F.inline("parts")).select("path").distinct(), "path", "left_anti").select("commit_id", "path")

    def sweep(self, table: str, now_ms: int | None = None, grace_ms: int = 86_400_000, dry_run: bool = False) -> tuple[int, int]:
        """SNK17: delete the files that no readable version reaches, and folders of commits that were never logged and are older than the
        grace time; returns how many of each there are. What is to go follows from the log alone, and deleting what is gone does
        nothing, so a sweep that stopped half-way is just run again."""
        now_ms = wall_clock_ms() if now_ms is None else now_ms
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        base = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        fs = base.getFileSystem(conf)
        drop = lambda path: fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
        known = {r["commit_id"] for r in self.log().where(F.col("table") == table).select("commit_id").distinct().collect()}  # a number for each commit
        folders = [(f.getPath().toString(), f.getModificationTime()) for f in fs.listStatus(base)] if fs.exists(base) else []
        orphans = [p for p, at in folders if "commit_id=" in p and int(p.rsplit("commit_id=", 1)[1]) not in known and at < now_ms - grace_ms]
        gone = 0
        with ThreadPoolExecutor(16) as pool:
            for r in self.unreached(table).toLocalIterator():
                path = f"{self.folder}/{table}/{r['path']}"
                if fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
                    gone += 1
                    if not dry_run:
                        pool.submit(drop, path)
            for path in orphans if not dry_run else ():
                pool.submit(drop, path)
        return gone, len(orphans)

    def upsert(self, df: DataFrame, table: str, commit_id: int, now_ms: int) -> None:
        """SNK7: a true upsert: the new rows win over live ones of the same key."""
        self.commit(df, table, commit_id, now_ms)


def gold_rows(features: DataFrame, run_id: str, version: str, source_commit_id: int) -> DataFrame:
    """SNK5/JN11: Gold columns in their order, missing ones null, with what they came from."""
    have = set(features.columns)
    columns = [F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in GOLD_COLUMNS]
    return features.select(*KEY, *columns, F.lit(run_id).alias("run_id"), F.lit(version).alias("feature_version"), F.lit(source_commit_id).cast("long").alias("source_commit_id"))
