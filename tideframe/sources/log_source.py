"""A landed log with offsets: numbered batches of JSON lines, published once and consumed from the earliest or the latest one.

It stands where a broker's topic would: publish() adds a batch, and any number of streams read the log, each from the offset
in its own checkpoint or, at first, from where its profile says (STR13). The source is a Python data source, so Spark plans its partitions
and keeps its offsets as it does for any other stream.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# STR13: where each consumer starts.
PROFILES = {"bronze": "earliest", "quality": "earliest", "features": "latest", "trading": "latest"}


def _opened(path: str):
    """The file system of a path and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _batches(path: str) -> list[int]:
    """The numbers of the complete batches, in order; a batch is complete when Spark has marked it."""
    from pyarrow import fs

    files, root = _opened(path)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    numbers = sorted(int(f.base_name.removeprefix("seq=")) for f in found if f.base_name.startswith("seq="))
    return [n for n in numbers if files.get_file_info(f"{root}/seq={n:012d}/_SUCCESS").type == fs.FileType.File]


def publish(messages: DataFrame, path: str, seq: int | None = None) -> int:
    """SNK9-SNK11, SNK15: messages (key, value) as the log's next batch, or as batch seq again, and its number. A batch that was not completed is not read, and publishing it again replaces it."""
    known = _batches(path)
    seq = (known[-1] + 1 if known else 0) if seq is None else seq
    messages.select(F.to_json(F.struct("key", "value")).alias("value")).write.mode("overwrite").text(f"{path}/seq={seq:012d}")
    return seq


class _Part(InputPartition):
    def __init__(self, file: str, seq: int):
        self.file, self.seq = file, seq


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.start = options["path"], options.get("startingoffsets", "earliest")

    def initialOffset(self) -> dict:
        """The number that the first batch to read has; of the latest profile, the one after all that is there."""
        known = _batches(self.path)
        return {"next": known[-1] + 1 if self.start == "latest" and known else 0}

    def latestOffset(self) -> dict:
        known = _batches(self.path)
        return {"next": known[-1] + 1 if known else 0}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        from pyarrow import fs

        files, root = _opened(self.path)
        parts = []
        for seq in _batches(self.path):
            if start["next"] <= seq < end["next"]:
                found = files.get_file_info(fs.FileSelector(f"{root}/seq={seq:012d}"))
                parts += [_Part(f.path, seq) for f in found if f.base_name.startswith("part-") and f.size]
        return parts

    def read(self, partition: _Part) -> Iterator:
        """Arrow batches of some thousand records, as rows one by one cost Spark more than their parsing."""
        import io
        from itertools import islice

        import pyarrow as pa

        files, _ = _opened(self.path)
        schema = pa.schema([("key", pa.string()), ("value", pa.string()), ("seq", pa.int64())])
        text = lambda x: x if x is None or isinstance(x, str) else str(x)
        with files.open_input_stream(partition.file) as stream:
            lines = io.TextIOWrapper(stream, "utf-8", newline="\n")
            while records := [json.loads(line) for line in islice(lines, 4096)]:
                yield pa.RecordBatch.from_pydict({"key": [text(r.get("key")) for r in records], "value": [text(r.get("value")) for r in records], "seq": [partition.seq] * len(records)}, schema)

    def commit(self, end: dict) -> None:
        pass


class LandedLog(DataSource):
    """Format `landed_log`: key, value and seq (the batch) of a log; options path and startingOffsets (earliest or latest)."""

    @classmethod
    def name(cls) -> str:
        return "landed_log"

    def schema(self) -> str:
        return "key string, value string, seq long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def consume(spark: SparkSession, path: str, profile: str) -> DataFrame:
    """STR13/SRC9-SRC14: a log as a stream for a kind of consumer; its checkpoint goes on from where it was."""
    spark.dataSource.register(LandedLog)
    return spark.readStream.format("landed_log").option("path", path).option("startingOffsets", PROFILES[profile]).load()
