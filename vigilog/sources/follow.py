"""Growing log files followed line by line, each line with its number."""

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from vigilog.sources.text import MAX_BROADCAST_SPLITS
from vigilog.storage import materialize, remove, scratch

SCHEMA = "file string, part bigint, place bigint, value string"
_ARROW = pa.schema([("file", pa.string()), ("part", pa.int64()), ("place", pa.int64()), ("value", pa.string())])
_TOTALS = "file string, lines bigint"
PART_BYTES = 32 << 20
BLOCK = 1 << 20
HEAD = 256
BOM = b"\xef\xbb\xbf"


@dataclass
class Part(InputPartition):
    """Lines that begin in [start, stop) of a file whose unread, complete lines are [first, limit)."""

    path: str
    start: int
    stop: int
    first: int
    limit: int


def _head(file: pa.NativeFile) -> int:
    """Checksum of the first line, at most ``HEAD`` bytes of it; known once the line is complete."""
    file.seek(0)
    return zlib.crc32(file.read(HEAD).partition(b"\n")[0])


def _complete(file: pa.NativeFile) -> int:
    """Bytes up to the end of the last complete line; reads back over the unfinished one only."""
    at = file.size()
    while at > 0:
        low = max(0, at - BLOCK)
        file.seek(low)
        found = file.read(at - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    return 0


def _lines(whole: bytes) -> list[bytes]:
    """Lines of bytes that end in a line feed, cut where Spark's text source cuts them."""
    whole = whole[: -2 if whole.endswith(b"\r\n") else -1]
    return re.split(rb"\r\n|\r|\n", whole) if b"\r" in whole else whole.split(b"\n")


class _Reader(DataSourceStreamReader):
    """Offsets are, for each file, the checksum of its first line and the bytes of its complete lines."""

    def __init__(self, options: dict):
        path = options["path"]
        if path.startswith("file:"):
            path = "file:///" + path[5:].lstrip("/")
        self.fs, self.root = fs.FileSystem.from_uri(path)
        self.pattern = options.get("pattern", "*.log")
        self.part_bytes = int(options.get("partbytes", PART_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = {}
        for info in self.fs.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            if info.is_file and fnmatch(info.base_name, self.pattern):
                with self.fs.open_input_file(info.path) as file:
                    if end := _complete(file):
                        found[info.path] = [_head(file), end]
        return found

    def partitions(self, start: dict, end: dict) -> list[Part]:
        parts = []
        for path, (head, limit) in sorted(end.items()):
            known, first = start.get(path, (head, 0))
            if known != head or first > limit:
                first = 0  # another file of that name
            parts += [
                Part(path, at, min(at + self.part_bytes, limit), first, limit) for at in range(first, limit, self.part_bytes)
            ]
        return parts

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        # The line that reaches into this part belongs to the part before.
        inside = part.start > part.first
        at, place, held = part.start - inside, 0, []
        with self.fs.open_input_file(part.path) as file:
            file.seek(at)
            while at < part.stop:
                block = file.read(min(BLOCK, part.limit - file.tell()))
                if not block:
                    raise EOFError(f"{part.path} became shorter while it was read")
                cut = block.rfind(b"\n") + 1
                if not cut:
                    held.append(block)
                    continue
                whole, held = b"".join([*held, block[:cut]]), [block[cut:]]
                here, at = at, at + len(whole)
                if at > part.stop:
                    last = whole.find(b"\n", part.stop - 1 - here) + 1
                    whole = whole[:last]
                if inside:
                    whole, inside = whole[whole.find(b"\n") + 1 :], False
                if here == 0 and whole.startswith(BOM):
                    whole = whole[len(BOM) :]
                if not whole:
                    continue
                values = [x.decode("utf-8", "replace") for x in _lines(whole)]
                n = len(values)
                columns = [[part.path] * n, [part.start] * n, range(place + 1, place + n + 1), values]
                place += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)


class GrowingLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


def follow_log(spark: SparkSession, path: str, pattern: str = "*.log", part_bytes: int = PART_BYTES) -> DataFrame:
    """Stream over the lines of all files below ``path`` whose names match, as they are appended.

    ``file, part, place, value``: a line is the ``place``-th of those that begin in the
    ``part_bytes`` from byte ``part`` on. Only complete lines are read; the driver looks at a file's first
    line and behind its last line feed, the tasks read the lines. A file that became shorter,
    or has another first line, is a new one and read from its start; lines appended to
    the old one after the last batch are lost then, as with any log that is replaced. A
    file that is gone before its planned lines were read ends the query.
    """
    spark.dataSource.register(GrowingLog)
    return spark.readStream.format("growing_log").option("pattern", pattern).option("partbytes", part_bytes).load(path)


def run_numbered(
    lines: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Hands every batch of ``follow_log`` to ``process`` as ``file, line_no, value``, numbered from 1 in each file.

    Lines are counted by part, as in ``read_log``, and start where the batch before ended;
    those totals, one row for each file, are written beside the checkpoint. A batch
    that is run again finds the same totals and gives the same numbers. No line is shuffled. A
    file that is read from its start again is numbered from 1 again.
    """
    spark = lines.sparkSession
    folder = f"{checkpoint.rstrip('/')}-lines"

    def at(batch_id: int) -> str:
        return f"{folder}/batch={batch_id}"

    def number(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch(session):
            known = session.read.schema(_TOTALS).parquet(at(batch_id - 1)) if batch_id else session.createDataFrame([], _TOTALS)
            file = Window.partitionBy("file")
            earlier = file.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
            # One row for each part of the batch.
            counted = batch.groupBy("file", "part").agg(F.max("place").alias("n")).join(known, "file", "left")
            base = F.when(F.min("part").over(file) == 0, 0).otherwise(F.coalesce("lines", F.lit(0)))
            before = base + F.coalesce(F.sum("n").over(earlier), F.lit(0))
            parts = materialize(counted.select("file", "part", "n", before.alias("before")), "parts")
            ends = parts.groupBy("file").agg(F.max(F.col("before") + F.col("n")).alias("now"))
            total = known.join(ends, "file", "full").select("file", F.coalesce("now", "lines").alias("lines"))
            total.write.mode("overwrite").parquet(at(batch_id))
            places = parts.select("file", "part", "before")
            if places.count() <= MAX_BROADCAST_SPLITS:
                places = F.broadcast(places)
            numbered = batch.join(places, ["file", "part"])
            process(numbered.select("file", (F.col("before") + F.col("place")).alias("line_no"), "value"), batch_id)
        if batch_id > 1:
            remove(spark, at(batch_id - 2))

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(number)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
