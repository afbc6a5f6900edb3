"""Streaming source over text files that are still being written.

``spark.readStream.format("line_tail").load(path)`` follows a file, or the files that a
pattern names, as a log tailer does.  The offset of a batch is a byte position for each
file, kept in the query's checkpoint, so a restart goes on where the last batch ended.

* Only whole lines are read: the position is behind the last line end, and a half line waits.
* A batch's bytes are cut into ranges of ``rangeBytes``, one task each; a line belongs to
  the range that it starts in.  What is planned is fixed by the two offsets, so a batch that is
  run again reads the same bytes.
* A file is known by its inode and its first line, not by its name.  One that was
  rotated (renamed to ``<name>.<anything>``) is read to its end, its last line then also without a line end,
  before or beside the new one.  A file that was cut off and written anew has another
  first line, or is shorter than its position, and starts at 0.

Rows are ``value`` (the line), ``file`` (its name) and ``position`` (of its first byte).
The folder must be mounted where the driver and the executors run.
"""

from __future__ import annotations

import glob
import os
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "value string, file string, position long"
RANGE_BYTES = 64 << 20
_BLOCK = 1 << 20
_HEAD = 1024


def local_path(path: str) -> str:
    """The path without ``file:``; other schemes are refused."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: files that grow are followed on mounted folders only")
    return path


def _last_line_end(path: str, size: int) -> int:
    """The position behind the last line end before `size`, or 0."""
    with open(path, "rb") as f:
        while size > 0:
            lo = max(0, size - _BLOCK)
            f.seek(lo)
            at = f.read(size - lo).rfind(b"\n")
            if at >= 0:
                return lo + at + 1
            size = lo
    return 0


def _head(path: str) -> int:
    """A checksum of the first line, of its first bytes where it is long."""
    with open(path, "rb") as f:
        return zlib.crc32(f.read(_HEAD).split(b"\n", 1)[0])


def _found(pattern: str) -> list[tuple[str, str, bool]]:
    """(file id, path, rotated) of the files that the pattern names now."""
    out = {}
    for rotated, names in ((True, glob.glob(pattern + ".*")), (False, glob.glob(pattern))):
        for path in names:
            try:
                stat = os.stat(path)
            except FileNotFoundError:
                continue                             # renamed meanwhile: found under its other name, or by the next batch
            if os.path.isfile(path):
                out[f"{stat.st_dev}:{stat.st_ino}"] = (path, rotated)
    return sorted((k, *v) for k, v in out.items())


class ByteRange(InputPartition):
    def __init__(self, pattern: str, file_id: str, first: int, begin: int, end: int, stop: int):
        self.pattern, self.file_id = pattern, file_id
        #: Where the batch's part of the file begins, the range [begin, end), and where the part ends.
        self.first, self.begin, self.end, self.stop = first, begin, end, stop


class LineTailReader(DataSourceStreamReader):
    def __init__(self, pattern: str, range_bytes: int):
        self.pattern, self.range_bytes = pattern, range_bytes
        self.seen: dict = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        files = dict(self.seen)                      # a file that is gone keeps its position
        for file_id, path, rotated in _found(self.pattern):
            try:
                size = os.stat(path).st_size
                end = size if rotated else _last_line_end(path, size)
                if end:
                    files[file_id] = {"position": end, "head": _head(path)}
            except FileNotFoundError:
                continue
        self.seen = files
        return {"files": files}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        out = []
        for file_id, now in end["files"].items():
            before = start["files"].get(file_id)
            known = before is not None and before["head"] == now["head"] and before["position"] <= now["position"]
            first = before["position"] if known else 0
            out += [ByteRange(self.pattern, file_id, first, at, min(at + self.range_bytes, now["position"]), now["position"])
                    for at in range(first, now["position"], self.range_bytes)]
        return out

    def read(self, partition: ByteRange) -> Iterator:
        import pyarrow as pa

        paths = {file_id: path for file_id, path, _ in _found(partition.pattern)}
        if partition.file_id not in paths:
            raise FileNotFoundError(f"a followed file (inode {partition.file_id}) of {partition.pattern} is gone before it was read")
        path = paths[partition.file_id]
        name = os.path.basename(path)
        with open(path, "rb") as f:
            at = partition.begin
            if at > partition.first:                 # the line that began in the range before is that one's
                f.seek(at - 1)
                at += len(f.readline(partition.stop - at + 1)) - 1
            f.seek(at)
            rest = b""
            while at < partition.end:
                data = f.read(min(_BLOCK, partition.stop - at - len(rest)))
                last = at + len(rest) + len(data) >= partition.stop or not data
                lines = (rest + data).split(b"\n")
                rest = lines.pop()
                if last and rest:                    # the last line of a file that was rotated
                    lines.append(rest)
                values, positions = [], []
                for line in lines:
                    if at >= partition.end:
                        break
                    values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    positions.append(at)
                    at += len(line) + 1
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([name] * len(values), pa.string()),
                                                  pa.array(positions, pa.int64())], ["value", "file", "position"])
                if last:
                    return


class LineTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineTailReader:
        return LineTailReader(local_path(self.options["path"]), int(self.options.get("rangeBytes", RANGE_BYTES)))


def tail_stream(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of a file that grows, or of the files that a pattern names."""
    spark.dataSource.register(LineTail)
    return spark.readStream.format("line_tail").option("rangeBytes", str(range_bytes)).load(path)
