"""Landing sink that rolls files by bytes and commits them by manifest (K1, K2).

A streaming data source writer.  A task writes lines under ``year=/month=/day=`` and starts a
new file where the next line would pass ``rollBytes``, so all files but the last of a task and day
are full.  Files have their final names from the start; a batch becomes visible with one small
object, its manifest, which lists them.  Nothing is renamed, so object stores serve as well as
file systems, and a batch that is run again replaces its manifest: files of an attempt that was
not committed are in none.

Small files of a day that has been idle are merged (``merge_idle``): their lines are
rewritten into full files and one manifest swaps old for new.  Readers go by the manifests
(``read_landed``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from vitrine import constants as C
from vitrine.functions.columns import date_parts
from vitrine.streaming.landing import trigger_kwargs

MANIFESTS = "_manifest"
#: A file that holds less than this share of rollBytes is small.
SMALL = 0.9


def _store(root: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("/") else "file:///" + root.removeprefix("file:").lstrip("/"))


class _Roll:
    """Files of one day, each closed before it would pass the limit."""

    def __init__(self, store, folder: str, limit: int):
        self.store, self.folder, self.limit, self.out, self.done = store, folder, limit, None, []

    def write(self, lines: list[bytes]) -> None:
        held, size = [], 0
        for line in lines:
            if self.out is not None and self.bytes + size + len(line) > self.limit:
                self._put(held)
                self.close()
                held, size = [], 0
            if self.out is None:
                self.store.create_dir(self.folder, recursive=True)
                self.name, self.bytes = f"{self.folder}/part-{uuid.uuid4().hex}.txt", 0
                self.out = self.store.open_output_stream(self.name)
            held.append(line)
            size += len(line)
        self._put(held)

    def _put(self, lines: list[bytes]) -> None:
        data = b"".join(lines)
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.bytes))
            self.out = None


class _Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


def _write_rolled(root: str, limit: int, batches: Iterator) -> list[tuple[str, int]]:
    """(value, year, month, day) -> (path under the root, bytes) of the files that hold the lines."""
    store, base = _store(root)
    rolls: dict[tuple, _Roll] = {}
    for batch in batches:
        by_day: dict[tuple, list[bytes]] = {}
        for value, *day in zip(*(batch.column(c).to_pylist() for c in ("value", "year", "month", "day"))):
            by_day.setdefault(tuple(day), []).append(value.encode() + b"\n")
        for day, lines in by_day.items():
            folder = f"{base}/year={day[0]}/month={day[1]}/day={day[2]}"
            rolls.setdefault(day, _Roll(store, folder, limit)).write(lines)
    for roll in rolls.values():
        roll.close()
    return [(path[len(base) + 1:], size) for roll in rolls.values() for path, size in roll.done]


def _write_manifest(root: str, name: str, added: list[tuple[str, int]], removed: list[str]) -> None:
    store, base = _store(root)
    store.create_dir(f"{base}/{MANIFESTS}", recursive=True)
    with store.open_output_stream(f"{base}/{MANIFESTS}/{name}.json") as out:
        out.write(json.dumps({"at": time.time(), "add": added, "remove": removed}).encode())


class RolledWriter(DataSourceStreamArrowWriter):
    def __init__(self, root: str, limit: int):
        self.root, self.limit = root, limit

    def write(self, iterator) -> _Written:
        return _Written(_write_rolled(self.root, self.limit, iterator))

    def commit(self, messages, batchId: int) -> None:
        _write_manifest(self.root, f"batch-{batchId:020d}", sorted(f for m in messages if m is not None for f in m.files), [])

    def abort(self, messages, batchId: int) -> None:
        store, base = _store(self.root)
        for message in messages:
            for path, _ in message.files if message is not None else []:
                store.delete_file(f"{base}/{path}")


class RolledLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rolled_lines"

    def streamWriter(self, schema, overwrite: bool) -> RolledWriter:
        return RolledWriter(self.options["path"], int(self.options["rollBytes"]))


def start_rolled(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, roll_bytes: int = C.LANDING_ROLL_BYTES,
                 once: bool = False, interval_seconds: int = C.LANDING_ROLL_SECONDS) -> StreamingQuery:
    """Raw lines to ``root/year=/month=/day=`` of the wall clock, in files of up to ``roll_bytes``."""
    spark.dataSource.register(RolledLines)
    return (lines.select("value", *date_parts(F.current_timestamp())).writeStream.format("rolled_lines")
            .option("path", root).option("rollBytes", str(roll_bytes)).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once, interval_seconds)).start())


def committed(root: str) -> dict[str, tuple[int, float]]:
    """{path: (bytes, time of the commit)} of the files that the manifests list."""
    from pyarrow import fs
    store, base = _store(root)
    found = store.get_file_info(fs.FileSelector(f"{base}/{MANIFESTS}", allow_not_found=True))
    listed = []
    for info in found:
        with store.open_input_stream(info.path) as f:
            listed.append(json.loads(f.read()))
    removed = {path for m in listed for path in m["remove"]}
    return {path: (size, m["at"]) for m in listed for path, size in m["add"] if path not in removed}


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """Committed lines, with ``year``, ``month`` and ``day`` of their folders."""
    paths = sorted(committed(root))
    if not paths:
        return spark.createDataFrame([], "value string, year string, month string, day string")
    return (spark.read.schema("value string, year string, month string, day string").option("basePath", root)
            .text([f"{root.rstrip('/')}/{p}" for p in paths]))


def merge_idle(spark: SparkSession, root: str, idle_seconds: float = C.LANDING_IDLE_SECONDS, roll_bytes: int = C.LANDING_ROLL_BYTES, now: float | None = None) -> int:
    """Merges the small files of days without a commit for ``idle_seconds``; returns how many files went.

    A day's small files are dealt, by the running sum of their sizes, to groups of about ``roll_bytes``, a task each."""
    now, files = time.time() if now is None else now, committed(root)
    last, small = {}, {}
    for path, (size, at) in files.items():
        day = path.rsplit("/", 1)[0]
        last[day] = max(last.get(day, 0.0), at)
        if size < SMALL * roll_bytes:
            small.setdefault(day, []).append((path, size))
    groups = []
    for day, own in sorted(small.items()):
        if now - last[day] < idle_seconds or len(own) < 2:
            continue
        held, total = [], 0
        for path, size in sorted(own):
            held.append(path)
            total += size
            if total >= 8 * roll_bytes:                       # (a group's last file alone is not full)
                groups.append((len(groups), day, held))
                held, total = [], 0
        if held:
            groups.append((len(groups), day, held))
    if not groups:
        return 0

    def rewrite(batches):
        import pyarrow as pa
        store, base = _store(root)
        for batch in batches:
            for day, paths in zip(batch.column("day").to_pylist(), batch.column("paths").to_pylist()):
                roll = _Roll(store, f"{base}/{day}", roll_bytes)
                for path in paths:
                    with store.open_input_stream(f"{base}/{path}") as f:
                        rest = b""
                        while data := f.read(1 << 20):
                            *lines, rest = (rest + data).split(b"\n")
                            roll.write([x + b"\n" for x in lines])
                roll.close()
                yield pa.RecordBatch.from_arrays([pa.array([p[len(base) + 1:] for p, _ in roll.done], pa.string()),
                                                  pa.array([n for _, n in roll.done], pa.int64())], ["path", "size"])

    plan = spark.createDataFrame(groups, "k int, day string, paths array<string>").repartitionById(len(groups), "k")
    added = [tuple(r) for r in plan.mapInArrow(rewrite, "path string, size long").collect()]
    removed = [path for *_, paths in groups for path in paths]
    _write_manifest(root, f"merge-{uuid.uuid4().hex}", added, removed)
    store, base = _store(root)
    for path in removed:
        store.delete_file(f"{base}/{path}")
    return len(removed)
