"""WARC archives as a PySpark Python data source (reader and writer), and deduplication into revisit records.

Layout: every record is one gzip member; the writer puts the sizes of the member
into its header (an extra field ``sl``: compressed and plain length), so a reader
can step over a record without inflating it.  The writer notes a split point
about every ``split_bytes``; they travel with its commit message to the manifest of
that commit, which lists exactly the files of its committed tasks and is renamed into
place.  A folder holds what all its manifests list, so appends add up, and besides
that the archives others put there (any name but ``part-*``; ``part-*`` ones only if
they were there before the first commit).  Files of lost or repeated task attempts
are in no manifest and are never read once there is one.  Overwriting removes all that
was readable, after the new manifest is in place.

Reading: one partition per split (a file without a manifest is one partition).
For each record only the first bytes are inflated, which hold the WARC headers.
Filters on ``record_type``, ``target_uri``, ``record_id`` and ``payload_digest``
are pushed down and tested on those headers; records that fail are skipped without
their payload being inflated, and with option ``payload`` = ``false`` so are all
others.

Paths are opened through Arrow's file systems: local, or a store that Arrow knows (hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, WriterCommitMessage)

from vitrine.session import scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, payload_digest string, refers_to string, "
          "payload_bytes long, payload binary")
SPLIT_BYTES = 64 << 20
HEAD_BYTES = 4096
MANIFEST = "_manifest"
OWN_FILE = re.compile(r"part-[0-9a-f]{32}\.warc\.gz")
#: Column of the table -> header of the record; fixed names of the WARC format but for the last, an extension.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "payload_bytes": "X-Payload-Bytes"}
DATE = "2024-01-31T00:00:00Z"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _listing(store: fs.FileSystem, root: str) -> tuple[list[str], dict[str, list[int]]]:
    """(names of the manifests, {file: its cuts} of all that a read of the folder sees)."""
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    manifests = sorted(x.base_name for x in found if x.base_name == MANIFEST or x.base_name.startswith(MANIFEST + "-"))
    files = {}
    for name in manifests:
        with store.open_input_stream(f"{root}/{name}") as f:
            files.update(json.loads(f.read()))
    for x in found:
        if x.base_name.endswith(".warc.gz") and not (manifests and x.base_name.startswith("part-")):
            files.setdefault(x.base_name, [0, x.size])
    return manifests, files


# ---- records -------------------------------------------------------------------------------------------------------

def _clean(value: str) -> str:
    """Header values are one line; other characters are percent-encoded bytes."""
    return "".join(c if c >= " " and c not in "%\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _unclean(value: str) -> str:
    head, *rest = value.encode().split(b"%")
    return (head + b"".join(bytes([int(x[:2], 16)]) + x[2:] for x in rest)).decode()


def encode_record(row: dict) -> bytes:
    """One gzip member with the record; a revisit has no payload block."""
    payload = (row["payload"] or b"") if row["record_type"] != "revisit" else b""
    lines = ["WARC/1.1", f"WARC-Date: {DATE}"]
    lines += [f"{h}: {_clean(str(row[c]))}" for c, h in HEADERS.items() if row[c] is not None]
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(payload)}")
    plain = ("\r\n".join(lines) + "\r\n\r\n").encode() + payload + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(plain) + packer.flush()
    size = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF))


def _member(buffer: bytes) -> tuple[int, int | None]:
    """(start of the deflated data, size of the member if its header tells)."""
    if buffer[:3] != b"\x1f\x8b\x08":
        raise ValueError("not a gzip member")
    flags, at, size = buffer[3], 10, None
    if flags & 4:
        n = struct.unpack_from("<H", buffer, at)[0]
        if buffer[at + 2:at + 4] == b"sl" and n == 12:
            size = struct.unpack_from("<I", buffer, at + 6)[0]
        at += 2 + n
    for bit in (8, 16):                       # file name, comment
        if flags & bit:
            at = buffer.index(b"\0", at) + 1
    return at + 2 * bool(flags & 2), size


def _parse_head(plain: bytes) -> tuple[dict[str, str], int] | None:
    """(headers, start of the block), or None while the blank line has not been seen."""
    end = plain.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = plain[:end].decode().split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, end + 4


def _row(head: dict[str, str]) -> dict:
    row = {c: head.get(h.lower()) for c, h in HEADERS.items()}
    row = {c: v if v is None else _unclean(v) for c, v in row.items()}
    row["payload_bytes"] = int(row["payload_bytes"] or head.get("content-length", 0))
    return row


def read_records(file, start: int, end: int, wanted, payload: bool) -> Iterator[dict]:
    """Records that start in [start, end).  `wanted`: a test of the row made from the headers."""
    at = start
    while at < end:
        file.seek(at)
        buffer = file.read(HEAD_BYTES)
        if not buffer:
            return
        body, size = _member(buffer)
        unpack, plain, fed = zlib.decompressobj(-15), b"", 0
        plain += unpack.decompress(buffer[body:])
        fed = len(buffer)
        while (head := _parse_head(plain)) is None and not unpack.eof:
            more = file.read(HEAD_BYTES)
            fed += len(more)
            if not more:
                raise EOFError("record ends within its headers")
            plain += unpack.decompress(more)
        if head is None:
            raise ValueError("record without headers")
        row, block = _row(head[0]), head[1]
        take = wanted(row)
        if size is None or (take and payload):
            parts = [plain[block:]]           # the rest of the member, also where only its end is looked for
            while not unpack.eof:
                more = file.read(1 << 16)
                fed += len(more)
                if not more:
                    raise EOFError("record ends within its payload")
                parts.append(unpack.decompress(more))
            size = fed - len(unpack.unused_data) + 8
            if take:
                row["payload"] = b"".join(parts)[:int(head[0]["content-length"])] if payload else None
        else:
            row["payload"] = None
        if take:
            yield row
        at += size


# ---- the data source -----------------------------------------------------------------------------------------------

@dataclass
class WarcSplit(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class WarcCommit(WriterCommitMessage):
    file: str
    splits: list[int]          # offsets; the last is the size of the file


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload, self.tests = options["path"].rstrip("/"), options.get("payload", "true") == "true", []

    def pushFilters(self, filters: list[Filter]):
        """Takes = and IN on header columns (and their IS NOT NULL); the others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append((column, [f.value]))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((column, list(f.value)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, None))
            else:
                yield f

    def partitions(self) -> list[WarcSplit]:
        store, root = _open(self.path)
        _, files = _listing(store, root)
        return [WarcSplit(f"{self.path}/{name}", a, b) for name, cuts in files.items() for a, b in zip(cuts[:-1], cuts[1:])]

    def read(self, partition: WarcSplit | None) -> Iterator[tuple]:
        if partition is None:                 # Spark's way to read a source without partitions
            return
        store, path = _open(partition.path)

        def wanted(row: dict) -> bool:
            return all(row[c] is not None and (values is None or row[c] in values) for c, values in self.tests)

        with store.open_input_file(path) as file:
            for row in read_records(file, partition.start, partition.end, wanted, self.payload):
                yield tuple(row[c] for c in (*HEADERS, "payload"))


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.split = options["path"].rstrip("/"), int(options.get("split_bytes", SPLIT_BYTES))
        self.overwrite = overwrite
        self.manifests, self.before = _listing(*_open(self.path))     # on the driver, before any task writes

    def write(self, iterator) -> WarcCommit:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        name, at, cuts = f"part-{uuid.uuid4().hex}.warc.gz", 0, [0]
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for row in iterator:
                record = encode_record(row.asDict())
                if at - cuts[-1] >= self.split:
                    cuts.append(at)
                out.write(record)
                at += len(record)
        return WarcCommit(name, [*cuts, at] if at else [])

    def commit(self, messages: list[WarcCommit | None]) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files = [(m.file, m.splits) for m in messages if m and m.splits]
        if not self.manifests and not self.overwrite:      # others' part-* files, which the first manifest would hide
            files += [(n, cuts) for n, cuts in self.before.items() if n.startswith("part-") and not OWN_FILE.fullmatch(n)]
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{root}/_uncommitted-{name}", compression=None) as out:
            out.write(json.dumps(files).encode())
        store.move(f"{root}/_uncommitted-{name}", f"{root}/{MANIFEST}-{name}")
        if self.overwrite:
            for old in [*self.manifests, *self.before]:
                store.delete_file(f"{root}/{old}")

    def abort(self, messages: list[WarcCommit | None]) -> None:
        store, root = _open(self.path)
        for m in messages:
            if m:
                store.delete_file(f"{root}/{m.file}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ---- pages -> archives -> pages ------------------------------------------------------------------------------------

REVISIT_BYTES = 100


def page_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The WARC records of pages: of equal payloads of `revisit_bytes` or more the smallest page_id is the response.

    Digests are grouped with partial sums, and only (digest, smallest id) of payloads
    that occur twice come back to the pages: the pages' side of that join may be split
    where one payload is hot.  A NULL page_id counts as the largest and is never
    referred to; rows that repeat the smallest page_id are responses, all of them.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), payload.alias("payload")) \
        .withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    first = rows.where(F.col("payload_bytes") >= revisit_bytes).groupBy("digest") \
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    joined = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    name = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(":"), F.substring("digest", 1, 16), F.lit(">"))
    return joined.select(
        name(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"), "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


@F.arrow_udf(T.StringType())
def _sha256(payload: pa.Array) -> pa.Array:
    return pa.array([None if x is None else hashlib.sha256(x.as_buffer()).hexdigest() for x in payload], pa.string())


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads, and length and digest are those of the
    bytes read; revisits are read by their headers alone.  An empty table gives
    empty archives and an empty result.
    """
    spark = pages.sparkSession
    register(spark)
    folder = folder or scratch_path(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(folder)
    read = lambda payload: spark.read.format("warc").option("payload", payload).load(folder)
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]*):", 1).try_cast("long")
    full = read("true").where("record_type = 'response'").select(
        number(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        _sha256("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    heads = read("false").where("record_type = 'revisit'").select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.regexp_extract("payload_digest", "^sha256:(.*)$", 1).alias("payload_digest"), "record_type",
        number(F.col("refers_to")).alias("refers_to"))
    return full.unionByName(heads)
