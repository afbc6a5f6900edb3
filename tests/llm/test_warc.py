import gzip
import hashlib
import io

from pyspark.sql import functions as F
from vitrine.llm import warc


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def _rows():
    long = "<html>" + "é" * 80 + "</html>"
    rows = [(i, f"http://h/{i}\r\n?q=%20é", f"<p>page {i}</p>" * (i % 9)) for i in range(40)]
    rows += [(100 + i, "http://copies", long) for i in range(30)] + [(50, None, long), (None, "u", long), (None, "u", "short")]
    return rows + [(60, "u", None), (61, "u", ""), (62, "u", "x" * 100), (63, "u", "x" * 100), (64, "u", "x" * 99), (65, "u", "x" * 99),
                   (70, "big", "0123456789" * 30_000), (66, "same", "y" * 200), (66, "same", "y" * 200)]


def test_round_trip_equals_brute_force(spark):
    rows = _rows()
    want = []
    by_payload = {}
    for i, _, h in rows:
        by_payload.setdefault(h or "", []).append(i)
    for h, ids in by_payload.items():
        first = min((i for i in ids if i is not None), default=None)
        for i in ids:
            again = len(h.encode()) >= 100 and first is not None and i != first
            want.append((i, len(h.encode()), hashlib.sha256(h.encode()).hexdigest(), "revisit" if again else "response", first if again else None))
    got = warc.archive_pages(_pages(spark, rows).repartition(5).withColumn("payload", F.lit(1)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def _write(spark, folder, **options):
    warc.register(spark)
    writer = warc.page_records(_pages(spark, _rows()).repartition(3)).write.format("warc").mode("append")
    writer.options(**options).save(folder)
    return lambda **o: spark.read.format("warc").options(**o).load(folder)


def test_records_urls_and_payloads_come_back(spark, tmp_path):
    read = _write(spark, str(tmp_path / "w"))
    got = read().where("record_type = 'response'").collect()
    assert {r.target_uri for r in got} >= {u for _, u, _ in _rows()[:40]}
    for r in got:
        assert len(r.payload) == r.payload_bytes and "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert read(payload="false").where("payload IS NOT NULL").count() == 0
    splits = _write(spark, str(tmp_path / "s"), split_bytes="400")(payload="false")
    assert splits.count() == len(_rows()) and splits.rdd.getNumPartitions() > 6


def test_filters_are_pushed_and_payloads_skipped(spark, tmp_path, monkeypatch):
    read = _write(spark, str(tmp_path / "w"))
    plan = read().where("record_type IN ('revisit') AND payload_bytes > 3")._jdf.queryExecution().executedPlan().toString()
    assert "payload_bytes" in plan and "record_type#" not in plan.split("Filter", 1)[1].split("\n")[0]
    reader = warc.WarcReader({"path": str(tmp_path / "w")})
    rest = list(reader.pushFilters([warc.EqualTo(("target_uri",), "big"), warc.EqualTo(("payload",), b"x")]))
    assert len(rest) == 1
    read_bytes = []

    class Counting(io.BytesIO):
        def read(self, n=-1):
            read_bytes.append(n)
            return super().read(n)

    for p in reader.partitions():
        with open(p.path, "rb") as f:
            data = f.read()
        read_bytes.clear()
        found = list(warc.read_records(Counting(data), p.start, p.end, lambda row: False, True))
        assert not found and all(n == warc.HEAD_BYTES for n in read_bytes)


def test_members_are_plain_gzip_and_foreign_files_are_read(spark, tmp_path):
    plain = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://a/\r\nContent-Length: 7\r\n\r\npayload\r\n\r\n")
    info = plain.replace(b"response", b"warcinfo")
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(plain) + gzip.compress(info) + gzip.compress(plain * 1))
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).where("record_type = 'response'").collect()
    assert [bytes(r.payload) for r in rows] == [b"payload"] * 2 and rows[0].target_uri == "http://a/"
    own = {c: None for c in warc.HEADERS} | {"record_type": "response", "payload": b"abc", "payload_bytes": 3}
    text = gzip.decompress(warc.encode_record(own) * 2)
    assert text.count(b"WARC/1.1") == 2 and b"\r\n\r\nabc\r\n\r\n" in text


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    folder = tmp_path / "w"
    read = _write(spark, str(folder))
    n = read(payload="false").count()
    (folder / "part-lost.warc.gz").write_bytes(warc.encode_record({c: None for c in warc.HEADERS} | {"record_type": "response", "payload": b"", "payload_bytes": 0}))
    assert read(payload="false").count() == n


def test_empty_table(spark):
    assert warc.archive_pages(_pages(spark, [])).count() == 0
