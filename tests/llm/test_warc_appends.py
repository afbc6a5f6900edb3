import gzip

from vitrine.llm import warc

FOREIGN = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://foreign/\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"


def _save(spark, folder, ids, mode="append"):
    warc.register(spark)
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in ids], "page_id long, url string, html string")
    warc.page_records(pages.repartition(2)).write.format("warc").mode(mode).save(str(folder))


def _urls(spark, folder):
    return sorted(r.target_uri for r in spark.read.format("warc").load(str(folder)).collect())


def test_appends_add_up(spark, tmp_path):
    _save(spark, tmp_path / "w", range(5))
    _save(spark, tmp_path / "w", range(5, 12))
    _save(spark, tmp_path / "w", [])
    assert _urls(spark, tmp_path / "w") == sorted(f"http://h/{i}" for i in range(12))


def test_archives_of_others_stay_readable_after_an_append(spark, tmp_path):
    (tmp_path / "crawl.warc.gz").write_bytes(gzip.compress(FOREIGN))
    (tmp_path / "part-00000.warc.gz").write_bytes(gzip.compress(FOREIGN))
    _save(spark, tmp_path, [1])
    _save(spark, tmp_path, [2])
    assert _urls(spark, tmp_path) == ["http://foreign/"] * 2 + ["http://h/1", "http://h/2"]


def test_a_folder_with_a_manifest_of_the_first_layout(spark, tmp_path):
    _save(spark, tmp_path, [1])
    next(tmp_path.glob("_manifest-*")).rename(tmp_path / "_manifest")
    _save(spark, tmp_path, [2])
    assert _urls(spark, tmp_path) == ["http://h/1", "http://h/2"]


def test_overwrite_replaces_all(spark, tmp_path):
    (tmp_path / "crawl.warc.gz").write_bytes(gzip.compress(FOREIGN))
    _save(spark, tmp_path, [1])
    _save(spark, tmp_path, [2], "overwrite")
    assert _urls(spark, tmp_path) == ["http://h/2"]
