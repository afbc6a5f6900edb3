"""Clashing column names, repeated rows, very long texts: the same results as without them."""

import pytest
from pyspark.sql import functions as F
from vitrine.llm import alignment, negatives, packing, secrets, sharding, substrings, tiers, urls, warc

#: Names that the operators use inside; strings, so that taking one for an own column fails.
CLASH = ["_t", "row", "rows", "size", "tokens", "shard", "slot", "lot", "bin", "group", "digest", "text_crc32", "law", "spans", "found", "assign",
         "hex", "host", "path", "rule", "verdict", "confidence", "given", "payload", "record_type", "refers_to", "piece", "cluster", "row_key",
         "covered", "id", "ids", "window", "offset", "block", "place", "a", "b", "planes", "documents", "links", "score", "anchor", "kind", "part"]


def _clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH if c not in df.columns])


def _rows(df, *leave):
    return sorted(map(str, map(tuple, df.select(*[c for c in df.columns if c not in leave]).collect())))


@pytest.fixture
def odd(docs_of, corpus):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return docs_of([*corpus, (7000, long), (7000, long), (7001, long + " token=abcdefghijkl")])


@pytest.mark.parametrize("run", [
    lambda d: sharding.vector_shards(d), lambda d: secrets.scan_secrets(d).drop("found"), lambda d: packing.best_fit_packing(d).drop("bin"),
    lambda d: substrings.remove_repeats(d).drop("removed"), lambda d: tiers.tiered_packing(d), lambda d: alignment.align(d, keep_groups=False)],
    ids=["op1", "op2", "op10", "op8", "op12", "op13"])
def test_clashing_columns_of_documents(odd, run):
    plain, clashing = run(odd), run(_clashing(odd))
    assert plain.columns == clashing.columns
    assert _rows(plain) == _rows(clashing)
    assert plain.where("doc_id = 7001").count() >= 1 and plain.select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()


def test_clashing_columns_of_pages(spark):
    long = "http://example.com/de/" + "word/" * 100_000
    rows = [(1, long, "<p>a</p>" * 40), (1, long, "<p>a</p>" * 40), (2, "http://a.net/x", "<p>a</p>" * 40), (None, None, None), (3, "", "x" * 2_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    judged = urls.filter_urls(_clashing(pages), labels)
    assert _rows(judged) == _rows(urls.filter_urls(pages, labels))
    assert sorted((r.page_id or 0, r.verdict) for r in judged.collect()) == [(0, "allow"), (1, "block"), (1, "block"), (2, "block"), (3, "allow")]
    assert _rows(warc.archive_pages(_clashing(pages))) == _rows(warc.archive_pages(pages))


def test_clashing_columns_of_vectors(spark):
    rows = [(i, [float(i % 5) / 5, 0.5, -0.25], i % 3) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert _rows(negatives.hard_negatives(_clashing(vectors))) == _rows(negatives.hard_negatives(vectors))
