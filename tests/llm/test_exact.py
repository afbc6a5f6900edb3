import hashlib
from collections import defaultdict

from llm_cases import ASCII_LOWER
from vitrine.llm import exact


def _brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(ASCII_LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best, digest = max(known, default=None), hashlib.sha256(t.encode()).hexdigest()
        kept = [i == best for i in ids]
        if sum(kept) > 1:                      # repeated rows: one stays
            first = kept.index(True)
            kept = [k == first for k in range(len(ids))]
        out += [(i, best, len(ids), k, digest) for i, k in zip(ids, kept)]
    return sorted(out, key=str)


def test_every_row_is_decided_like_brute_force(docs_of, corpus):
    for counters in (1, 7, 1000):
        got = exact.exact_dedup(docs_of(corpus), counters).collect()
        assert sorted(map(tuple, got), key=str) == _brute(corpus)


def test_kept_rows_have_all_columns(docs_of, corpus):
    docs = docs_of(corpus).selectExpr("*", "doc_id AS digest", "text AS `wins`", "1 AS `a.b`")
    for limit in (0, 10 ** 6):                 # shuffled and broadcast removal
        got = exact.keep_exact(docs, broadcast_rows=limit)
        assert got.columns == docs.columns
        want = sorted((r[0], r[4]) for r in _brute(corpus) if r[3] and r[0] is not None)
        have = sorted((r.doc_id, hashlib.sha256((r.text or "").translate(ASCII_LOWER).encode()).hexdigest())
                      for r in got.collect() if r.doc_id is not None)
        assert have == want


def test_misra_gries_holds_every_frequent_digest(spark):
    values = [b"hot"] * 400 + [b"warm"] * 90 + [str(i).encode() for i in range(600)]
    df = spark.createDataFrame([(bytearray(v),) for v in values], "d binary").repartition(5)
    found = {bytes(r.digest) for r in exact.misra_gries(df, "d", 24).collect()}
    assert {b"hot", b"warm"} <= found and len(found) <= 25


def test_empty_table(docs_of):
    assert exact.exact_dedup(docs_of([])).count() == 0
    assert exact.keep_exact(docs_of([])).count() == 0
