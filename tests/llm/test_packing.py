import random
from collections import defaultdict

import pyarrow as pa
from llm_cases import ASCII_LOWER, WORD
from vitrine.llm import packing, text


def _naive(sizes, sources, clusters, capacity, per_source):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= size and b["sources"].count(source) < per_source
                and (cluster is None or cluster not in b["clusters"])]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"left": capacity, "sources": [], "clusters": []})
            i = len(bins) - 1
        out.append((i, capacity - bins[i]["left"]))
        bins[i]["left"] -= size
        bins[i]["sources"].append(source)
        bins[i]["clusters"].append(cluster)
    return out


def test_best_fit_equals_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randrange(1, 120)
        sizes = sorted((rng.randrange(0, 40) for _ in range(n)), reverse=True)
        sources = [rng.choice(["hot", "hot", "a", "b", None]) for _ in range(n)]
        clusters = [rng.choice([None, 1, 2, 3, i + 9]) for i in range(n)]
        per = rng.randrange(1, 4)
        assert packing.best_fit(sizes, sources, clusters, 40, per) == _naive(sizes, sources, clusters, 40, per)


def test_every_token_is_packed_once_and_nothing_conflicts(docs_of, corpus):
    sources = ["hot", None, "hot", "a", "b"]
    rows = [(i, t, sources[k % 5]) for k, (i, t) in enumerate(corpus)]
    got = [r.asDict() for r in packing.best_fit_packing(docs_of(rows), capacity=100, per_source=2, lot_rows=30).collect()]
    tokens = defaultdict(int)
    for r in got:
        tokens[r["doc_id"]] += r["tokens"]
    want = defaultdict(int)
    for i, t in corpus:
        want[i] += len(WORD.findall(t or ""))
    assert tokens == want
    text = {i: t for i, t in corpus}
    bins = defaultdict(list)
    for r in got:
        bins[r["bin"]].append(r)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: (r["bin_offset"], r["tokens"])):
            assert r["bin_offset"] == at
            at += r["tokens"]
        assert at <= 100
        by_source = defaultdict(int)
        clusters = [text[r["doc_id"]].translate(ASCII_LOWER) for r in rows if r["doc_id"] is not None and text[r["doc_id"]]]
        assert len(set(clusters)) == len(clusters)
        for r in rows:
            by_source[r["source"]] += 1
        assert max(by_source.values()) <= 2


def test_empty_table_and_large_ids(docs_of):
    assert packing.best_fit_packing(docs_of([])).count() == 0
    big = 2 ** 62 + 1
    assert {r.doc_id for r in packing.best_fit_packing(docs_of([(big, "a b"), (None, "c")])).collect()} == {big, None}


def test_words_are_counted_without_a_string_for_each(docs_of, corpus, monkeypatch):
    """No word strings in the JVM, texts in small Arrow batches, and the counts of the pattern."""
    seen = []

    def spy(df, name):
        seen.append((df._jdf.queryExecution().optimizedPlan().toString(),
                     int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
        return kept(df, name)

    kept = packing.materialize
    monkeypatch.setattr(packing, "materialize", spy)
    docs = docs_of(corpus)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = docs.sparkSession.conf.get(key)
    rows = packing.packing_rows(docs)
    assert "regexp_" not in seen[0][0] and seen[0][1] <= text.BATCH_ROWS
    assert docs.sparkSession.conf.get(key) == before
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.tokens) for r in rows.collect()))
    assert got == sorted(((i is None, i or 0, len(WORD.findall(t or ""))) for i, t in corpus))


def test_word_counts_across_chunks_and_slices(monkeypatch):
    monkeypatch.setattr(text, "CHUNK", 7)
    rng = random.Random(4)
    texts = [None if rng.random() < 0.1 else "".join(rng.choice("ab\u00e9\u2581 \t\n\x0b\x1c\x85") for _ in range(rng.choice([0, 1, 3, 9, 60])))
             for _ in range(400)]
    want = [len(WORD.findall(t or "")) for t in texts]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.chunked_array([texts[:9], texts[9:]], pa.string())):
        assert text.word_counts(column).tolist() == want
    assert text.word_counts(pa.array(texts)[5:77]).tolist() == want[5:77]
    assert text.word_counts(pa.array([], pa.string())).tolist() == []
