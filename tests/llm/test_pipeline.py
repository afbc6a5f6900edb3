import os

import corpus_pipeline
import pytest
from llm_cases import ASCII_LOWER
from vitrine.llm import decontam, jaccard, packing
from vitrine.llm import toxicity as tox

SMALL = "/root/testdata/sf0.001"


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "decontamination", "best_fit_packing"]


@pytest.mark.skipif(not os.path.exists(SMALL), reason="needs the test tables")
def test_run_equals_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    predicted = {r.doc_id: r.predicted for r in tox.score_toxicity(docs, labels).collect()}
    left = {r.doc_id: r for r in docs.collect() if not predicted[r.doc_id]}
    best = {}
    for i, r in left.items():                                         # the largest id of equal texts
        key = (r.text or "").translate(ASCII_LOWER)
        best[key] = max(best.get(key, i), i)
    left = {i: left[i] for i in best.values()}
    sets = {i: set(zip(*[[w for w in (r.text or "").translate(ASCII_LOWER).split()][k:] for k in range(5)])) for i, r in left.items()}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    left = {i: r for i, r in left.items() if find(i) == i}
    index = decontam.build_index([(r.item_id, r.text) for r in bench.collect()])
    items = list(left.items())
    hits = decontam.find_leaks(index, [r.text or "" for _, r in items], decontam.THRESHOLD, decontam.QUESTION, decontam.ANSWER)
    left = {i: r for (i, r), h in zip(items, hits) if not h}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(left)
    tokens = {}
    for r in got:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.tokens
    assert tokens == {i: len((r.text or "").encode().split()) for i, r in left.items()}
    assert max(r.bin_offset + r.tokens for r in got) <= packing.CAPACITY


def test_all_stages_but_the_last_return_the_columns(spark, docs_of, corpus, tmp_path):
    docs = docs_of(corpus)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing of this. is in there")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty = docs_of([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name


def test_jaccard_stage_drops_every_near_copy(docs_of, corpus):
    kept = jaccard.keep_one(docs_of(corpus))
    again = jaccard.ngram_groups(kept.where("text IS NOT NULL AND trim(text) <> ''"))
    assert again.select("component_id").distinct().count() == again.count()
