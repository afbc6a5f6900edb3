import random
import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F
from vitrine.llm import toxicity as tox


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        e, start, move = rng.normal(0, 2, n), rng.normal(), rng.normal(0, 1, (2, 2))
        total, toxic = 0.0, np.zeros(n)
        for path in product((0, 1), repeat=n):
            w = np.exp(start * path[0] + sum(e[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += w
            toxic += w * np.array(path)
        shifted = np.concatenate([rng.normal(0, 1, 3), e, np.zeros(0), rng.normal(0, 1, 2)])
        got = tox.marginals(shifted, np.array([0, 3, 3 + n, 3 + n, 5 + n]), start, move)
        assert np.allclose(got[3:3 + n], toxic / total)


def test_tokens_with_markers_are_labelled_in_toxic_documents():
    texts = ["a b c vile words here", "a b c", "d e f vile", "d e f", "c b a", "plain text here"] * 20
    corpus = tox._corpus(texts)
    labels = tox.token_labels(corpus, np.array([1, 0, 1, 0, 0, 0] * 20))
    words = [w for t in texts for w in t.split()]
    assert [w for w, x in zip(words, labels) if x] == [w for w in words if w in ("vile", "words")]


def _labelled(spark, docs_of, n=1500):
    rng = random.Random(4)
    plain = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit") for b in ("a", "em", "um", "or", "et", "is")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 120))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["nasty", "awful", "gruntig", "gruntos", "gruntem"])
        rows.append((i, " ".join(words)))
        if i % 2 or rng.random() < 0.3:
            labels.append((i, 1, int(toxic)))
    truth = {i: any(w in t for w in ("nasty", "awful", "grunt")) for i, t in rows}
    rows += [(n, None), (n + 1, ""), (None, "nasty awful gruntel"), (n + 2, "awful " * 20_000)]
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth, n


def test_held_out_accuracy_spans_and_filter(spark, docs_of):
    docs, labels, truth, n = _labelled(spark, docs_of)
    got = {r.doc_id: r for r in tox.score_toxicity(docs, labels).collect()}
    assert len(got) == n + 4 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and not any(got[i].held_out for i in truth if i not in set(held))
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = [texts[i][s.start:s.end] for i in truth for s in got[i].spans]
    assert len(spans) > 200 and np.mean([any(w in x for w in ("nasty", "awful", "grunt")) for x in spans]) > 0.95
    kept = {r.doc_id for r in tox.keep_clean(docs.withColumn("score", F.lit(1)), labels).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_labels_of_held_out_rows_are_not_learnt(spark, docs_of):
    docs, labels, _, _ = _labelled(spark, docs_of, 300)
    flipped = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda x: sorted((str(r.doc_id), r.score) for r in tox.score_toxicity(docs, x).collect())
    assert score(labels) == score(flipped)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tox.score_toxicity(docs_of([]), none).count() == 0
    got = tox.score_toxicity(docs_of([(1, "some text")]), none).collect()
    assert got[0].predicted == 0
