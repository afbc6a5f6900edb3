import random

import numpy as np
import pyarrow as pa
from llm_cases import ASCII_LOWER, WORD
from vitrine.llm import jaccard
from vitrine.llm.components import connected_components


def _set(text):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _linked(x, y):
    return bool(x) and 100 * len(x & y) >= 75 * len(x | y)


def _components(rows):
    sets = [_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if _linked(sets[i], sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        known = least.setdefault(find(i), [])
        if d is not None:
            known.append(d)
    return sorted(((d, len(s), min(least[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_components_equal_brute_force(docs_of, corpus):
    want = _components(corpus)
    assert _got(jaccard.ngram_groups(docs_of(corpus))) == want
    # Every run is long: all links come from dense sets; and look-ups are shuffled joins.
    assert _got(jaccard.ngram_groups(docs_of(corpus), run_limit=1, shard_bytes=20_000, broadcast_rows=0)) == want


def test_borderline_pairs_and_short_texts(docs_of):
    rng = random.Random(9)
    rows = []
    for k in range(60):                          # pairs around the threshold, of equal and of unequal sizes
        words = [f"t{rng.randrange(10 ** 6)}" for _ in range(rng.choice([5, 6, 8, 9, 14, 40, 90, 250]))]
        other = list(words)
        for _ in range(rng.randrange(0, max(2, len(words) // 14))):
            other[rng.randrange(len(other))] = f"y{rng.randrange(10 ** 6)}"
        rows += [(4 * k, " ".join(words)), (4 * k + 1, "\t".join(other[:rng.randrange(len(other) * 4 // 5, len(other) + 1)])),
                 (4 * k + 2, " ".join(words[len(words) // 8:]))]
    rows += [(900, "one two"), (901, "One  two"), (902, "one two three"), (903, "x"), (904, "X"), (905, ""), (906, None)]
    assert _got(jaccard.ngram_groups(docs_of(rows))) == _components(rows)


def test_signatures_meet_for_every_link():
    """PartEnum's promise: two linked sets share a signature; each touches more parts than may differ, or is weak."""
    rng = np.random.default_rng(2)
    upper = jaccard.bands(400)
    for _ in range(200):
        x = rng.choice(10 ** 9, rng.integers(1, 300), replace=False).astype(np.uint64)
        y = x[rng.random(len(x)) > rng.random() * 0.3]
        y = np.union1d(y, rng.choice(10 ** 9, rng.integers(0, len(x) // 6 + 1)).astype(np.uint64))
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        row = np.repeat([0, 1], [len(x), len(y)])
        (r, _, sig), (who, band, slack) = jaccard.signatures(row, np.concatenate([x, y]), np.array([len(x), len(y)]), upper)
        meet = np.searchsorted(upper, max(len(x), len(y)))
        weak = [(slack[(who == k) & (band == meet)] < 0).all() for k in (0, 1)]
        assert set(sig[r == 0].tolist()) & set(sig[r == 1].tolist()) or all(weak)


def test_the_filter_drops_no_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x = np.unique(rng.integers(0, 10 ** 12, rng.integers(1, 400)).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > rng.random() * 0.4], rng.integers(0, 10 ** 12, rng.integers(0, len(x) // 5 + 1)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 4 * both >= 3 * (len(x) + len(y) - both):
            assert jaccard.may_link(jaccard._sketch(x), jaccard._sketch(y), len(x), len(y))


def test_large_groups_of_near_copies_make_few_pairs(docs_of):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(150)] = f"z{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    docs = docs_of(rows).select("doc_id", "text")
    _, classes = jaccard.describe(docs)
    assert jaccard.set_links(docs, classes).count() < 12 * len(rows)
    assert {r.component_id for r in jaccard.ngram_groups(docs).collect()} == {0}


def test_one_document_of_each_component_stays(docs_of, corpus):
    docs = docs_of(corpus).selectExpr("*", "doc_id AS set_id", "1 AS stays")
    want = _components(corpus)
    for limit in (0, 10 ** 6):
        kept = jaccard.keep_one(docs, broadcast_rows=limit)
        assert kept.columns == docs.columns
        have = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
        assert have == sorted({d for d, n, c in want if n and d is not None and d == c} | {d for d, n, _ in want if not n and d is not None})
        assert kept.where("doc_id IS NULL").count() == 1          # the lonely text; the copy of the base goes


def test_shingle_sets_of_batches():
    column = pa.array(["A b c d e f", None, "a B c D e f", "", "a b"])
    row, value = jaccard.shingle_sets(column)
    assert np.bincount(row, minlength=5).tolist() == [2, 0, 2, 0, 1]
    assert value[row == 0].tolist() == value[row == 2].tolist()


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b", "test-components").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200, 202: 200}


def test_empty_table(docs_of):
    assert jaccard.ngram_groups(docs_of([])).count() == 0
    assert jaccard.keep_one(docs_of([])).count() == 0
    assert jaccard.ngram_groups(docs_of([(1, None), (2, "")])).count() == 2
