import random
import re

import numpy as np
import pytest
from vitrine.llm import decontam

WORDS = re.compile(r"\w+")


def _items(rng, n=60):
    word = lambda: rng.choice(["the", "of", "and", "is"]) if rng.random() < 0.4 else f"v{rng.randrange(900)}"
    sentence = lambda k: " ".join(word() for _ in range(k)).capitalize()
    return [(i, f"{sentence(rng.randrange(4, 25))}? {sentence(rng.randrange(1, 8))}." if i % 2 else
             f"{sentence(rng.randrange(5, 20))}. {sentence(rng.randrange(2, 9))}.") for i in range(n)]


def _texts(rng, items, n=150):
    word = lambda: rng.choice(["the", "of", "and", "is"]) if rng.random() < 0.4 else f"v{rng.randrange(900)}"
    out, planted = [], set()
    for d in range(n):
        words = [word() for _ in range(rng.randrange(0, 400))]
        if d % 5 == 0:
            i, t = rng.choice(items)
            at = rng.randrange(len(words) + 1)
            words[at:at] = [t.upper() if d % 2 else t.replace(" ", ",  ")]
            planted.add((d, i))
        out.append(" ".join(words))
    return out, planted


def test_wand_retrieves_exactly_what_scoring_everything_does():
    rng = random.Random(1)
    items = _items(rng)
    index = decontam.build_index(items)
    texts, _ = _texts(rng, items)
    for threshold in (0.2, 0.35, 0.6):
        term = [[index.terms.get(w, -1) for w in WORDS.findall(t.lower())] for t in texts]
        at = np.cumsum([0] + [len(x) for x in term])
        got = decontam.retrieve(index, np.array([x for t in term for x in t], np.int64), at, threshold)
        have = {(o, s, e, i): score for o, s, e, i, score in got}
        want = {}
        for o, t in enumerate(term):
            n, h = len(t), index.longest
            for s in range(0, max(1, n - h), h):
                score = np.zeros(len(items))
                for x in {x for x in t[s:s + 2 * h] if x >= 0}:
                    p = slice(index.at[x], index.at[x + 1])
                    score[index.item[p]] += index.share[p]
                want |= {(o, int(at[o]) + s, int(at[o]) + min(s + 2 * h, n), i): v for i, v in enumerate(score) if v >= threshold - 1e-9}
        assert have.keys() == want.keys()
        assert all(have[k] == pytest.approx(want[k]) for k in want)


def test_planted_items_are_found_and_clean_documents_left(spark, docs_of):
    rng = random.Random(2)
    items = _items(rng)
    texts, planted = _texts(rng, items)
    docs = docs_of([*enumerate(texts), (900, None), (901, ""), (None, items[3][1])]).selectExpr("*", "1 AS score", "2 AS hits")
    bench = spark.createDataFrame([*items, (500, None), (501, ""), (502, "?!")], "item_id long, text string")
    results = []
    for size in (4 << 20, 900, 200):
        rows = decontam.contaminated(docs, bench, index_bytes=size).collect()
        results.append(sorted(((r.doc_id, r.item_id, round(r.score, 9), *tuple(r)[3:]) for r in rows), key=str))
        assert {(r.doc_id, r.item_id) for r in rows} == planted | {(None, 3)}
        kept = decontam.keep_uncontaminated(docs, bench, index_bytes=size)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == (set(range(len(texts))) | {900, 901}) - {d for d, _ in planted}
    assert results[0] == results[1] == results[2]                   # whatever the blocks


def test_very_long_text(spark, docs_of):
    rng = random.Random(4)
    items = _items(rng, 5)
    long = " ".join(f"z{rng.randrange(10 ** 6)}" for _ in range(200_000)) + " " + items[2][1]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(docs_of([(1, long), (2, "x" * 1_000_000)]), bench).collect()] == [(1, 2)]


def test_a_question_without_its_answer_is_no_leak(spark, docs_of):
    bench = spark.createDataFrame([(1, "Which river flows through the old town of Bern? It is the green Aare river."),
                                   (2, "Something else entirely is written in this item. Nothing to see.")], "item_id long, text string")
    docs = docs_of([(1, "they asked: which river flows through the old town of bern and left"),
                    (2, "which river flows through the old town of Bern? It is the green Aare river.")])
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()] == [(2, 1)]


def test_question_and_answer_parts():
    assert decontam.item_parts("What is it? A cat.") == (["what", "is", "it"], ["a", "cat"])
    assert decontam.item_parts("First one. Second one") == (["first", "one"], ["second", "one"])
    assert decontam.item_parts("a b c") == (["a", "b"], ["c"])
    assert decontam.item_parts("") == ([], [])


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert decontam.contaminated(docs_of([(1, "x")]), none).count() == 0
    assert decontam.contaminated(docs_of([]), some).count() == 0
    assert decontam.keep_uncontaminated(docs_of([(1, "x")]), none).count() == 1
