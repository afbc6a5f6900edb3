import zlib
from collections import defaultdict

import numpy as np
import pytest
from vitrine.llm import sharding


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_rows_sizes_and_slots(docs_of, corpus):
    got = _rows(sharding.vector_shards(docs_of(corpus), lot_groups=20))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in corpus)
    by_id = defaultdict(list)
    for i, t in corpus:
        by_id[i].append((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    slots = defaultdict(list)
    for r in got:
        assert (r["size"], r["text_crc32"]) in by_id[r["doc_id"]]
        assert 0 <= r["shard"] < sharding.SHARDS and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_tokens_and_rows_are_level(docs_of):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["word"] * int(n)) + f" {i}") for i, n in enumerate(rng.integers(1, 60, 6000))]
    rows += [(10_000 + i, "the same text " * 20) for i in range(3000)]         # a third of all rows in one group
    got = sharding.vector_shards(docs_of(rows), lot_groups=512).groupBy("shard").agg({"size": "sum", "tokens": "sum", "slot": "count"}).toPandas()
    for column, most in (("sum(size)", 0.01), ("sum(tokens)", 0.05), ("count(slot)", 0.05)):
        x = got[column]
        assert len(x) == 24 and (x.max() - x.min()) / x.mean() < most


def test_small_groups_stay_whole(docs_of):
    rows = [(3 * i + k, f"text number {i} " * (i % 7 + 1)) for i in range(3000) for k in range(3)]
    got = sharding.vector_shards(docs_of(rows)).toPandas()
    assert (got.assign(group=got.doc_id // 3).groupby("group")["shard"].nunique() == 1).all()


def test_place_takes_the_highest_dot_product():
    residual = np.array([[10.0, 1.0, 1.0], [1.0, 10.0, 1.0]])
    shards = sharding.place(np.array([[0.0, 2.0, 0.0], [2.0, 0.0, 0.0]]), residual, np.ones(3))
    assert shards.tolist() == [1, 0] and residual[0, 0] == pytest.approx(8) and residual[1, 1] == pytest.approx(8)


def test_empty_table(docs_of):
    assert sharding.vector_shards(docs_of([])).count() == 0
