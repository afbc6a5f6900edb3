"""Hard negatives against a plain double loop."""

import math
import random

from vitrine.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, score string"


def _brute(rows, every=100, positives=5, negatives=10):
    import struct
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(f32(x)) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * f32(x)) for x in vector], label))
    last = lambda i: (i is None, i or 0)
    out = []
    for i, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), k) for k, (_, w, _) in enumerate(kept) if k != i),
                        key=lambda x: (-x[0], last(kept[x[1]][0])))
        for p, k in [x for x in scored if kept[x[1]][2] == label][:positives]:
            found = [(s, j) for s, j in scored if kept[j][2] != label and 30 * p <= 100 * s <= 90 * p][:negatives]
            out += [(anchor, kept[k][0], r, kept[j][0], p, s) for r, (s, j) in enumerate(found, 1)]
    return sorted(out, key=repr)


def _rows(seed, n, dim=4, labels=3):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]
    hot = [0.5] * dim
    rows += [(n + i, hot, rng.randrange(labels)) for i in range(n // 3)]                # one very common vector
    rows += [(100, [0.3] * dim, 1), (100, [0.3] * dim, 1), (None, hot, 1), (None, [0.1] * dim, 0)]   # repeated, without id
    rows += [(-200, [0.4, None, 0.1, 0.2], 1), (-300, [float("nan")] * dim, 1), (-400, [float("inf"), 0.0, 0.0, 0.0], 0), (-500, None, 1),
             (-600, hot, None), (-700, [0.5, 0.5], 1), (-800, [], 2), (-900, [0.0] * dim, 1), (-901, [0.0] * dim, 1)]
    rng.shuffle(rows)
    return rows


def _run(spark, rows, **limits):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, N.hard_negatives(df, **limits).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = _rows(1, 260)
    assert _run(spark, rows, every=20) == _brute(rows, every=20)


def test_small_blocks_give_the_same(spark):
    rows = _rows(2, 150)
    want = _brute(rows, every=10, positives=3, negatives=4)
    assert want and _run(spark, rows, every=10, positives=3, negatives=4, block_rows=16, block_anchors=5) == want


def test_no_anchors_no_rows_and_huge_components(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    big = [(0, [3e30, 1.0], 3), (1, [2e30, 0.0], 4), (2, [1e30, 0.0], 5)]         # scores stop at MOST, nothing fails
    assert all(abs(r[4]) <= N.MOST and abs(r[5]) <= N.MOST for r in _run(spark, big, every=1))


def test_the_iterator_holds_windows_of_one_anchor_only():
    """Ties: a positive's window is open for negatives of the same score (0), and full windows close."""
    import pyarrow as pa
    pairs = [(7, 700, 0, 0, 50), (7, 700, 0, 1, 20), (7, 700, 0, 1, 30), (7, 700, 0, 1, 40), (8, 800, 0, 1, 1)]
    keys = sorted((a, -s * 2 + k, i, anchor) for a, anchor, s, k, i in pairs)
    batch = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[3] for k in keys]), pa.array([k[1] for k in keys]),
                                        pa.array([k[2] for k in keys])], ["anchor", "anchor_id", "order", "id"])
    out = [tuple(r.values()) for b in N._open_windows(5, 2, 30, 90)(iter([batch])) for r in b.to_pylist()]
    assert out == [(700, 50, 1, 20, 0, 0), (700, 50, 2, 30, 0, 0)]
