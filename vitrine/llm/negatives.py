"""Hard negatives of anchors, by a secondary sort.

A row is a vector with a label.  Its score with an anchor is the inner product of
their components, each taken as floor(256 * x).  Higher scores come first, ties by the smaller id.  An
anchor's positives are its first rows of the same label.  A positive opens a window of scores
below its own; the window's first rows of other labels are its negatives.

1. *Blocks.*  Rows are packed into blocks, anchors (a stated query set: ids divisible by
   ``ANCHOR_EVERY``) into blocks of their own, dealt by a hash.  Every block of anchors meets every block of
   rows; a task holds one block of each, and the join is dealt by both.
2. *Positives.*  Each meeting gives an anchor's first rows of its label in that block; the
   first of those over all blocks are the anchor's positives.
3. *Scores.*  Positives' scores are the only bounds on what is shuffled: each meeting gives, for every window,
   the first negatives of that block.  A window's first negatives over all blocks are
   among them, so nothing is lost, and no anchor ships all its rows.
4. *Secondary sort.*  Scores are packed into keys (anchor, descending score with positives before
   negatives, id), dealt by the anchor, and sorted within partitions by the shuffle.
   An iterator reads an anchor's rows in that order: a positive opens its window, a
   negative is handed to every open window that it lies in and that is not full.  It holds
   the open windows of one anchor, never the anchor's rows.

An anchor's rows are all rows of the table, so no label and no vector is hot in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.text import batches_of, release
from vitrine.session import materialize

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
#: A window of the positive score p: negatives with LOW * p <= 100 * score <= HIGH * p.
LOW, HIGH = 30, 90
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 1024
#: Components of one packed block, at most, and scores computed at once.
BLOCK_CELLS, SCORES_AT_ONCE = 1 << 22, 1 << 22
#: Larger scores and components stop here, so that keys stay within 64 bits.
MOST = 1 << 61
NO_ID = 2 ** 63 - 1

_BLOCK = "block long, n int, dim int, width int, row binary, id binary, label binary, vector binary"
_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """(row, id, label, vector) of the rows that take part; every row has a number of its own."""
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    moved = F.when((F.col("id") % 7 == 0) & (F.col("id") != NO_ID), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", moved.alias("label"), "vector")


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 * x) as 64-bit integers, stopped at MOST."""
    return np.clip(np.floor(256.0 * values.astype(np.float64)), -float(MOST), float(MOST)).astype(np.int64)


def _packed(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """One block, its rows in the order of their ids."""
    order = np.lexsort((rows, ids))
    most = int(np.abs(vectors).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    raw = lambda x, k=np.int64: pa.array([np.ascontiguousarray(x[order], k).tobytes()], pa.binary())
    ints = [pa.array([len(ids)], pa.int32()), pa.array([vectors.shape[1]], pa.int32()), pa.array([np.dtype(kind).itemsize], pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array([int(rows.min())], pa.int64()), *ints, raw(rows), raw(ids), raw(labels), raw(vectors, kind)],
                                      [f.split()[0] for f in _BLOCK.split(", ")])


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter lists end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    size = np.diff(offsets)
    values = np.asarray(column.values)[offsets[0]:offsets[-1]]
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), at] = quantised(values)
    return out


def _pack_blocks(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            dim = max(v.shape[1] for *_, v in held)
            wide = [np.pad(v, ((0, 0), (0, dim - v.shape[1]))) for *_, v in held]
            rows, ids, labels = (np.concatenate([h[k] for h in held]) for k in range(3))
            held.clear()
            return _packed(rows, ids, labels, np.concatenate(wide))

        for batch in batches:
            wide = max(1, len(batch.column("vector").values) // max(1, batch.num_rows))
            most = max(1, min(block_rows, BLOCK_CELLS // wide))
            lo = 0
            while lo < batch.num_rows:
                room = most - sum(len(h[0]) for h in held)
                if room <= 0:
                    yield block()
                    continue
                piece = batch.slice(lo, room)
                held.append((*(piece.column(c).to_numpy() for c in ("row", "id", "label")), _matrix(piece.column("vector"))))
                lo += piece.num_rows
        if held:
            yield block()
        release()

    return run


class _Block:
    """A packed block, read."""

    def __init__(self, record: dict):
        read = lambda c, k=np.int64: np.frombuffer(record[c], k)
        self.rows, self.ids, self.labels = read("row"), read("id"), read("label")
        self.vectors = read("vector", f"i{record['width']}").reshape(record["n"], record["dim"])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a with all rows of b; exact up to MOST."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    size = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, dim)
    if size < 1 << 53:
        kind = np.float32 if size < 1 << 24 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T if dim else np.zeros((len(a), len(b)), object)
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def _first(score: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Of the places `at` (ascending) the n with the highest scores, ties by the smaller place."""
    if len(at) <= n:
        return at
    own = score[at]
    least = np.partition(own, len(own) - n)[len(own) - n]
    above = at[own > least]
    return np.concatenate([above, at[own == least][:n - len(above)]])


#: kind 0: one of the anchor's rows of its label; 1: of another one.
_PAIRS = "anchor long, anchor_id long, kind int, score long, id long"


def _meet(positives: int, negatives: int, low: int, high: int):
    """(block of rows, block of anchors) -> _PAIRS: the block's first positives of each anchor, or where the
    anchors carry their positives' scores, the first negatives of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                block, anchors = _Block(record), record["anchors"]
                vectors = [np.frombuffer(a["vector"], f"i{a['width']}") for a in anchors]
                dim = max(len(v) for v in vectors)
                of_anchors = np.stack([np.pad(v.astype(np.int64), (0, dim - len(v))) for v in vectors])
                out: list[list[np.ndarray]] = [[] for _ in range(5)]
                step = max(1, SCORES_AT_ONCE // len(block.rows))
                for lo in range(0, len(anchors), step):
                    table = scores(of_anchors[lo:lo + step], block.vectors)
                    for a, score in zip(anchors[lo:lo + step], table):
                        same = block.labels == a["label"]
                        if a["bounds"] is None:
                            found = _first(score, np.flatnonzero(same & (block.rows != a["row"])), positives)
                        else:
                            found = [_first(score, np.flatnonzero(~same & (score >= -(-low * p // 100)) & (score <= high * p // 100)), negatives)
                                     for p in set(a["bounds"])]
                            found = np.unique(np.concatenate(found))
                        n = len(found)
                        for k, x in enumerate((np.full(n, a["row"]), np.full(n, a["id"]), np.full(n, int(a["bounds"] is not None)),
                                               score[found], block.ids[found])):
                            out[k].append(x)
                columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)],
                                                 ["anchor", "anchor_id", "kind", "score", "id"])

    return run


def _open_windows(positives: int, negatives: int, low: int, high: int):
    """Sorted keys (anchor, order, id) -> _OUT, in one pass that holds the open windows of one anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _OUT.split(", ")]
        anchor, opened, windows = None, 0, []
        for batch in batches:
            out = []
            for own, anchor_id, order, other in zip(*(batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "order", "id"))):
                if own != anchor:
                    anchor, opened, windows = own, 0, []
                score = -(order >> 1)
                if not order & 1:
                    if opened < positives:
                        opened += 1
                        windows.append([-(-low * score // 100), high * score // 100, 0, other, score])
                    continue
                full = False
                for w in windows:
                    if w[0] <= score <= w[1]:
                        w[2] += 1
                        out.append((anchor_id, w[3], w[2], other, w[4], score))
                        full |= w[2] == negatives
                if full:
                    windows = [w for w in windows if w[2] < negatives]
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _meetings(blocks: DataFrame, anchors: DataFrame, n_blocks: int, n_anchor_blocks: int) -> DataFrame:
    """Every block of anchors with every block of rows, dealt by both."""
    tasks = min(n_blocks * n_anchor_blocks, 100_000)
    salt = F.pmod(F.xxhash64("block"), F.lit(n_blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.withColumn("salt", salt).withColumn("part", every(n_anchor_blocks)).repartition(tasks, "part", "salt")
    packed = anchors.groupBy("part").agg(F.collect_list(F.struct("row", "id", "label", "width", "vector", "bounds")).alias("anchors"))
    return left.join(packed.withColumn("salt", every(n_blocks)).repartition(tasks, "part", "salt"), ["part", "salt"]).drop("part", "salt")


def _anchor_rows(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                b = _Block(record)
                at = np.flatnonzero((b.ids % every == 0) & (b.ids != NO_ID))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.rows[at]), pa.array(b.ids[at]), pa.array(b.labels[at]), pa.array(np.full(len(at), record["width"], np.int32)),
                     pa.array([b.vectors[i].tobytes() for i in at], pa.binary())], ["row", "id", "label", "width", "vector"])

    return run


def hard_negatives(vectors: DataFrame, vector: str = "embedding", label: str = "label", every: int = ANCHOR_EVERY, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS,
                   block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """One row per (anchor, positive, negative): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a NULL label, a NULL vector, or a NULL or non-finite component take no part.
    A vector that is shorter than another ends in zeros; an empty one scores 0 with all.
    A row without an id is no anchor; as a positive or negative it comes last of equal scores, and its id is
    NULL.  Repeated rows are rows of their own: each can be a positive of the other, and a repeated anchor gives its
    rows once for each.  A negative positive score opens an empty window, one of 0 a window that
    holds scores of 0.  Other columns are ignored.  No anchors, no positives, an empty table: an empty result.
    """
    spark = vectors.sparkSession
    with batches_of(spark, 1000):
        blocks = materialize(usable(vectors, vector, label).mapInArrow(_pack_blocks(block_rows), _BLOCK), "negatives-blocks")
    n_blocks = blocks.count()
    with batches_of(spark, 2):
        anchors = blocks.mapInArrow(_anchor_rows(every), "row long, id long, label long, width int, vector binary")
        anchors = materialize(anchors, "negatives-anchors")
        n_anchors = anchors.count()
        if not n_anchors:
            return spark.createDataFrame([], _OUT)
        n_parts = -(-n_anchors // block_anchors)
        anchors = anchors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_parts)).cast("int"))
        meet = _meet(positives, negatives, low, high)
        met = _meetings(blocks, anchors.withColumn("bounds", F.lit(None).cast("array<long>")), n_blocks, n_parts).mapInArrow(meet, _PAIRS)
        best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
        first = materialize(met.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= positives).drop("_n"), "negatives-positives")
        bounds = first.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("bounds"))
        met = _meetings(blocks, anchors.join(bounds, "row"), n_blocks, n_parts).mapInArrow(meet, _PAIRS)
        pairs = materialize(first.unionByName(met), "negatives-scores")
    keys = pairs.select("anchor", "anchor_id", (-F.col("score") * 2 + F.col("kind")).alias("order"), "id")
    ordered = keys.repartition("anchor").sortWithinPartitions("anchor", "order", "id")
    rows = ordered.mapInArrow(_open_windows(positives, negatives, low, high), _OUT)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return rows.select("anchor_id", real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score")
