"""Similarity join on word shingles: Jaccard of 0.75 or more, by PartEnum signatures.

Sets x and y with 4 |x & y| >= 3 |x | y| differ in at most H = (|x| + |y|) / 7 elements.

1. *Classes.*  Equal sets form a class; only distinct sets are compared.
2. *Signatures.*  Sizes are cut into bands (up to U[0], U[1], ...; ratio ``RATIO``).  A pair
   belongs to the band of its larger set, so a set takes part in its own band and in
   those that a partner of up to 4/3 of its size reaches.  In a band the domain of shingles is
   partitioned by a hash into about ``SHARE * U`` parts, more than H: of the parts that a
   set touches, at most H differ from a partner's.  A signature is (band, part, the
   set's elements in it); every partner has one in common.  Empty parts have none.
3. *Runs.*  Signatures are shuffled in packed form.  Sets that share one form a run.
   Runs of up to ``RUN`` sets give their pairs.  Longer runs (boilerplate that many documents
   share, or large groups of near copies) are left out where that loses nothing: a set
   that keeps more than H signatures outside them still meets every partner in a
   short run.  Sets that do not are *dense*.
4. *Dense sets.*  (a) In each long run every dense set is paired with its hub, the run's smallest
   set that it may be linked with, which ties large groups of near copies, and texts that are one passage for
   the most part, together.  The task that holds the run names the hubs
   and counts each set's long runs; members of long runs are not listed.  (b) What may be left are links between
   two dense sets that are not yet connected.  The dense sets' rarest shingles
   (a quarter of each set, rarest among the dense sets first: sets that share three quarters
   share one of these) form runs again.  Each set is tested with the next two of its runs, which ties those with many
   links; then all pairs of different components are.  So no link between components is
   lost, and no group is paired with itself.
5. *Verification.*  Candidates pass a filter that never drops a link (parities of the elements
   by hash: at most H differ), and then their whole sets are intersected.
6. Components of the links; every document gets the smallest doc_id it can reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.components import connected_components
from vitrine.llm.text import grams, mix64, release, small_batches, words
from vitrine.session import materialize

SHINGLE = 5
RATIO = 1.75
SHARE = 0.36
RUN = 16
#: Text that one shard of signatures is made for.
SHARD_BYTES = 16 << 20
MIN_SHARDS = 16
ROWS_AT_ONCE = 250
#: A shard is sorted in so many pieces (as a power of two), by other bits of the signatures.
PIECE_BITS = 3
PAIRS_AT_ONCE = 1_000_000
#: Sets of a shingle that each one is first tested with.
NEIGHBOURS = 2
#: Signatures that a task packs together.
SIGNATURES_AT_ONCE = 200_000
#: Ids of sets to look up are broadcast up to this many; beyond it the look-up is a shuffled join.
BROADCAST_ROWS = 2_000_000
NO_ID = 2 ** 63 - 1


def bands(longest: int) -> np.ndarray:
    """Upper ends of the bands, up to the first that a set of `longest` elements needs no other beyond."""
    out = [1]
    while out[-1] < 2 * longest:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO)))
    return np.array(out, np.int64)


def parts(upper: np.ndarray) -> np.ndarray:
    return np.ceil(SHARE * upper).astype(np.int64) + 3


def most_different(x: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Largest H of a set of size x with a partner in the band that ends at `upper`."""
    return (x + np.maximum(x, np.minimum(upper, 4 * x // 3))) // 7


# ---- shingles ------------------------------------------------------------------------------------------------------

def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of a batch, distinct and in order: hashes of 5 words, or of all where there are fewer."""
    w = words(column, lower=True)
    size = np.diff(w.rows)
    row = np.repeat(np.arange(len(size)), size)
    g = grams(w.hash, SHINGLE)
    inside = np.flatnonzero(row[:len(g)] == row[len(row) - len(g):])
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    rows = [row[inside]] + [short]
    whole = [grams(w.hash[w.rows[i]:w.rows[i + 1]], int(size[i])) ^ np.uint64(size[i]) for i in short]
    value = np.concatenate([g[inside], *whole])
    rows = np.concatenate(rows)
    order = np.lexsort((value, rows))
    rows, value = rows[order], value[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
    return rows[keep], value[keep]


def _set_ids(row: np.ndarray, value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 63-bit hash of each set, 0 for an empty one."""
    out = np.zeros(len(n), np.uint64)
    if len(row):
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        total = np.add.reduceat(mix64(value), head)
        out[row[head]] = mix64(total + n[row[head]].astype(np.uint64)) >> np.uint64(1)
    return out.astype(np.int64)


def _sketch(value: np.ndarray) -> bytes:
    """Bits, at least four an element: whether the number of elements that a hash deals to a place is odd."""
    bits = 1 << max(7, (4 * len(value) - 1).bit_length())
    count = np.bincount((mix64(value + np.uint64(77)) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    """False only for pairs that differ in more than H elements: each such element changes one bit.

    Bits of the longer sketch are folded, so that both have the same places."""
    if 4 * min(n_a, n_b) < 3 * max(n_a, n_b):
        return False
    size = min(len(a), len(b)) // 8
    x, y = (np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, size), axis=0) for s in (a, b))
    return int(np.bitwise_count(x ^ y).sum()) <= (n_a + n_b) // 7


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(lo, ROWS_AT_ONCE)
    release()


_SETS = "doc_id long, n_shingles long, set_id long, sketch binary"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> _SETS."""
    for batch in _small(batches):
        row, value = shingle_sets(batch.column("text"))
        n = np.bincount(row, minlength=batch.num_rows)
        at = np.concatenate([[0], np.cumsum(n)])
        sketch = [_sketch(value[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(_set_ids(row, value, n)),
                                          pa.array(sketch, pa.binary())], ["doc_id", "n_shingles", "set_id", "sketch"])


_SET = T.StructType([T.StructField("id", T.LongType()), T.StructField("elements", T.ArrayType(T.LongType()))])


@F.arrow_udf(_SET)
def _read_set(text: pa.Array) -> pa.Array:
    """The set of a text: its id, and its elements."""
    ids, offsets, values, base = [], [np.zeros(1, np.int64)], [], 0
    for lo in range(0, len(text), ROWS_AT_ONCE):
        piece = text[lo:lo + ROWS_AT_ONCE]
        row, value = shingle_sets(piece)
        n = np.bincount(row, minlength=len(piece))
        ids.append(_set_ids(row, value, n))
        offsets.append(base + np.cumsum(n))
        values.append(value.astype(np.int64))
        base += len(value)
    cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    release()
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(cat(values)))
    return pa.StructArray.from_arrays([pa.array(cat(ids), pa.int64()), lists], ["id", "elements"])


# ---- signatures ----------------------------------------------------------------------------------------------------

_PACKED = "shard int, set_id binary, size binary, band binary, slack binary, n binary, signature binary, weak binary"


def _band_range(size: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last band that a set of this size takes part in."""
    return np.searchsorted(upper, size), np.searchsorted(upper, 4 * size // 3)


def signatures(row: np.ndarray, value: np.ndarray, n: np.ndarray, upper: np.ndarray):
    """(row, band, signature) of the sets, and (row, band, slack): signatures above the largest H."""
    low, high = _band_range(n, upper)
    out, slack = [], []
    for step in range(int((high - low).max(initial=0)) + 1):
        band = low + step
        on = (n > 0) & (band <= high)
        pick = on[row]
        r, v, j = row[pick], value[pick], band[row[pick]]
        count = parts(upper)[j]
        part = (mix64(v ^ mix64(j.astype(np.uint64) + np.uint64(101))) % count.astype(np.uint64)).astype(np.int64)
        cell = r << 32 | part
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        head = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        total = np.add.reduceat(mix64(v[order] + np.uint64(7)), head) if len(head) else np.zeros(0, np.uint64)
        r, part = cell[head] >> 32, (cell[head] & 0xFFFFFFFF).astype(np.uint64)
        j = band[r]
        out.append((r, j, mix64(total ^ mix64((j.astype(np.uint64) << np.uint64(32)) | part))))
        rows = np.flatnonzero(on)
        touched = np.bincount(r, minlength=len(n))[rows]
        slack.append((rows, band[rows], touched - most_different(n[rows], upper[band[rows]]) - 1))
    cat = lambda parts: tuple(np.concatenate(x) for x in zip(*parts))
    return cat(out), cat(slack)


def _pack(kind: type, values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _unpack(kind: type, column) -> np.ndarray:
    found = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(found) if found else np.zeros(0, kind)


def _emit_signatures(upper: np.ndarray, shards: int):
    """(text) -> packed signatures for each shard, grouped by set and band; a set once a batch.

    Signatures of several batches are packed together, so that a shard gets few and long rows."""
    names = [f.split()[0] for f in _PACKED.split(", ")]

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, n, band, slack, sig = (np.concatenate([h[k] for h in held]) for k in range(5))
        weak = np.concatenate([h[5] for h in held])
        held.clear()
        shard = (sig % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((band, ids, shard))
        ids, n, band, slack, sig, shard = (x[order] for x in (ids, n, band, slack, sig, shard))
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (band[1:] != band[:-1]) | (shard[1:] != shard[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(ids)))
        weak = weak[np.argsort(weak % shards, kind="stable")]
        present = np.union1d(shard, weak % shards)
        cut, head_cut = (np.searchsorted(x, present, "left") for x in (shard, shard[head]))
        end, head_end = (np.searchsorted(x, present, "right") for x in (shard, shard[head]))
        weak_cut, weak_end = (np.searchsorted(weak % shards, present, side) for side in ("left", "right"))
        out = []
        for k, s in enumerate(present.tolist()):
            h = head[head_cut[k]:head_end[k]]
            out.append((s, _pack(np.int64, ids[h]), _pack(np.uint32, n[h]), _pack(np.uint8, band[h]), _pack(np.int32, slack[h]),
                        _pack(np.uint32, count[head_cut[k]:head_end[k]]), _pack(np.uint64, sig[cut[k]:end[k]]),
                        _pack(np.int64, weak[weak_cut[k]:weak_end[k]])))
        columns = list(zip(*out)) if out else [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in _small(batches):
            row, value = shingle_sets(batch.column("text"))
            n = np.bincount(row, minlength=batch.num_rows)
            ids = _set_ids(row, value, n)
            first = np.zeros(len(ids), bool)
            first[np.unique(ids, return_index=True)[1]] = True
            first &= n > 0
            keep = first[row]
            row, value = row[keep], value[keep]
            (r, band, sig), (slack_row, slack_band, slack) = signatures(row, value, np.where(first, n, 0), upper)
            slack_of = np.zeros((len(n), len(upper)), np.int32)
            slack_of[slack_row, slack_band] = slack
            weak = ids[np.unique(slack_row[slack < 0])]
            held.append((ids[r], n[r].astype(np.uint32), band.astype(np.uint8), slack_of[r, band], sig, weak))
            if sum(len(h[0]) for h in held) >= SIGNATURES_AT_ONCE:
                yield packed(held)
        if held:
            yield packed(held)

    return run


#: kind 0: a pair of sets (x, y); 1: set x is in y long runs of a band with a slack; 2: set x is weak in a band;
#: 3: y is the hub of set x in a long run.
_RUNS = "kind int, x long, y long, band int, slack int"


def _runs_of(sig: np.ndarray, owner: np.ndarray, ids: np.ndarray, size: np.ndarray, band: np.ndarray, upper: np.ndarray, run_limit: int):
    """Distinct pairs of the short runs (2, n); owner, and hub, of each member of the long runs.

    The hub is the run's smallest set that is large enough to be a partner: sets that consist of the
    same passage for the most part are all near the one that has least besides."""
    order = np.argsort(sig)
    sig, owner = sig[order], owner[order]
    alone = np.ones(len(sig), bool)                # signatures that occur once are done with
    twin = sig[1:] == sig[:-1]
    alone[1:] &= ~twin
    alone[:-1] &= ~twin
    sig, owner = sig[~alone], owner[~alone]
    order = np.lexsort((ids[owner], sig))
    sig, owner = sig[order], owner[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (ids[owner][1:] != ids[owner][:-1])
    sig, owner = sig[new], owner[new]              # a set once a run
    head = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    length = np.diff(np.append(head, len(sig)))
    pairs = [np.zeros((2, 0), np.int64)]
    for m in range(2, run_limit + 1):
        at = head[length == m]
        for i in range(m):
            for j in range(i + 1, m):
                a, b = owner[at + i], owner[at + j]
                big = np.maximum(size[a], size[b]).astype(np.int64)
                fit = (4 * np.minimum(size[a], size[b]).astype(np.int64) >= 3 * big) & (np.searchsorted(upper, big) == band[a])
                pairs.append(np.stack([ids[a[fit]], ids[b[fit]]]))
    long = np.repeat(length > run_limit, length)
    run, owner = np.repeat(np.arange(len(head)), length)[long], owner[long]
    own = size[owner].astype(np.int64)
    order = np.lexsort((ids[owner], own, run))
    run, owner, own = run[order], owner[order], own[order]
    step = int(own.max(initial=0)) + 1
    hub = owner[np.searchsorted(run * step + own, run * step + -(-3 * own // 4))]
    return np.unique(np.concatenate(pairs, axis=1), axis=1), owner, ids[hub]


def _find_runs(upper: np.ndarray, run_limit: int):
    """Packed signatures of shards -> pairs of short runs, number of long runs of each set, their hubs, weak sets.

    A partition has its shards one after the other, and one is held at a time."""

    def runs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        mine = pa.Table.from_batches(held)
        held.clear()
        get = lambda c, kind: _unpack(kind, mine.column(c))
        count, sig = get("n", np.uint32), get("signature", np.uint64)
        ids, size, band, slack = (get(c, k) for c, k in (("set_id", np.int64), ("size", np.uint32), ("band", np.uint8), ("slack", np.int32)))
        weak = np.unique(get("weak", np.int64))
        del mine
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), count)
        found = [_runs_of(sig[pick], owner[pick], ids, size, band, upper, run_limit)
                 for pick in (sig >> np.uint64(64 - PIECE_BITS) == p for p in range(1 << PIECE_BITS))]
        pairs = np.unique(np.concatenate([f[0] for f in found], axis=1), axis=1)
        o, hub = (np.concatenate([f[k] for f in found]) for k in (1, 2))
        # A set once a band (it may come from several batches), with its number of long runs here.
        key, first, times = np.unique(np.stack([ids[o], band[o].astype(np.int64)]), axis=1, return_index=True, return_counts=True)
        stars = np.unique(np.stack([ids[o], hub]), axis=1)
        stars = stars[:, stars[0] != stars[1]]
        kinds = np.repeat(np.arange(4), [pairs.shape[1], key.shape[1], len(weak), stars.shape[1]])
        none = lambda *sizes: [np.zeros(n, np.int64) for n in sizes]
        a, c, d = none(pairs.shape[1], len(weak), stars.shape[1])
        out = pa.RecordBatch.from_arrays([
            pa.array(kinds.astype(np.int32)), pa.array(np.concatenate([pairs[0], key[0], weak, stars[0]])),
            pa.array(np.concatenate([pairs[1], times, c, stars[1]])),
            pa.array(np.concatenate([a, key[1], c, d]).astype(np.int32)),
            pa.array(np.concatenate([a, slack[o][first], c, d]).astype(np.int32))], ["kind", "x", "y", "band", "slack"])
        release()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else [0]
            for lo, hi in zip(cut[:-1], cut[1:]):
                if held and shard[lo] != now:
                    yield runs(held)
                now = shard[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield runs(held)

    return run


# ---- candidates and links ------------------------------------------------------------------------------------------

@F.arrow_udf(T.BooleanType())
def _may_link(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
    return pa.array([may_link(*x) for x in zip(a.to_pylist(), b.to_pylist(), n_a.to_pylist(), n_b.to_pylist())], pa.bool_())


def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct candidate pairs (x, y) that pass the filter."""
    side = lambda k: classes.select(F.col("set_id").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct()
    joined = pairs.join(side("x"), "x").join(side("y"), "y")
    return joined.where(_may_link("s_x", "s_y", "n_x", "n_y")).select("x", "y")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have 100 * intersection >= 75 * union."""
    side = lambda k: sets.select(F.col("set_id").alias(k), F.col("elements").alias(f"e_{k}"))
    both = pairs.join(side("y"), "y").join(side("x"), "x")
    common = F.size(F.array_intersect("e_x", "e_y"))
    return both.where(100 * common >= 75 * (F.size("e_x") + F.size("e_y") - common)).select("x", "y")


def _sets_of(docs: DataFrame, wanted: DataFrame, broadcast_rows: int) -> DataFrame:
    """(set_id, elements) of the wanted classes (set_id, rep): the text of one row with that id and set is read again."""
    wanted = materialize(wanted, "jaccard-wanted")
    small = wanted.count() <= broadcast_rows
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted) if small else wanted, F.col("doc_id") == F.col("rep"))
    read = rows.select("set_id", _read_set("text").alias("s"))
    # Rows that repeat a doc_id with another text are told apart by their set's id.
    same = read.where(F.col("s.id") == F.col("set_id")).select("set_id", F.col("s.elements").alias("elements"))
    return materialize(same.dropDuplicates(["set_id"]), "jaccard-sets")


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Each sketch folded to `size` words (those with fewer are left at zero)."""
    out = np.zeros((len(sketches), size), np.uint64)
    for i, sketch in enumerate(sketches):
        if len(sketch) >= 8 * size:
            out[i] = np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size), axis=0)
    return out


#: Words of a folded sketch that pairs are tested with at once, at most.
FOLDED = 64


def _cross_pairs(neighbours: int | None):
    """(shingle, set_id, component, n_shingles, sketch), a task holding all of a shingle -> pairs of different components
    that pass the filter: all of them, or of each set those with the next so many sets of the shingle, in an order dealt by a hash.

    A pair that several shingles give is tested once a block of PAIRS_AT_ONCE.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        shingle, ids, comp = (table.column(c).to_numpy() for c in ("shingle", "set_id", "component"))
        order = np.lexsort((comp if neighbours is None else mix64((ids ^ shingle).astype(np.uint64)), shingle))
        shingle, comp = shingle[order], comp[order]
        sets, first, member = np.unique(ids[order], return_index=True, return_inverse=True)
        n = table.column("n_shingles").to_numpy()[order][first].astype(np.int64)
        sketches = [x.as_py() for x in table.column("sketch").take(pa.array(order[first]))]
        words = np.minimum([len(x) // 8 for x in sketches], FOLDED)
        folded = {size: _folded(sketches, size) for size in np.unique(words).tolist()}

        def test(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
            key = np.unique(np.minimum(x, y) * len(sets) + np.maximum(x, y))
            x, y = key // len(sets), key % len(sets)
            fit = 4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])
            x, y = x[fit], y[fit]
            near, least = np.zeros(len(x), bool), np.minimum(words[x], words[y])
            for size, rows in folded.items():
                at = np.flatnonzero(least == size)
                for lo in range(0, len(at), (1 << 21) // size):
                    i = at[lo:lo + (1 << 21) // size]
                    near[i] = np.bitwise_count(rows[x[i]] ^ rows[y[i]]).sum(axis=1) <= (n[x[i]] + n[y[i]]) // 7
            some = [(a, b) for a, b in zip(x[near].tolist(), y[near].tolist()) if may_link(sketches[a], sketches[b], int(n[a]), int(n[b]))]
            return pa.RecordBatch.from_arrays([pa.array([int(sets[k]) for k in side], pa.int64()) for side in
                                               (zip(*some) if some else ([], []))], ["x", "y"])

        cut = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1], [True]]))
        last = np.repeat(cut[1:], np.diff(cut))
        if neighbours is not None:
            for k in range(1, neighbours + 1):
                left = np.flatnonzero(np.arange(len(shingle)) + k < last)
                left = left[comp[left] != comp[left + k]]
                for lo in range(0, len(left), PAIRS_AT_ONCE):
                    some = left[lo:lo + PAIRS_AT_ONCE]
                    yield test(member[some], member[some + k])
            return
        # Components stand together: a member's partners are those behind its own component.
        end = np.concatenate([a + np.searchsorted(comp[a:b], comp[a:b], "right") for a, b in zip(cut[:-1], cut[1:])]) if len(shingle) else cut[:0]
        count = last - end
        total = np.cumsum(count)
        lo = 0
        while lo < len(count):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
            c = count[lo:hi]
            if c.any():
                left = np.repeat(np.arange(lo, hi), c)
                right = np.arange(c.sum()) + np.repeat(end[lo:hi] - (np.cumsum(c) - c), c)
                yield test(member[left], member[right])
            lo = hi

    return run


def _across(prefix: DataFrame, classes: DataFrame, label: DataFrame, neighbours: int | None) -> DataFrame:
    """Distinct candidates between components among the sets of one shingle of `prefix`; label: (node, component)."""
    prefix = prefix.join(label.withColumnRenamed("node", "set_id"), "set_id", "left") \
        .withColumn("component", F.coalesce("component", "set_id"))
    mixed = prefix.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle")
    prefix = prefix.join(mixed, "shingle").join(classes.select("set_id", "n_shingles", "sketch"), "set_id") \
        .select("shingle", "set_id", "component", "n_shingles", "sketch")
    return prefix.repartition("shingle").mapInArrow(_cross_pairs(neighbours), "x long, y long").distinct()


def set_links(docs: DataFrame, classes: DataFrame, run_limit: int = RUN, shard_bytes: int = SHARD_BYTES,
              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Links (x, y) between classes of equal sets.  Between classes of one component some links may be left out."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    longest = classes.agg(F.max("n_shingles")).first()[0] or 1
    shards, upper = max(MIN_SHARDS, -(-total // shard_bytes)), bands(longest)
    runs = docs.select("text").mapInArrow(_emit_signatures(upper, shards), _PACKED) \
        .repartitionById(shards, "shard").sortWithinPartitions("shard").mapInArrow(_find_runs(upper, run_limit), _RUNS)
    runs = materialize(runs, "jaccard-runs")
    dense = runs.where("kind = 1").groupBy("x", "band").agg(F.sum("y").alias("n"), F.first("slack").alias("slack")).where("n > slack").select("x")
    dense = materialize(dense.unionByName(runs.where("kind = 2").select("x")).distinct(), "jaccard-dense")
    stars = runs.where("kind = 3").select("x", "y").distinct().join(dense, "x")
    first = materialize(_filtered(runs.where("kind = 0").select("x", "y").unionByName(stars), classes), "jaccard-pairs")

    known = classes.select("set_id", "rep", "n_shingles")
    wanted = first.select(F.explode(F.array("x", "y")).alias("set_id")).unionByName(dense.select(F.col("x").alias("set_id"))).distinct()
    sets = _sets_of(docs, wanted.join(known, "set_id"), broadcast_rows)
    links = materialize(_links(first, sets), "jaccard-links")
    label = connected_components(links, "x", "y", "jaccard-components")

    # Links between dense sets of different components: prefixes of their rarest shingles.
    members = sets.join(dense.select(F.col("x").alias("set_id")), "set_id")
    each = members.select("set_id", F.size("elements").alias("n"), F.explode("elements").alias("shingle"))
    rare = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # Shingles of one set only come first and meet nothing: they take up places of the prefix by their number.
    shared = each.join(rare, "shingle").groupBy("set_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    room = F.col("n") - F.ceil(F.col("n") * 3 / 4) + 1 - (F.col("n") - F.size("shared"))
    prefix = shared.where(room > 0).select("set_id", F.explode(F.slice("shared", F.lit(1), room.cast("int"))).alias("e")) \
        .select("set_id", F.col("e.shingle").alias("shingle"))
    prefix = materialize(prefix, "jaccard-prefix")
    # A few neighbours of each set first: they tie sets that have many links, so that what is left to test is little.
    near = materialize(_links(_across(prefix, classes, label, NEIGHBOURS), sets), "jaccard-near")
    links = links.unionByName(near)
    label = connected_components(links, "x", "y", "jaccard-tied")
    return links.unionByName(_links(_across(prefix, classes, label, None), sets))


def describe(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, set_id) of every row, and (set_id, rep, n_shingles, sketch) of every class, both written."""
    described = materialize(docs.mapInArrow(_describe, _SETS), "jaccard-described")
    classes = described.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    return described.drop("sketch"), materialize(classes, "jaccard-classes")


def _grouped(docs: DataFrame, **limits: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, component_id, component) of every row; NULL ids are NO_ID, empty sets have no component."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    described, classes = describe(docs)
    links = materialize(set_links(docs, classes, **limits), "jaccard-links")
    label = connected_components(links, "x", "y", "jaccard-components").withColumnRenamed("node", "set_id")
    tied = label.join(classes.select("set_id", "rep"), "set_id")
    least = tied.groupBy("component").agg(F.min("rep").alias("component_id"))
    tied = tied.join(least, "component").select("set_id", "component", "component_id")
    of_class = classes.select("set_id", "rep").join(tied, "set_id", "left").select(
        "set_id", F.coalesce("component", "set_id").alias("component"), F.coalesce("component_id", "rep").alias("component_id"))
    alone = described.where("n_shingles = 0").withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return described.where("n_shingles > 0").join(of_class, "set_id").unionByName(alone)


def ngram_groups(docs: DataFrame, **limits: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach), set_id.

    Texts without words (NULL, empty) have no shingles and are linked with nothing.
    Equal sets are linked.  A NULL doc_id counts as the largest, and its component's
    id is NULL only if the component has no other.  Repeated rows are linked with
    each other.  Very long texts are sets like others, in bands of their size.  Other columns are ignored.  An
    empty table gives an empty result.
    """
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return _grouped(docs, **limits).select(real("doc_id"), "n_shingles", real("component_id"), "set_id")


@F.arrow_udf(T.LongType())
def _set_id(text: pa.Array) -> pa.Array:
    out = []
    for lo in range(0, len(text), ROWS_AT_ONCE):
        piece = text[lo:lo + ROWS_AT_ONCE]
        row, value = shingle_sets(piece)
        out.append(_set_ids(row, value, np.bincount(row, minlength=len(piece))))
    release()
    return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))


def keep_one(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, **limits: int) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns; documents without words stay.

    Decisions are (doc_id, set) keys.  Those that go are broadcast when counted to be
    few, else joined by a shuffle; where a key that stays has several rows, one stays.
    """
    columns = docs.columns
    keys = _grouped(docs, **limits).where("n_shingles > 0").groupBy("doc_id", "set_id") \
        .agg(F.first("component").alias("component"), F.first("component_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    stays = keys.where("doc_id = component_id").groupBy("component").agg(F.min("set_id").alias("best"))
    keys = keys.join(stays, "component").select(
        F.col("doc_id").alias("_id"), F.col("set_id").alias("_set"), "n",
        ((F.col("doc_id") == F.col("component_id")) & (F.col("set_id") == F.col("best"))).alias("stays"))
    keys = materialize(keys.where("NOT stays OR n > 1"), "jaccard-losers")
    small = keys.count() <= broadcast_rows
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
                         F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), _set_id("text").alias("set_id"))
    joined = marked.join(F.broadcast(keys) if small else keys, (F.col("doc_id") == F.col("_id")) & (F.col("set_id") == F.col("_set")), "left")
    single = joined.where("stays IS NULL").select("doc")
    repeated = joined.where("stays AND n > 1").groupBy("doc_id", "set_id").agg(F.first("doc").alias("doc")).select("doc")
    return single.unionAll(repeated).select("doc.*")
