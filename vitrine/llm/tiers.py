"""Hierarchical packing into several context sizes.

Tiers are window sizes, powers of two up to the longest window.  Windows are of the next power of two or
exactly full, so they hold no padding.

1. *Route.*  A document's ids are cut into full longest windows, and what remains goes to
   the smallest tier that holds it.
2. *Pack each tier*, from the longest: the longest piece of the tier opens a window.
3. *Fill gaps from shorter tiers.*  The longest piece that fits the gap goes in, again and
   again.  Where none fits, the shortest of all is cut: its head fills the gap, and its
   rest is routed anew.
4. *The rest.*  When a lot's pieces run out, its last window is less than full.  It is cut at
   powers of two, the largest first, so it needs no padding either.
5. *Step groups.*  The lot's windows, longest first, are each dealt to the group with the
   fewest tokens so far, so steps are level in tokens and have the same mix of sizes.

A lot is a run of documents of one partition with about ``lot_tokens`` ids, so the whole is
a map: no shuffle, no hot key, and a task holds one lot.  Nothing is dropped or padded.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapreplace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vitrine.llm.text import release, small_batches
from vitrine.llm.tokens import byte_bpe, read_ids

WINDOW = 1024
#: Window sizes that documents are routed to.
TIERS = (128, 256, 512, 1024)
END_ID = 0
LOT_TOKENS = 1 << 21
#: Ids of one training step.
STEP_TOKENS = 1 << 16
VOCABULARY = "byte_bpe_50k.json"
BATCH_ROWS = 1000
OUT_ROWS = 2000

_OUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window int, step_group long"


class _Pieces:
    """Pieces by length, the lengths in use as the bits of a number, so the longest that
    fits and the next longer one are found at once."""

    def __init__(self):
        self.of: dict[int, list[tuple[int, int]]] = {}
        self.used = 0

    def put(self, length: int, piece: tuple[int, int]) -> None:
        self.of.setdefault(length, []).append(piece)
        self.used |= 1 << length

    def take(self, length: int) -> tuple[int, int]:
        held = self.of[length]
        piece = held.pop()
        if not held:
            self.used &= ~(1 << length)
        return piece

    def longest(self, most: int) -> int:
        """The longest length in use up to `most`, or 0."""
        return max(0, (self.used & ((2 << most) - 1)).bit_length() - 1)

    def shortest(self) -> int:
        return (self.used & -self.used).bit_length() - 1


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows of (size, [(document, start, length), ...]) that hold every id of documents of these lengths once."""
    tiers = tuple(sorted(tiers))
    window, out, pieces = tiers[-1], [], _Pieces()
    for d, n in enumerate(lengths):
        full = n - n % window
        out += [(window, [(d, at, window)]) for at in range(0, full, window)]
        if n > full:
            pieces.put(n - full, (d, full))
    for tier, shorter in zip(reversed(tiers), [*reversed(tiers[:-1]), 0]):
        while (length := pieces.longest(tier)) > shorter:
            held, gap = [(*pieces.take(length), length)], tier - length
            while gap:
                fit = pieces.longest(gap)
                if fit:
                    held.append((*pieces.take(fit), fit))
                    gap -= fit
                elif pieces.used:
                    whole = pieces.shortest()
                    d, at = pieces.take(whole)
                    held.append((d, at, gap))
                    pieces.put(whole - gap, (d, at + gap))
                    gap = 0
                else:
                    break
            out += [(tier, held)] if not gap else _at_powers(held)
    return out


def _at_powers(held: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """A window that is not full, cut into windows of powers of two."""
    left, out, queue = sum(p[2] for p in held), [], held[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        room, own = size, []
        while room:
            d, at, n = queue.pop()
            own.append((d, at, min(n, room)))
            if n > room:
                queue.append((d, at + room, n - room))
            room -= min(n, room)
        out.append((size, own))
        left -= size
    return out


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """The group of each window: the longest first, each to the group with the fewest ids."""
    groups = max(1, round(sum(sizes) / step_tokens))
    loads, out = [(0, g) for g in range(groups)], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        load, out[k] = loads[0]
        heapreplace(loads, (load + sizes[k], out[k]))
    return out


def _pack_lots(tiers: tuple[int, ...], end_id: int, lot_tokens: int, step_tokens: int, vocabulary: str):
    names = [f.split()[0] for f in _OUT.split(", ")]

    def lot(ids: list[np.ndarray], docs: list, first_sequence: int, first_group: int) -> Iterator[tuple[list[tuple], int, int]]:
        """Rows of a lot, some at a time, and how many windows and groups there are."""
        windows = pack([len(i) for i in ids], tiers)
        group = step_groups([size for size, _ in windows], step_tokens)
        count, rows = (len(windows), max(group, default=-1) + 1), []
        for k, (size, held) in enumerate(windows):
            offset = 0
            for d, at, n in held:
                rows.append((docs[d], at, n, ids[d][at:at + n].tobytes(), len(ids[d]), first_sequence + k, offset, size, first_group + group[k]))
                offset += n
            if len(rows) >= OUT_ROWS:
                yield rows, *count
                rows = []
        yield rows, *count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        bpe = byte_bpe(vocabulary, plain_specials=False)
        sequence = group = TaskContext.get().partitionId() << 40
        ids, docs, held = [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group, held
            windows = groups = 0
            for rows, windows, groups in lot(ids, docs, sequence, group):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names)
            sequence, group, held = sequence + windows, group + groups, 0
            ids.clear()
            docs.clear()

        for batch in batches:
            flat, at = read_ids(batch.column("text"), bpe)
            for doc_id, lo, hi in zip(batch.column("doc_id").to_pylist(), at[:-1], at[1:]):
                ids.append(np.append(flat[lo:hi], np.uint32(end_id)).astype("<u4"))
                docs.append(doc_id)
                held += len(ids[-1])
                if held >= lot_tokens:
                    yield from close()
        yield from close()
        release()

    return run


def tiered_packing(docs: DataFrame, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, lot_tokens: int = LOT_TOKENS,
                   step_tokens: int = STEP_TOKENS, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (32-bit, little-endian), doc_tokens, sequence_id, offset, window, step_group.

    A document is its text's ids and then ``end_id``, so NULL and empty texts are one id.
    Very long texts fill longest windows of their own and one remainder.  Rows that repeat,
    or have the same or no doc_id, are documents of their own, each with pieces that cover it.
    Equal lengths are placed in an order that is fixed by the table's partitions.  Other columns are
    ignored.  An empty table gives an empty result.
    """
    if any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError(f"tiers must be powers of two: {tiers}")
    small_batches(docs.sparkSession, BATCH_ROWS)
    rows = docs.selectExpr("cast(doc_id as long) AS doc_id", "text")
    return rows.mapInArrow(_pack_lots(tuple(tiers), end_id, lot_tokens, step_tokens, vocabulary), _OUT)
