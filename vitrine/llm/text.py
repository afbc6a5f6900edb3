"""Columnar text helpers that run inside Arrow tasks.

A *word* is a maximal run of characters other than space and the control
characters 9-13.  All of these are single bytes in UTF-8, so words are found on
the raw byte buffer of an Arrow column, a batch at a time, without creating a
Python string per word.
"""

from __future__ import annotations

import ctypes
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 250          # texts in an Arrow batch
CHUNK = 1 << 20           # bytes hashed at once: bounds the temporaries of a batch
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words that spreads every bit."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix64((b + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_CODES = {False: _byte_codes(False), True: _byte_codes(True)}
_BASE = np.uint64(0xD6E8FEB86659FD93)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lowers the session's number of rows in an Arrow batch: its default of 10,000 is meant for
    narrow rows, and that many texts are held several times over on the way to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def release() -> None:
    """Gives freed memory back to the system: idle Python workers stay alive beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # (the allocator of glibc has it)
    if trim is not None:
        trim(0)


class Words(NamedTuple):
    hash: np.ndarray      # uint64 per word
    start: np.ndarray     # first byte of each word in `data`
    end: np.ndarray       # one past its last byte
    rows: np.ndarray      # words of row r: rows[r] .. rows[r + 1]
    data: np.ndarray      # the batch's bytes


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Byte positions where the buffer may be cut without cutting a word."""
    cuts, at, n = [0], 0, len(data)
    while at < n:
        goal = at + CHUNK
        if goal >= n:
            at = n
        else:
            row = offsets[np.searchsorted(offsets, goal, "right") - 1]
            if row > at:
                at = int(row)
            else:                       # inside one long text: the next separator
                while True:
                    found = np.flatnonzero(_SEPARATOR[data[goal:goal + CHUNK]])
                    end_of_row = int(offsets[np.searchsorted(offsets, goal, "right")])
                    if len(found):
                        at = min(goal + int(found[0]), end_of_row)
                        break
                    goal += CHUNK
                    if goal >= end_of_row:
                        at = end_of_row
                        break
        cuts.append(at)
    return cuts


def words(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """All words of a batch of texts.  ``lower``: hash A-Z as a-z."""
    data, offsets = utf8(column)
    codes = _CODES[lower]
    hashes, starts, ends = [], [], []
    cuts = _cuts(data, offsets)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        piece = data[lo:hi]
        keep = ~_SEPARATOR[piece]
        first = keep.copy()
        first[1:] &= ~keep[:-1]
        inner = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
        first[inner] = keep[inner]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        begin = (np.cumsum(keep, dtype=np.int64) - 1)[at]       # in the bytes that are kept
        size = np.diff(np.append(begin, np.count_nonzero(keep)))
        place = np.arange(size.sum()) - np.repeat(begin, size)
        power = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
        value = codes[piece[keep]] * power[place]
        hashes.append(mix64(np.add.reduceat(value, begin) + size.astype(np.uint64)))
        starts.append(at + lo)
        ends.append(at + lo + size)
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = cat(starts, np.int64)
    return Words(cat(hashes, np.uint64), start, cat(ends, np.int64), np.searchsorted(start, offsets), data)


def word_counts(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The number of words of each text, a chunk at a time."""
    data, offsets = utf8(column)
    out = np.zeros(len(offsets) - 1, np.int64)
    cuts = _cuts(data, offsets)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        keep = ~_SEPARATOR[data[lo:hi]]
        first = keep.copy()
        first[1:] &= ~keep[:-1]
        inner = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
        first[inner] = keep[inner]
        out += np.bincount(np.searchsorted(offsets, np.flatnonzero(first) + lo, "right") - 1, minlength=len(out))
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each place (the last n - 1 places are left out)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out, power = np.zeros(m, np.uint64), np.ones(1, np.uint64)
    for i in range(n):
        power = power * _BASE
        out += hashes[i:i + m] * power
    return mix64(out)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Within it, Arrow batches hold at most `rows` rows; for tables that are written inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
