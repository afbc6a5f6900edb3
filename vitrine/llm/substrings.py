"""Substring deduplication with suffix automata of reference shards.

A window is ``length`` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller doc_id.

The automata of all references cannot be broadcast: they grow with the corpus.
So references and the documents that may match them are brought together instead,
in shards that are cut by content:

1. Each window has a *minimizer*, the smallest of the hashes of its ``SEED``-word
   grams.  Equal windows have equal minimizers, and neighbouring windows mostly
   share theirs.  A shuffle of the minimizers, packed and combined in each task,
   finds those that occur in two documents; most do not, and their windows are
   done with.
2. Windows with a repeated minimizer are sent, as spans of word codes, to the
   shard of that minimizer.  Within a task equal spans are combined: only the
   smallest doc_id has to be sent, the others are known to be removed.  So a passage
   that a third of all documents share costs one span a task.
3. A shard goes through the spans of a minimizer in order of doc_id: each is
   streamed through the suffix automaton of the spans before it.  The matching
   statistics give, for every place, the longest match; where it has ``length`` words
   or more, the state's first owner tells whether a smaller document has the window.
   Then the span is added to the automaton.  (Where all spans of a minimizer are
   equal, the smallest doc_id owns them all; spans without a window in common with
   another are left out.)
4. The places come back to their documents, and the words are removed.

Texts are shuffled once, by a hash of the row; steps 2 and 4 read the same exchange.
Nothing is broadcast, and the only groups are spans of one minimizer after combining.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.text import Words, grams, mix64, words

LENGTH = 13
SEED = 5
#: Text that one shard of minimizers is made for.
SHARD_BYTES = 48 << 20
MIN_SHARDS = 16
ROWS_AT_ONCE = 1000
SPANS_AT_ONCE = 50_000
NO_ID = 2 ** 63 - 1          # NULL doc_ids count as the largest
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _row_of(w: Words) -> np.ndarray:
    return np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))


def window_minimizers(w: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, minimizer, place of the minimizer) of every window within one row, in order.

    Minimizers are even: the lowest bit is free for a mark.
    """
    n = len(w.hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = _row_of(w)
    start = np.flatnonzero(row[:n] == row[length - 1:])
    g = grams(w.hash, seed)
    best, place = g[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, length - seed + 1):
        x = g[j:j + n]
        less = x < best
        best[less] = x[less]
        place[less] = j
    return start, best[start] & ~np.uint64(1), start + place[start]


def _spans(start: np.ndarray, key: np.ndarray, place: np.ndarray, row: np.ndarray, length: int):
    """Runs of consecutive windows with one minimizer at one place: (row, key, first word, words)."""
    if not len(start):
        return row[:0], key, start, start
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1) | (row[start[1:]] != row[start[:-1]])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(start))) + length - 1
    return row[start[head]], key[head], start[head], size


def _expand(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + size[i], one run after the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _content(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each run of codes."""
    out, at = np.zeros(len(size), np.uint64), np.concatenate([[0], np.cumsum(size)])
    for lo in range(0, len(size), SPANS_AT_ONCE):
        n = size[lo:lo + SPANS_AT_ONCE]
        begin = at[lo:lo + len(n)] - at[lo]
        power = np.cumprod(np.full(int(n.max()), _STEP, np.uint64))
        value = mix64(codes[at[lo]:at[lo + len(n)]].astype(np.uint64) + np.uint64(1))
        value *= power[np.arange(len(value)) - np.repeat(begin, n)]
        out[lo:lo + len(n)] = mix64(np.add.reduceat(value, begin) + n.astype(np.uint64))
    return out


def _pack(kind: np.dtype | type, values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _unpack(kind: type, column: pa.Array) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


# ---- 1. repeated minimizers ----------------------------------------------------------------------------------------

_SEEN = "shard int, row_key binary, n binary, minimizer binary, found_key binary, found binary"
_FOUND = "row_key long, found binary"


def _seen_minimizers(length: int, seed: int, shards: int):
    """(row_key, text) -> packed (row, minimizer) records for each shard, a minimizer once a task's batch.

    Rows of a minimizer that two rows of the batch have are known at once; they go to `found`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            w = words(batch.column("text"))
            keys = batch.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64)
            start, key, _ = window_minimizers(w, length, seed)
            row = keys[_row_of(w)[start]] if len(start) else np.zeros(0, np.int64)
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            key, row = key[new], row[new]                         # distinct (minimizer, row)
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.append(head, len(key)))
            many = size > 1
            here = np.repeat(many, size)
            back = _shard_of_row(row[here], shards)
            found_row, found = row[here], key[here]
            row, key = row[head], key[head] | many.astype(np.uint64)
            shard = _shard_of_key(key, shards)
            order = np.lexsort((row, shard))                      # a row's minimizers stand together: its key is sent once
            row, key, shard = row[order], key[order], shard[order]
            cut = np.searchsorted(shard, np.arange(shards + 1))
            out = []
            for s in range(shards):
                a, b = slice(cut[s], cut[s + 1]), back == s
                if cut[s] < cut[s + 1] or b.any():
                    rows, n = np.unique(row[a], return_counts=True)
                    out.append((s, _pack(np.int64, rows), _pack(np.uint32, n), _pack(np.uint64, key[a]),
                                _pack(np.int64, found_row[b]), _pack(np.uint64, found[b])))
            yield _batch(out, _SEEN)

    return run


def _shard_of_key(key: np.ndarray, shards: int) -> np.ndarray:
    return (key >> np.uint64(1)).astype(np.int64) % shards


def _shard_of_row(row: np.ndarray, shards: int) -> np.ndarray:
    return (row.astype(np.int64) >> 1) % shards


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(lo, ROWS_AT_ONCE)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A task's rows, one shard at a time."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    shard = table.column("shard").to_numpy()
    for s in np.unique(shard):
        yield table.filter(pa.array(shard == s))


def _repeated_minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed records of shards -> for each row its minimizers that another row has too."""
    for table in _by_shard(batches):
        row = np.repeat(_unpack(np.int64, table.column("row_key")), _unpack(np.uint32, table.column("n")))
        key = _unpack(np.uint64, table.column("minimizer"))
        many, key = (key & np.uint64(1)).astype(bool), key & ~np.uint64(1)
        order = np.lexsort((row, key))
        row, key, many = row[order], key[order], many[order]
        if len(key):
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(head, len(key)))
            several = row[head] != row[np.append(head[1:], len(key)) - 1]
            keep = np.repeat(several | np.logical_or.reduceat(many, head), size) & ~many
            row, key = row[keep], key[keep]
        row = np.concatenate([row, _unpack(np.int64, table.column("found_key"))])
        key = np.concatenate([key, _unpack(np.uint64, table.column("found"))])
        order = np.argsort(row, kind="stable")
        row, key = row[order], key[order]
        yield _packed_by_row(row, key, np.uint64, _FOUND)


def _packed_by_row(row: np.ndarray, value: np.ndarray, kind: type, schema: str) -> pa.RecordBatch:
    """(row, packed values); `row` is in order."""
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    cut = np.append(head, len(row)) * np.dtype(kind).itemsize
    data = pa.py_buffer(np.ascontiguousarray(value, kind).tobytes())
    packed = pa.Array.from_buffers(pa.large_binary(), len(head), [None, pa.py_buffer(cut.astype(np.int64).tobytes()), data])
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(row[head]), packed.cast(pa.binary())], names)


# ---- 2. spans ------------------------------------------------------------------------------------------------------

_ROUTED = ("shard int, doc_id binary, row_key binary, n binary, minimizer binary, start binary, size binary, codes binary, "
           "done_key binary, done binary")
_COVERED = "row_key long, covered binary"


def size_kind(length: int, seed: int) -> type:
    """Of the number of words of a span: 2 * length - seed at most."""
    return np.uint8 if 2 * length - seed < 256 else np.uint16


def _candidate_spans(length: int, seed: int, shards: int):
    """(doc_id, row_key, text, found) -> packed spans for each shard, and windows already known to be covered (`done`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            w = words(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "row_key"))
            row = _row_of(w)
            start, key, place = window_minimizers(w, length, seed)
            salt = mix64(np.arange(len(ids), dtype=np.uint64))
            parts = [(np.frombuffer(b.as_buffer(), np.uint64) ^ salt[i]) for i, found in enumerate(batch.column("found"))
                     for b in found.values]
            wanted = np.isin(key ^ salt[row[start]], np.concatenate(parts)) if parts and len(start) else np.zeros(len(start), bool)
            row_, key, start, size = _spans(start[wanted], key[wanted], place[wanted], row, length)
            code = (w.hash >> np.uint64(32)).astype(np.uint32)
            content = _content(code[_expand(start, size)], size) ^ key
            # Of equal spans of a row one is enough: the others are found by their windows at the end.
            order = np.lexsort((start, row_, content))
            same = np.zeros(len(order), bool)
            same[1:] = (content[order][1:] == content[order][:-1]) & (row_[order][1:] == row_[order][:-1])
            order = order[~same]
            row_, key, start, size, content = row_[order], key[order], start[order], size[order], content[order]
            # Of equal spans of several documents only those of the smallest doc_id are open.
            known = np.zeros(len(content), bool)
            if len(content):
                head = np.flatnonzero(np.concatenate([[True], content[1:] != content[:-1]]))
                least = np.minimum.reduceat(ids[row_], head)
                known = ids[row_] > np.repeat(least, np.diff(np.append(head, len(content))))
            relative = start - w.rows[row_]
            count = size[known] - length + 1
            done_row = np.repeat(keys[row_[known]], count)
            done = _expand(relative[known], count)
            go = np.flatnonzero(~known)
            go = go[np.argsort(row_[go], kind="stable")]
            shard, back = _shard_of_key(key[go], shards), _shard_of_row(done_row, shards)
            out = []
            for s in np.union1d(shard, back).tolist():
                a, b = go[shard == s], back == s
                rows, n = np.unique(row_[a], return_counts=True)
                out.append((s, _pack(np.int64, ids[rows]), _pack(np.int64, keys[rows]), _pack(np.uint32, n), _pack(np.uint32, key[a] >> np.uint64(32)),
                            _pack(np.uint32, relative[a]), _pack(size_kind(length, seed), size[a]), _pack(np.uint32, code[_expand(start[a], size[a])]),
                            _pack(np.int64, done_row[b]), _pack(np.uint32, done[b])))
            yield _batch(out, _ROUTED)

    return run


# ---- 3. matching statistics ----------------------------------------------------------------------------------------

class SuffixAutomaton:
    """Suffix automaton of several sequences; each state knows the owner of its first occurrence."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.owner: list[int | None] = [None]

    def _state(self, length: int, owner: int | None) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q for its substrings of up to length[p] + 1; it takes q's place below p."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1, self.owner[q])
        nxt[copy], link[copy], link[q] = nxt[q].copy(), link[q], copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def add(self, sequence: list[int], owner: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:                 # the prefix is known already
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            new, p = self._state(length[last] + 1, owner), last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new

    def owners(self, sequence: list[int], window: int) -> list[int | None]:
        """First owner of each window of the sequence, None where it does not occur."""
        nxt, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for i, c in enumerate(sequence):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            if i >= window - 1:
                if matched < window:
                    out.append(None)
                else:
                    at = state
                    while length[link[at]] >= window:
                        at = link[at]
                    out.append(self.owner[at])
        return out


def _shared_windows(codes: np.ndarray, size: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For each span, whether a window of it is in another span of its group too (by hash: never missed)."""
    h = mix64(codes.astype(np.uint64) + np.uint64(1))
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(len(size), bool)
    g = grams(h, length)
    span = np.repeat(np.arange(len(size)), size)
    inside = np.flatnonzero(span[:n] == span[length - 1:])
    of, value = span[inside], g[inside] ^ mix64(group[span[inside]].astype(np.uint64))
    order = np.lexsort((of, value))
    of, value = of[order], value[order]
    twin = np.zeros(len(value), bool)
    differ = (value[1:] == value[:-1]) & (of[1:] != of[:-1])
    twin[1:] |= differ
    twin[:-1] |= differ
    out = np.zeros(len(size), bool)
    out[of[twin]] = True
    return out


def _match_spans(length: int, seed: int):
    """Packed spans of shards -> for each row the first words of its covered windows.

    Half a minimizer is enough here: where two agree in it, their spans share an automaton.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_shard(batches):
            get = lambda c, kind: _unpack(kind, table.column(c))
            n = get("n", np.uint32)
            ids, rows = np.repeat(get("doc_id", np.int64), n), np.repeat(get("row_key", np.int64), n)
            key, start, size = get("minimizer", np.uint32), get("start", np.uint32).astype(np.int64), get("size", size_kind(length, seed)).astype(np.int64)
            codes = get("codes", np.uint32)
            at = np.cumsum(size) - size
            content = _content(codes, size)
            order = np.lexsort((rows, ids, content, key))
            # One class of spans for each (minimizer, content); its first span has the smallest doc_id.
            k, c = key[order], content[order]
            head = np.ones(len(order), bool)
            head[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
            klass = np.cumsum(head) - 1
            first = order[head]
            covered_row, covered = [get("done_key", np.int64)], [get("done", np.uint32).astype(np.int64)]

            later = ids[order] > ids[first][klass]                # a smaller document has the same span
            i = order[later]
            count = size[i] - length + 1
            covered_row.append(np.repeat(rows[i], count))
            covered.append(_expand(start[i], count))

            # The classes' first spans, and repeated doc_ids among them, go through the automaton of their minimizer.
            group = np.cumsum(np.concatenate([[True], key[first][1:] != key[first][:-1]])) if len(first) else np.zeros(0, np.int64)
            several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
            open_ = np.flatnonzero(several)
            where = _expand(at[first[open_]], size[first[open_]])
            open_ = open_[_shared_windows(codes[where], size[first[open_]], group[open_], length)] if len(open_) else open_
            open_ = open_[np.lexsort((ids[first[open_]], group[open_]))]
            members = np.flatnonzero(~later)
            members_at = np.searchsorted(klass[members], np.arange(len(first) + 1))
            hit_row: list[int] = []
            hit: list[int] = []
            automaton, current = SuffixAutomaton(), -1
            for x in open_.tolist():
                f = int(first[x])
                if group[x] != current:
                    automaton, current = SuffixAutomaton(), group[x]
                sequence, owner = codes[at[f]:at[f] + size[f]].tolist(), int(ids[f])
                found = [j for j, o in enumerate(automaton.owners(sequence, length)) if o is not None and o < owner]
                if found:
                    for m in members[members_at[x]:members_at[x + 1]].tolist():
                        i = int(order[m])
                        hit_row += [int(rows[i])] * len(found)
                        hit += [int(start[i]) + j for j in found]
                automaton.add(sequence, owner)
            covered_row.append(np.array(hit_row, np.int64))
            covered.append(np.array(hit, np.int64))
            row, word = np.concatenate(covered_row), np.concatenate(covered)
            order = np.argsort(row, kind="stable")
            yield _packed_by_row(row[order], word[order], np.uint32, _COVERED)

    return run


# ---- 4. removal ----------------------------------------------------------------------------------------------------

_RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"


def _remove(length: int):
    """(doc_id, text, covered) -> counts, the text that is kept, and the removed runs of words."""
    removed_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            n_words, n_removed, kept, removed = [], [], [], []
            touched = np.flatnonzero(batch.column("covered").is_valid().to_numpy(zero_copy_only=False))
            some = batch.take(pa.array(touched))
            w = words(some.column("text"))
            data = w.data.tobytes()
            gone: dict[int, np.ndarray] = {}
            row = _row_of(w)
            if len(touched):
                n = max(0, len(w.hash) - length + 1)
                g = grams(w.hash, length) ^ mix64(row[:n].astype(np.uint64))
                inside = row[:n] == row[len(row) - n:]
                places = np.concatenate([w.rows[i] + _unpack(np.uint32, x.values).astype(np.int64)
                                         for i, x in enumerate(some.column("covered"))])
                hit = np.isin(g, g[places]) & inside                        # equal windows of a row go alike
                change = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(change, np.flatnonzero(hit), 1)
                np.add.at(change, np.flatnonzero(hit) + length, -1)
                off = np.cumsum(change[:-1]) > 0
                gone = {int(t): off[w.rows[i]:w.rows[i + 1]] for i, t in enumerate(touched)}
                place = {int(t): i for i, t in enumerate(touched)}
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for r, text in enumerate(texts):
                if r not in gone:
                    parts = (text or b"").split()               # bytes: splits at space and the controls 9-13 only
                    n_words.append(len(parts))
                    n_removed.append(0)
                    removed.append([])
                else:
                    i, off = place[r], gone[r]
                    a, b = w.start[w.rows[i]:w.rows[i + 1]], w.end[w.rows[i]:w.rows[i + 1]]
                    n_words.append(len(off))
                    n_removed.append(int(off.sum()))
                    parts = [data[x:y] for x, y in zip(a[~off].tolist(), b[~off].tolist())]
                    edge = np.flatnonzero(np.diff(off.astype(np.int8), prepend=0, append=0))
                    removed.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
                kept.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, removed_type)],
                ["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (words joined by one space), removed (runs of words).

    NULL and empty texts have no words.  Documents with fewer than ``length`` words
    lose none.  Rows with one doc_id do not remove each other's words.  An empty
    table gives an empty result.
    """
    if not seed <= length <= 200:
        raise ValueError("length must be from seed to 200 words")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")) \
        .select("id", F.coalesce("id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("id", "text").alias("row_key"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(MIN_SHARDS, -(-total // shard_bytes))
    seen = rows.select("row_key", "text").mapInArrow(_seen_minimizers(length, seed, shards), _SEEN)
    found = seen.repartition(shards, "shard").mapInArrow(_repeated_minimizers, _FOUND) \
        .groupBy("row_key").agg(F.collect_list("found").alias("found"))
    placed = rows.repartition("row_key")
    routed = placed.join(found.hint("shuffle_hash"), "row_key").select("doc_id", "row_key", "text", "found") \
        .mapInArrow(_candidate_spans(length, seed, shards), _ROUTED)
    covered = routed.repartition(shards, "shard").mapInArrow(_match_spans(length, seed), _COVERED) \
        .groupBy("row_key").agg(F.collect_list("covered").alias("covered"))
    joined = placed.join(covered.hint("shuffle_hash"), "row_key", "left").select(F.col("id").alias("doc_id"), "text", "covered")
    return joined.mapInArrow(_remove(length), _RESULT)
