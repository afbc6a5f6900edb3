"""Two tokenizers aligned: groups of ids between common boundaries, and how often ids meet.

A text's bytes are cut into tokens by A and by B.  Places where tokens of both end cut them into
groups; a token of A and one of B that overlap in bytes are linked.  A pair of ids counts in
how many documents it is linked.

1. *Cuts.*  Both tokenizers start a token at the same words (``tokens.py``), so groups
   and links are made once for each distinct word of a batch, over its bytes in columns.
2. *Postings.*  Documents are numbered in blocks.  For a block, each pair has a compressed bitmap of
   its documents: one plane for each binary digit of the number of links (so 3 links are
   a bit in planes 0 and 1).  A plane is a list of 16-bit places while that is smaller, else
   plain bits.  A batch's postings are merged into the block's; the OR of a pair's planes, popcounted, is its
   number of documents there, and planes popcounted by their weight are its links.
3. *Counts.*  Blocks hold different documents, so a pair's count is the sum over blocks, an
   aggregate with map-side combine over narrow rows; the highest count of each id of A is
   another one.
4. *Scores go back.*  Postings meet their pair's count, are dealt by block, and add
   count * 2^plane to the documents whose bits are set.

A pair in every document has one posting a block, so no key is hot.
Nothing is broadcast; a task holds one block of postings, or the sums of its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.text import batches_of, release
from vitrine.llm.tokens import Vocabulary, after_space, byte_bpe, cuts, encoded, loaded, piece_bytes, pieces, ranges, token_bytes
from vitrine.session import materialize

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Documents of a block; a block also ends at so many (pair, document) entries.
BLOCK_DOCS = 2048
BLOCK_ENTRIES = 1 << 21
BATCH_ROWS = 250
#: Bytes of a plane of plain bits.
PLAIN = BLOCK_DOCS // 8

#: kind 0: a document; 1: the postings of a pair in a block.
_OUT = ("kind int, block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "a long, b long, documents long, links long, planes array<binary>")


# ---- one batch of texts ---------------------------------------------------------------------------------------------

def _token_ends(ids: np.ndarray, start: np.ndarray, size: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The byte behind each token, when cut k begins at byte base[k]."""
    total = np.cumsum(size[ids])
    before = np.concatenate([[0], total])[start[:-1]]
    return total + np.repeat(base - before, np.diff(start))


def _joined(strings: pa.Array, start: np.ndarray, mark: str | bytes) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(start, pa.int64()), strings), pa.scalar(mark, strings.type))


class Aligned:
    """Groups and links of the distinct cuts of a batch; cuts whose ids stand for other bytes are not `good`."""

    def __init__(self, distinct: pa.BinaryArray, a: Vocabulary, b: Vocabulary, bytes_a: pa.Array, bytes_b: pa.Array):
        n = len(distinct)
        (ids_a, start_a), (ids_b, start_b) = encoded(distinct, a), encoded(distinct, b)
        spelt = [_joined(table.take(pa.array(ids)), start, b"") for table, ids, start in ((bytes_a, ids_a, start_a), (bytes_b, ids_b, start_b))]
        plain = distinct.cast(pa.large_binary())
        self.good = pc.and_(pc.equal(spelt[0], plain), pc.equal(spelt[1], plain)).to_numpy(zero_copy_only=False).astype(bool)
        use = self.good
        ids_a, start_a = ids_a[np.repeat(use, np.diff(start_a))], np.concatenate([[0], np.cumsum(np.where(use, np.diff(start_a), 0))])
        ids_b, start_b = ids_b[np.repeat(use, np.diff(start_b))], np.concatenate([[0], np.cumsum(np.where(use, np.diff(start_b), 0))])
        length = np.where(use, pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64), 0)
        base = np.cumsum(length) - length
        end_a, end_b = _token_ends(ids_a, start_a, a.size, base), _token_ends(ids_b, start_b, b.size, base)
        common = np.intersect1d(end_a, end_b)
        of = np.searchsorted(base + length, common)                     # every cut ends in a common boundary
        self.n_a, self.n_b = np.diff(start_a), np.diff(start_b)
        self.n_groups = np.bincount(of, minlength=n)
        from_a = np.concatenate([[0], np.searchsorted(end_a, common, "right")])
        from_b = np.concatenate([[0], np.searchsorted(end_b, common, "right")])
        text = lambda ids: pa.array(ids).cast(pa.large_string())
        groups = pc.binary_join_element_wise(_joined(text(ids_a), from_a, ","), _joined(text(ids_b), from_b, ","), pa.scalar("|", pa.large_string()))
        self.groups = _joined(groups, np.concatenate([[0], np.cumsum(self.n_groups)]), ";")
        # tokens of B that overlap each token of A
        begin_a = end_a - a.size[ids_a]
        first = np.searchsorted(end_b, begin_a, "right")
        last = np.searchsorted(end_b - b.size[ids_b], end_a, "left")
        count = last - first
        pair = np.repeat(ids_a.astype(np.int64), count) << 32 | ids_b[ranges(first, count)].astype(np.int64)
        self.pairs, local = np.unique(pair, return_inverse=True)        # ids of both of each distinct pair
        cut = np.repeat(np.repeat(np.arange(n), self.n_a), count)
        key, times = np.unique(cut * max(1, len(self.pairs)) + local, return_counts=True)
        self.link_cut, self.link_pair, self.link_times = key // max(1, len(self.pairs)), key % max(1, len(self.pairs)), times
        self.n_links = np.bincount(self.link_cut, weights=times, minlength=n).astype(np.int64)
        self.link_start = np.searchsorted(self.link_cut, np.arange(n + 1))


def _entries(al: Aligned, code: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, row, links) of a batch: distinct pairs of each row, their ids packed."""
    n, p = len(al.n_a), max(1, len(al.pairs))
    seen, times = np.unique(row * max(1, n) + code, return_counts=True)
    row, code = seen // max(1, n), seen % max(1, n)
    count = al.link_start[code + 1] - al.link_start[code]
    at = ranges(al.link_start[code], count)
    key = np.repeat(row, count) * p + al.link_pair[at]
    times = np.repeat(times, count) * al.link_times[at]
    key, place = np.unique(key, return_inverse=True)
    total = np.bincount(place, weights=times, minlength=len(key)).astype(np.int64)
    return al.pairs[key % p] if len(key) else key, key // p, total


# ---- postings ------------------------------------------------------------------------------------------------------

def pack_planes(pair: np.ndarray, place: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Distinct entries (pair, place in the block, links) -> (pairs, documents, links, planes) of each pair."""
    order = np.lexsort((place, pair))
    pair, place, links = pair[order], place[order], links[order]
    head = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    which = np.cumsum(np.concatenate([[False], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(links, head) if len(head) else links
    depth = np.frexp(most.astype(np.float64))[1].astype(np.int64)       # binary digits of the most links
    slot0 = np.concatenate([[0], np.cumsum(depth)])
    slots, places = [], []
    for plane in range(int(depth.max(initial=0))):
        on = np.flatnonzero(links >> plane & 1)
        slots.append(slot0[which[on]] + plane)
        places.append(place[on])
    slot, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (slots, places))
    order = np.argsort(slot, kind="stable")                             # places stay ascending within a slot
    slot, place = slot[order], place[order]
    bits = np.bincount(slot, minlength=slot0[-1])
    plain = 2 * bits >= PLAIN
    size = np.where(plain, PLAIN, 2 * bits)
    offset = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(offset[-1] // 2, np.uint16)
    rank = np.arange(len(slot)) - np.repeat(np.cumsum(bits) - bits, bits)
    listed = ~plain[slot]
    data[offset[slot[listed]] // 2 + rank[listed]] = place[listed]
    raw = data.view(np.uint8)
    in_bits = ~listed
    np.bitwise_or.at(raw, offset[slot[in_bits]] + place[in_bits] // 8, (1 << (place[in_bits] & 7)).astype(np.uint8))
    planes = pa.Array.from_buffers(pa.binary(), len(bits), [None, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(raw)])
    planes = pa.ListArray.from_arrays(pa.array(slot0, pa.int32()), planes)
    return pair[head], np.diff(np.append(head, len(pair))), np.add.reduceat(links, head) if len(head) else links, planes


def read_planes(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, plane, place) of every bit of a column of planes."""
    lists = np.asarray(planes.offsets).astype(np.int64)
    row = np.repeat(np.arange(len(planes)), np.diff(lists))
    plane = np.arange(lists[0], lists[-1]) - lists[row]
    held = planes.flatten()
    offset = np.frombuffer(held.buffers()[1], np.int32)[held.offset:held.offset + len(held) + 1].astype(np.int64) \
        if len(held) else np.zeros(1, np.int64)
    raw = np.frombuffer(held.buffers()[2], np.uint8)[offset[0]:offset[-1]] if offset[-1] > offset[0] else np.zeros(0, np.uint8)
    offset = offset - offset[0]
    size = np.diff(offset)
    listed = np.flatnonzero((size != PLAIN) & (size > 0))
    at = ranges(offset[listed], size[listed])
    places = raw[at].view(np.uint16).astype(np.int64)
    slot = np.repeat(listed, size[listed] // 2)
    plain = np.flatnonzero(size == PLAIN)
    if len(plain):
        bits = np.unpackbits(raw[ranges(offset[plain], size[plain])].reshape(len(plain), PLAIN), axis=1, bitorder="little")
        k, place = np.nonzero(bits)
        slot, places = np.concatenate([slot, plain[k]]), np.concatenate([places, place])
    return row[slot], plane[slot], places


def _describe(vocabulary_a: str, vocabulary_b: str, keep_groups: bool, block_entries: int):
    """(doc_id, text) -> _OUT."""
    names = [f.split()[0] for f in _OUT.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())]

    def rows(**given) -> pa.RecordBatch:
        n = len(next(iter(given.values())))
        return pa.RecordBatch.from_arrays([given[c] if isinstance(given.get(c), pa.Array) else pa.array(given[c], k) if c in given
                                           else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_bpe(vocabulary_a, plain_specials=True), pieces(vocabulary_b)
        of_a, model = token_bytes(loaded("tokenizers", vocabulary_a)), loaded("sentencepiece", vocabulary_b)
        bytes_a = pa.array([of_a.get(i, b"") for i in range(len(a.size))], pa.large_binary())
        bytes_b = pa.array([piece_bytes(model, i) for i in range(len(b.size))], pa.large_binary())
        block, docs, entries = TaskContext.get().partitionId() << 40, 0, []

        def posted() -> Iterator[pa.RecordBatch]:
            pair, documents, links, planes = pack_planes(*(np.concatenate([e[k] for e in entries]) for k in range(3)))
            for lo in range(0, len(pair), 50_000):
                cut = slice(lo, lo + 50_000)
                n = len(pair[cut])
                yield rows(kind=np.ones(n, np.int32), block=np.full(n, block), a=pair[cut] >> 32, b=pair[cut] & 0xFFFFFFFF,
                           documents=documents[cut], links=links[cut], planes=planes[cut])

        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(lo, BATCH_ROWS)
                n = piece.num_rows
                if docs + n > BLOCK_DOCS or sum(len(e[0]) for e in entries) > block_entries:
                    yield from posted()
                    block, docs, entries = block + 1, 0, []
                found = cuts(after_space(piece.column("text")))
                al = Aligned(found.distinct, a, b, bytes_a, bytes_b)
                row, code = np.repeat(np.arange(n), np.diff(found.rows)), found.code
                bad = np.bincount(row, weights=~al.good[code], minlength=n) > 0 if len(code) else np.zeros(n, bool)
                row, code = row[~bad[row]], code[~bad[row]]
                count = lambda x: np.bincount(row, weights=x[code], minlength=n).astype(np.int64)  # noqa: E731,B023
                size = np.bincount(row, minlength=n)
                groups = _joined(al.groups.take(pa.array(code)), np.concatenate([[0], np.cumsum(size)]), ";").cast(pa.large_binary())
                groups = ["" if not k else g.decode() if keep_groups else sha256(g).hexdigest() for g, k in zip(groups.to_pylist(), size)]
                yield rows(kind=np.zeros(n, np.int32), block=np.full(n, block), place=np.arange(docs, docs + n), doc_id=piece.column("doc_id"),
                           n_a=count(al.n_a), n_b=count(al.n_b), n_groups=count(al.n_groups), n_links=count(al.n_links), groups=groups)
                pair, at, links = _entries(al, code, row)
                entries.append((pair, at + docs, links))
                docs += n
        if entries:
            yield from posted()
        release()

    return run


_SUMS = "block long, place int, n_best long, count_sum long"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, count, best, planes) -> sums of the documents of each block.  (Sums are exact below 2^53.)"""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        row, plane, place = read_planes(batch.column("planes"))
        blocks, of = np.unique(batch.column("block").to_numpy(), return_inverse=True)
        links = np.ldexp(1.0, plane.astype(np.int32))
        count, best = batch.column("count").to_numpy()[row], batch.column("best").to_numpy(zero_copy_only=False)[row]
        at = of[row] * BLOCK_DOCS + place
        new = np.stack([np.bincount(at, weights=w, minlength=len(blocks) * BLOCK_DOCS).reshape(-1, BLOCK_DOCS) for w in (links * best, links * count)], 1)
        for k, b in enumerate(blocks.tolist()):
            sums[b] = sums[b] + new[k] if b in sums else new[k]
    for b, (best, count) in sums.items():
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b)), pa.array(at.astype(np.int32)), pa.array(best[at].astype(np.int64)),
                                          pa.array(count[at].astype(np.int64))], [f.split()[0] for f in _SUMS.split(", ")])


def described(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, keep_groups: bool = True,
              block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Documents and postings, written once."""
    rows = docs.selectExpr("cast(doc_id as long) AS doc_id", "text")
    with batches_of(docs.sparkSession, BATCH_ROWS):
        return materialize(rows.mapInArrow(_describe(vocabulary_a, vocabulary_b, keep_groups, block_entries), _OUT), "alignment")


def pair_counts(both: DataFrame) -> DataFrame:
    """(a, b, documents, links, best): pairs of ids over the corpus; best: no pair of the same id of A is in more documents."""
    pairs = both.where("kind = 1").groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    most = pairs.groupBy("a").agg(F.max("documents").alias("most"))
    return pairs.join(most, "a").select("a", "b", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def align(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, keep_groups: bool = True,
          block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (ids, or with
    ``keep_groups`` False their SHA-256).

    NULL and empty texts have no tokens, and neither have texts whose joined tokens of A or B are not a
    space and the text (one with U+2581, say, which B writes for a space): zeros, and empty groups.  Strings of special
    tokens are ordinary text.  Very long texts are read whole.  Rows that repeat, or have the same
    or no doc_id, are documents of their own and count each.  Ties: every pair with the highest count is best.
    Other columns are ignored.  An empty table gives an empty result.
    """
    both = described(docs, vocabulary_a, vocabulary_b, keep_groups, block_entries)
    pairs = materialize(pair_counts(both).select("a", "b", F.col("documents").alias("count"), "best"), "alignment-pairs")
    postings = both.where("kind = 1").select("block", "a", "b", "planes").join(pairs, ["a", "b"])
    sums = postings.select("block", "count", "best", "planes").repartition("block").mapInArrow(_add_up, _SUMS)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = both.where("kind = 0").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return rows.join(sums, ["block", "place"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")
