"""Token ids of Arrow columns of texts, each distinct word of a batch encoded once.

A text is cut before every single space between two characters that are no white
space.  Both public tokenizers start a token there whatever stands around it (the byte-level one
splits by a pattern in which a space begins the next word, the pieces of the other
hold a space at their start only), so the ids of a text are those of its
cuts, one after the other.  Cuts repeat, so Arrow's dictionary finds the distinct ones of a
batch.  Those that begin and end with ASCII characters are encoded in one string
and their ids dealt out by the bytes they stand for; all others one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vitrine.llm.text import utf8


class Cuts(NamedTuple):
    code: np.ndarray          # which distinct cut, for every cut of the batch
    rows: np.ndarray          # cuts of row r: rows[r] .. rows[r + 1]
    distinct: pa.BinaryArray


def _solid_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before `at` is known to be no white space."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    return ((one > 32) & (one < 127)) | ((one > 127) & (two >= 0xC3) & (two <= 0xDF)) \
        | ((one > 127) & (two > 127) & (two < 0xC0) & ((three == 0xE0) | ((three >= 0xE4) & (three <= 0xEF))))


def _solid_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    first = data[np.minimum(at, len(data) - 1)]
    return ((first > 32) & (first < 127)) | ((first >= 0xC3) & (first <= 0xE0)) | ((first >= 0xE4) & (first <= 0xF4))


def cuts(column: pa.Array | pa.ChunkedArray) -> Cuts:
    data, offsets = utf8(column)
    space = np.flatnonzero(data == 32)
    row = np.searchsorted(offsets, space, "right") - 1
    inner = (space - 1 >= offsets[row]) & (space + 1 < offsets[row + 1])
    space = space[inner]
    space = space[_solid_before(data, space) & _solid_at(data, space + 1)]
    heads = offsets[:-1][np.diff(offsets) > 0]
    start = np.sort(np.concatenate([heads, space]))
    if not len(start):
        return Cuts(np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), pa.array([], pa.binary()))
    ends = np.append(start, len(data)).astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    coded = every.dictionary_encode()
    return Cuts(coded.indices.to_numpy().astype(np.int64), np.searchsorted(start, offsets), coded.dictionary)


def after_space(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Each text behind one space; NULL counts as empty and stays without."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    put = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string()))
    return pc.if_else(pc.equal(pc.binary_length(column), 0), pa.scalar("", pa.large_string()), put)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def loaded(kind: str, vocabulary: str):
    """A public tokenizer: `vocabulary` is a path, or the name of one of the installed files.

    It is kept with its library's module, which a worker that is used again still has.
    """
    if kind == "tokenizers":
        import tokenizers as library
    else:
        import sentencepiece as library
    kept = library.__dict__.setdefault("_vitrine_loaded", {})
    if vocabulary not in kept:
        import public_tokenizers
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        kept[vocabulary] = library.Tokenizer.from_file(path) if kind == "tokenizers" else library.SentencePieceProcessor(model_file=path)
    return kept[vocabulary]


class Vocabulary(NamedTuple):
    #: Ids of one text in which joined cuts stand, and of a list of cuts.
    joined: Callable[[str], np.ndarray]
    alone: Callable[[list[bytes]], list[list[int]]]
    #: Bytes of text that each id stands for.
    size: np.ndarray
    #: Bytes joined at once.
    at_once: int


def token_bytes(tokenizer) -> dict[int, bytes]:
    """What the ids of a byte-level tokenizer stand for.

    Its alphabet writes each byte as one character: printable ones of Latin-1 as themselves, the others, in order, from U+0100.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    return {i: bytes(map(of.__getitem__, t)) for t, i in tokenizer.get_vocab().items() if i not in added} | added


def byte_bpe(vocabulary: str, plain_specials: bool) -> Vocabulary:
    """Byte-level BPE; `plain_specials`: strings of special tokens in a text are ordinary text.

    Joined cuts are plain ASCII or Latin text without a special token, for which the rank
    encoder of the same vocabulary gives the same ids several times faster.
    """
    import public_tokenizers
    import tiktoken

    tokenizer = loaded("tokenizers", vocabulary)
    kept = tiktoken.__dict__.setdefault("_vitrine_loaded", {})
    if vocabulary not in kept:
        of = token_bytes(tokenizer)
        special = tokenizer.get_added_tokens_decoder()
        ranks = {b: i for i, b in of.items() if i not in special}
        kept[vocabulary] = (tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}),
                            np.array([len(of.get(i, b"")) for i in range(max(of) + 1)], np.int64))
    ranked, size = kept[vocabulary]

    def alone(texts: list[bytes]) -> list[list[int]]:
        before, tokenizer.encode_special_tokens = tokenizer.encode_special_tokens, plain_specials
        try:
            return [e.ids for e in tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        finally:
            tokenizer.encode_special_tokens = before

    return Vocabulary(lambda text: ranked.encode_to_numpy(text, disallowed_special=()), alone, size, 1 << 18)


def pieces(vocabulary: str) -> Vocabulary:
    """Sentence pieces of texts that begin with a space, which the model itself puts there."""
    model = loaded("sentencepiece", vocabulary)
    size = [1 if model.is_byte(i) else len(piece_bytes(model, i)) for i in range(model.get_piece_size())]
    return Vocabulary(lambda text: np.array(model.encode(text[1:]), np.uint32),
                      lambda texts: model.encode([t[1:].decode() for t in texts], num_threads=1), np.array(size, np.int64), 1 << 14)


def piece_bytes(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("\u2581", " ").encode()


def _join(distinct: pa.BinaryArray) -> np.ndarray:
    """Cuts at whose ends a token starts also where other such cuts stand beside them, and that hold Latin text only."""
    offsets = np.asarray(distinct.buffers()[1]).view(np.int32)[distinct.offset:distinct.offset + len(distinct) + 1].astype(np.int64)
    data = np.frombuffer(distinct.buffers()[2], np.uint8)
    size = np.diff(offsets)
    at = lambda place: data[np.clip(place, 0, len(data) - 1)]
    graphic = lambda x: (x > 32) & (x < 127)
    good = (size > 1) & (at(offsets[:-1]) == 32) & graphic(at(offsets[:-1] + 1)) & graphic(at(offsets[1:] - 1))
    odd = data >= 0xD0
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    places = np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1
    good[places[(places >= 0) & (places < len(good))]] = False
    return good


def encoded(distinct: pa.BinaryArray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, start): those of distinct cut k are ids[start[k]:start[k + 1]]."""
    count = np.zeros(len(distinct), np.int64)
    if not len(distinct):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    join = _join(distinct)
    inside, parts = np.flatnonzero(join), []
    strings = distinct.filter(pa.array(join))
    ends = np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False)) if len(strings) else np.zeros(0, np.int64)
    text = utf8(strings)[0].tobytes()
    lo, failed = 0, []
    while lo < len(inside):
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + vocabulary.at_once, "right")))
        ids = vocabulary.joined(text[base:ends[hi - 1]].decode()).astype(np.uint32)
        upto, want = np.cumsum(vocabulary.size[ids]), ends[lo:hi] - base
        place = np.searchsorted(upto, want)
        if len(upto) and upto[-1] == want[-1] and (upto[place] == want).all():
            parts.append((inside[lo:hi], ids))
            count[inside[lo:hi]] = np.diff(np.concatenate([[-1], place]))
        else:                                       # ids that stand for other bytes
            failed.append(inside[lo:hi])
        lo = hi
    rest = np.concatenate([np.flatnonzero(~join), *failed]).astype(np.int64)
    if len(rest):
        found = vocabulary.alone(distinct.take(pa.array(rest)).to_pylist())
        count[rest] = [len(f) for f in found]
        parts.append((rest, np.array([i for f in found for i in f], np.uint32)))
    of = np.concatenate([p[0] for p in parts])
    flat = np.concatenate([p[1] for p in parts])
    held = np.zeros(len(distinct), np.int64)
    held[of] = np.cumsum(count[of]) - count[of]
    return flat[ranges(held, count)], np.concatenate([[0], np.cumsum(count)])


def read_ids(column: pa.Array | pa.ChunkedArray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): those of row r are ids[offsets[r]:offsets[r + 1]]."""
    found = cuts(column)
    ids, start = encoded(found.distinct, vocabulary)
    size = start[found.code + 1] - start[found.code]
    ends = np.concatenate([[0], np.cumsum(size)])
    return ids[ranges(start[found.code], size)], ends[found.rows]
