"""Ids by cuts equal the ids of whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from vitrine.llm import tokens as K

ALPHABET = list("ab '\n\t0?!.,é|<>à 　中文▁ \x00\x1c\x85ЖÑ") + ["  ", " ", " ", "'s ", "<|endoftext|>", "word ", "123 ", "😀", "​", "﻿"]


def _texts():
    rng = random.Random(5)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    return out + ["", " ", "  ", "x", " x ", "long " * 60_000, "y" * 50_000, "▁ ▁x a▁b"]


@pytest.mark.parametrize("plain", [True, False])
def test_byte_level_ids(plain):
    texts = _texts()
    own = K.loaded("tokenizers", "byte_bpe_50k.json")
    ids, at = K.read_ids(pa.array(texts), K.byte_bpe("byte_bpe_50k.json", plain))
    own.encode_special_tokens = plain
    want = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    own.encode_special_tokens = False
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert any(50256 in w for w in want) != plain


def test_piece_ids():
    texts = _texts()
    ids, at = K.read_ids(K.after_space(pa.array(texts)), K.pieces("piece_bpe_32k.model"))
    model = K.loaded("sentencepiece", "piece_bpe_32k.model")
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [model.encode(t) if t else [] for t in texts]


def test_cuts_are_the_text():
    texts = [*_texts(), None]
    found = K.cuts(pa.array(texts))
    distinct = found.distinct.to_pylist()
    assert [b"".join(distinct[c] for c in found.code[a:b]).decode() for a, b in zip(found.rows[:-1], found.rows[1:])] == [t or "" for t in texts]
    assert len(distinct) == len(set(distinct)) and np.diff(found.rows)[-1] == 0
