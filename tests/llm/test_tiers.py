"""Hierarchical packing: every id once, no padding, level steps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from vitrine.llm import tiers, tokens


def _check(lengths, windows, sizes):
    seen = defaultdict(list)
    for size, held in windows:
        assert sum(n for *_, n in held) == size and all(n > 0 for *_, n in held)
        assert size <= max(sizes) and size & (size - 1) == 0
        for d, at, n in held:
            seen[d].append((at, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[d]):
            assert start == at
            at += length
        assert at == n


def test_every_id_once_and_full_windows():
    rng = random.Random(3)
    for _ in range(300):
        lengths = [rng.choice([rng.randrange(0, 9), rng.randrange(0, 70), rng.randrange(0, 300)]) for _ in range(rng.randrange(0, 60))]
        sizes = rng.choice([(8, 16, 32, 64), (64,), (1, 2), (16, 64)])
        _check(lengths, tiers.pack(lengths, sizes), sizes)


def test_gaps_are_filled_from_shorter_tiers_before_anything_is_cut():
    windows = tiers.pack([50, 14, 30, 2, 16], (8, 16, 32, 64))
    assert windows == [(64, [(0, 0, 50), (1, 0, 14)]), (32, [(2, 0, 30), (3, 0, 2)]), (16, [(4, 0, 16)])]
    assert len(tiers.pack([1024 * 5 + 3], tiers.TIERS)) == 5 + 2                    # the rest, 3, is cut at 2


def test_steps_are_level():
    rng = random.Random(4)
    sizes = [rng.choice([128, 256, 512, 1024, 1024]) for _ in range(2000)]
    group = tiers.step_groups(sizes, 1 << 14)
    load = np.bincount(group, weights=sizes)
    assert len(load) == round(sum(sizes) / (1 << 14)) and load.max() - load.min() <= 1024
    shares = [np.bincount([g for g, s in zip(group, sizes) if s == 1024], minlength=len(load))]
    assert np.ptp(shares[0]) <= 1
    assert tiers.step_groups([], 10) == []


@pytest.mark.parametrize("lot_tokens", [1 << 21, 500])
def test_documents(spark, docs_of, corpus, lot_tokens):
    own = tokens.loaded("tokenizers", "byte_bpe_50k.json")
    rows = [(k, t) for k, (_, t) in enumerate(corpus)] + [(None, "no id"), (9000, "ends <|endoftext|> here <|endoftext|>")]
    df = docs_of(rows).selectExpr("*", "1 AS length", "2 AS window", "text AS ids").repartition(3)
    got = tiers.tiered_packing(df, lot_tokens=lot_tokens).collect()
    by_doc, by_sequence, steps = defaultdict(list), defaultdict(list), defaultdict(set)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        steps[r.step_group].add(r.sequence_id)
        assert len(r.ids) == 4 * r.length > 0
    for doc_id, text in rows:
        want = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1]]
        assert b"".join(r.ids for r in parts) == want.tobytes() and {r.doc_tokens for r in parts} == {len(want)}
    for held in by_sequence.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == [0, *np.cumsum([r.length for r in held])[:-1]]
        size = sum(r.length for r in held)
        assert size == held[0].window <= 1024 and size & (size - 1) == 0 and len({r.step_group for r in held}) == 1
    assert sum(map(len, steps.values())) == len(by_sequence)


def test_query_digest_empty_table_and_wrong_tiers(spark, docs_of):
    from vitrine.llm.queries import QUERIES
    rows = QUERIES["op12_tiered_packing"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "window", "step_group", "ids_crc32"]
    first = tiers.tiered_packing(docs_of([(1, "a b")])).selectExpr("*", "crc32(ids) AS crc").collect()
    assert {zlib.crc32(r.ids) for r in first} == {r.crc for r in first}
    assert tiers.tiered_packing(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        tiers.tiered_packing(docs_of([]), tiers=(100,))
