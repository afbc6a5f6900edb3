"""Alignment against a plain walk over the bytes of each text."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa

from vitrine.llm import alignment as L
from vitrine.llm import tokens as K


def _tokens(text):
    a, b = K.loaded("tokenizers", "byte_bpe_50k.json"), K.loaded("sentencepiece", "piece_bpe_32k.model")
    of_a = K.token_bytes(a)
    a.encode_special_tokens = True
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a.encode_special_tokens = False
    spelt = ([of_a[i] for i in ids_a], [K.piece_bytes(b, i) for i in ids_b])
    want = (" " + text).encode()
    return ([], [], [], []) if not text or any(b"".join(s) != want for s in spelt) else (ids_a, ids_b, *spelt)


def _brute(texts):
    each, count = [], Counter()
    for text in texts:
        ids_a, ids_b, spelt_a, spelt_b = _tokens(text or "")
        end_a, end_b = np.cumsum([len(s) for s in spelt_a]), np.cumsum([len(s) for s in spelt_b])
        groups, i, j = [], 0, 0
        for end in sorted(set(end_a.tolist()) & set(end_b.tolist())):
            x, y = [], []
            while i < len(ids_a) and end_a[i] <= end:
                x.append(str(ids_a[i]))
                i += 1
            while j < len(ids_b) and end_b[j] <= end:
                y.append(str(ids_b[j]))
                j += 1
            groups.append(",".join(x) + "|" + ",".join(y))
        links = [(ids_a[p], ids_b[q]) for p in range(len(ids_a)) for q in range(len(ids_b))
                 if end_a[p] - len(spelt_a[p]) < end_b[q] and end_b[q] - len(spelt_b[q]) < end_a[p]]
        each.append((len(ids_a), len(ids_b), groups, links))
        count.update(set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(n_a, n_b, len(g), len(x), sum(count[p] == most[p[0]] for p in x), sum(count[p] for p in x), ";".join(g)) for n_a, n_b, g, x in each]


def _texts(corpus):
    rng = random.Random(6)
    odd = ["Ünïcode wörds naïve", "中文 混合 text", "a▁b", "tab\tand  spaces ", "<|endoftext|> <s> </s> <unk> <0x41>", " 　x", "😀 smile",
           " lead", "x", " ", "\x00 nul", "café́"]
    return [t if t is None or len(t) < 2000 else t[:2000] for _, t in corpus] + odd + [" ".join(rng.choice(odd) for _ in range(6)) for _ in range(20)]


def test_equals_brute_force(spark, docs_of, corpus):
    texts = _texts(corpus)
    want = _brute(texts)
    df = docs_of(list(enumerate(texts))).selectExpr("*", "7 AS block", "8 AS place", "9 AS a").repartition(3)
    for limits in ({}, {"block_entries": 300}):
        got = {r.doc_id: tuple(r)[1:] for r in L.align(df, **limits).collect()}
        assert [got[i] for i in range(len(texts))] == want
    digest = {r.doc_id: r.groups for r in L.align(df, keep_groups=False).collect()}
    assert [digest[i] for i in range(len(texts))] == [sha256(w[6].encode()).hexdigest() if w[6] else "" for w in want]
    assert any(w[0] == 0 for w in want) and any(w[4] < w[3] for w in want)


def test_pair_counts_are_documents_and_links(spark, docs_of):
    both = L.described(docs_of([(1, "the the the"), (2, "the"), (3, "cat"), (None, None)]))
    pairs = {(r.a, r.b): (r.documents, r.links, r.best) for r in L.pair_counts(both).collect()}
    assert sorted(pairs.values()) == [(1, 1, True), (2, 4, True)]


def test_repeated_and_empty(spark, docs_of):
    got = sorted(map(tuple, L.align(docs_of([(5, "same text"), (5, "same text"), (None, "same text"), (6, ""), (7, None)])).collect()), key=repr)
    assert [g[1] for g in got] == [2, 2, 0, 0, 2] and got[0][6] == 6 == got[0][4] * 3
    assert L.align(docs_of([])).count() == 0


def test_planes_round_trip():
    """Lists and plain bits, several planes, empty planes between."""
    rng = np.random.default_rng(1)
    pair = np.concatenate([np.full(L.BLOCK_DOCS, 9), np.full(130, 4), np.full(1, 2), np.full(127, 11)])
    place = np.concatenate([np.arange(L.BLOCK_DOCS), *(rng.choice(L.BLOCK_DOCS, n, replace=False) for n in (130, 1, 127))])
    links = np.concatenate([rng.integers(1, 9, L.BLOCK_DOCS), np.full(130, 4), [70_000], rng.integers(1, 3, 127)])
    pairs, documents, total, planes = L.pack_planes(pair, place, links)
    assert pairs.tolist() == [2, 4, 9, 11] and documents.tolist() == [1, 130, L.BLOCK_DOCS, 127]
    assert total.tolist() == [links[pair == p].sum() for p in pairs]
    back = Counter()
    for r, k, p in zip(*L.read_planes(planes)):
        back[(pairs[r], p)] += 1 << k
    assert back == Counter(dict(zip(zip(pair.tolist(), place.tolist()), links.tolist())))
    sliced = pa.concat_arrays([planes, planes]).slice(3, 3)
    rows, _, _ = L.read_planes(sliced)
    assert set(rows.tolist()) == {0, 1, 2}
    assert [len(x) for x in L.read_planes(planes.slice(0, 0))] == [0, 0, 0]
