import random

import pytest
from llm_cases import WORD
from vitrine.llm import substrings

BIG = 2 ** 63 - 1


def _brute(rows, n):
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for j in range(len(w) - n + 1):
            k = tuple(w[j:j + n])
            first[k] = min(first.get(k, BIG), BIG if d is None else d)
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        off = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j:j + n])] < (BIG if d is None else d):
                off[j:j + n] = [True] * n
        out.append((d, len(w), sum(off), " ".join(x for x, o in zip(w, off) if not o)))
    return sorted(out, key=str)


def test_every_document_equals_brute_force(docs_of, corpus):
    rows = corpus + [(405, "repeated row " + "with other text " * 9), (500, "with other text " * 12), (501, "x " * 30 + "with other text " * 9)]
    for n, seed, size in ((13, 5, 64 << 20), (5, 5, 5_000), (7, 3, 20_000)):
        got = substrings.remove_repeats(docs_of(rows), n, seed, size).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == _brute(rows, n)
        for r in got:
            assert sum(s.end - s.start for s in r.removed) == r.n_removed


@pytest.mark.parametrize("length", [130, 131, 200])
def test_long_windows(docs_of, length):
    """Spans of more than 255 words."""
    rng = random.Random(length)
    text = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    shared = text(700)
    rows = [(1, text(90) + " " + shared), (2, shared), (3, text(40) + " " + shared + " " + text(300)), (4, shared[:len(shared) // 2])]
    got = substrings.remove_repeats(docs_of(rows), length).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == _brute(rows, length)


def test_few_words_many_repeats(docs_of):
    """A small vocabulary: windows overlap, nest and repeat within documents."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    rows += [(i, "a " * 50) for i in (500, 501, 502)]
    got = substrings.remove_repeats(docs_of(rows), 6, 3).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == _brute(rows, 6)


def test_automaton_owners_equal_search():
    rng = random.Random(4)
    for _ in range(200):
        automaton, seen = substrings.SuffixAutomaton(), []
        for owner in range(rng.randrange(1, 8)):
            s = [rng.randrange(3) for _ in range(rng.randrange(0, 15))]
            for n in (1, 2, 4):
                want = [next((o for o, t in seen if any(t[k:k + n] == s[j:j + n] for k in range(len(t) - n + 1))), None)
                        for j in range(len(s) - n + 1)]
                assert automaton.owners(s, n) == want
            automaton.add(s, owner)
            seen.append((owner, s))


def test_empty_table_and_bad_length(docs_of):
    assert substrings.remove_repeats(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(docs_of([]), 3, 5)
