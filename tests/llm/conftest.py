import pytest
from llm_cases import DOC_SCHEMA


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make


@pytest.fixture
def corpus():
    """(doc_id, text) with NULLs, empty and long texts, copies, near copies, shared passages, repeated rows."""
    import random
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["Élan", "ñandú", "TOKEN", "don't"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, text(rng.choice([1, 4, 5, 12, 13, 30, 80, 200]))) for i in range(60)]
    passage = text(55)
    rows += [(100 + i, text(rng.randrange(0, 40)) + " " + passage + "\n" + text(rng.randrange(0, 40))) for i in range(25)]
    base = text(120)
    rows += [(200 + i, base) for i in range(12)] + [(220 + i, base.upper()) for i in range(3)]
    for i in range(30):                                    # near copies: one to fifteen words changed
        words = base.split()
        for _ in range(i // 2 + 1):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(999))
        rows.append((300 + i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, text(9000)), (404, "again " * 3000), (None, base), (None, "lonely text"),
             (405, "repeated row of this text"), (405, "repeated row of this text"), (406, "a b c\x0bd\x1ce"), (-7, passage)]
    rng.shuffle(rows)
    return rows
