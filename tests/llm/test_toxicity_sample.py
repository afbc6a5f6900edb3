import pytest
from pyspark.sql import functions as F
from vitrine.llm import toxicity as tox


def _tables(spark, docs_of):
    """120 labelled texts; the one that stands first in the sample's order is longer than the budget of 20 000 characters."""
    ids = spark.range(120).where(~tox.held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").first().id
    words = lambda i: "lorem ipsum " * (3 + i % 5) + ("vile " if i % 3 == 0 else "dolor ")
    rows = [(i, "sit amet " * 4000 if i == ids else words(i)) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    return docs_of(rows), labels, ids


def test_a_long_text_does_not_end_the_sample(spark, docs_of):
    docs, labels, long = _tables(spark, docs_of)
    with_long = tox.fit(docs, labels, train_chars=20_000)
    without = tox.fit(docs.where(F.col("doc_id") != long), labels, train_chars=20_000)
    assert len(with_long.doc) == 4 and with_long[0] and with_long[0] == without[0]


def test_labelled_texts_that_are_all_too_long_are_an_error(spark, docs_of):
    docs, labels, _ = _tables(spark, docs_of)
    with pytest.raises(ValueError):
        tox.fit(docs, labels, train_chars=10)
