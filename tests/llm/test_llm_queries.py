"""The registered queries of the training-data operators over a whole small table set."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from vitrine.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(SMALL), reason="needs the test tables")


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(re.fullmatch(r"op(\d+)_\w+", k)[1]) for k in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        path = f"{SMALL}/{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    df = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, SMALL)
    table, key = ("pages", "page_id") if name.startswith("op3") else ("documents", "doc_id")
    every = spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).distinct().count()
    found = rows.select(key).distinct().count()
    assert found < every if name.startswith("op6") else found == every
