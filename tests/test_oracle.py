"""Differential check: every registered query on events against its DuckDB SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from vitrine.duckdb_sql import ORACLE as EVENT_ORACLE
from vitrine.plans.queries import QUERIES

ORACLE = {k: v for k, v in EVENT_ORACLE.items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for name in ("events",):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 48
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 6
    assert "total_revenue" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(cur.fetchall(), ocols)


def test_no_python_in_plans(spark):
    for name in ("funnel", "abandoned_carts", "arrival_watermark", "sliding_clicks", "scan_tolerant"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_readme_mentions_every_query():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    text = open(os.path.join(here, "README.md")).read()
    missing = [q for q in QUERIES if f"`{q}`" not in text]
    assert not missing, missing
