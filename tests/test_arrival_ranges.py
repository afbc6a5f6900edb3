"""One arrival time with many rising event times: the watermark stays exact, and no task or row gets them all."""

from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_events
from vitrine.operators import lateness as L
from vitrine.operators.lateness import with_arrival_watermark

N, TOL = 6000, 1000


def _rising(spark):
    """A third of rows without arrival time, their event time rising with their id; some rows repeat."""
    rows = [{"event_id": f"{i:08d}", "event_time": 10_000 + 100 * i - (i * 7919) % 5000 * (i % 4 == 0),
             "ingestion_time": None if i % 3 == 0 else 2_000_000 + i // 50} for i in range(N)]
    return rows + rows[:90], make_events(spark, rows + rows[:90]).repartition(6)


def test_rising_event_times_of_one_arrival_equal_a_walk_through_all_rows(spark):
    rows, df = _rising(spark)
    order = sorted(rows, key=lambda r: (r["ingestion_time"] or -1, r["event_id"]))
    top = list(accumulate((r["event_time"] - TOL for r in order), max, initial=0))[1:]
    want = dict(zip((r["event_id"] for r in order), top))
    got = with_arrival_watermark(df, TOL).collect()
    assert len(got) == len(rows)
    assert {r.event_id: r.watermark for r in got} == want
    assert all(r.is_late == (r.event_time < r.watermark) for r in got)


@pytest.mark.parametrize("rows_per_range", [100, 1 << 20])
def test_many_ranges_equal_one(spark, monkeypatch, rows_per_range):
    _, df = _rising(spark)
    plain = sorted(map(tuple, with_arrival_watermark(df, TOL).select("event_id", "watermark", "is_late").collect()))
    monkeypatch.setattr(L, "ROWS_IN_ONE", 100)
    cut = with_arrival_watermark(df, TOL, rows_per_range=rows_per_range)
    assert "_salt" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, cut.select("event_id", "watermark", "is_late").collect())) == plain


@pytest.mark.parametrize("rows_per_range, most", [(1 << 20, 40), (40, 400)])
def test_ranges_cut_a_hot_arrival_time_and_follow_the_number_of_rows(spark, monkeypatch, rows_per_range, most):
    monkeypatch.setattr(L, "ROWS_IN_ONE", 100)
    _, df = _rising(spark)
    staged = df.select(F.struct(F.col("ingestion_time").alias("t"), F.col("event_id").alias("e"), F.lit(0).cast("long").alias("h")).alias("_key"))
    bounds = L.range_bounds(staged, rows_per_range)
    assert max(L.LEAST_RANGES, N // rows_per_range) * 0.7 < len(bounds) < most
    ranges = L.with_range(staged, bounds).groupBy("_range").agg(
        F.count(F.lit(1)).alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")).orderBy("_range").collect()
    assert sum(r.n for r in ranges) == len(_rising(spark)[0]) and max(r.n for r in ranges) < 6 * N / len(bounds)
    key = lambda k: (k.t is not None, k.t or 0, k.e)
    assert all(key(a.high) < key(b.low) for a, b in zip(ranges, ranges[1:]))


def test_no_row_holds_the_steps_of_an_arrival_time(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS_IN_ONE", 100)
    plan = with_arrival_watermark(_rising(spark)[1], TOL)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct" not in plan and "_steps" not in plan
