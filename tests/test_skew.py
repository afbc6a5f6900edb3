"""Skew: a third of all events share one user, one product and one arrival
millisecond.  The queries must stay exact (against DuckDB on the same table)
and the hot arrival time must not reach one task record by record."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_MID
from vitrine.session import scratch_path

KEYS = ["funnel", "logistics_sla", "click_checkout_pairs", "click_checkout_pair_count", "abandoned_carts",
        "arrival_watermark", "late_rate", "sliding_clicks", "closed_windows", "metrics_latest", "alerts_latest"]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    """The driver's sf0.01 events with every third event moved onto user 7,
    one timestamp and one ``k`` (so one product and one ingestion ms)."""
    out = scratch_path(spark, "skewed")
    hot = F.col("event_id") % 3 == 0
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    (ev.withColumn("user_id", F.when(hot, F.lit(7).cast("long")).otherwise(F.col("user_id")))
       .withColumn("ts", F.when(hot, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
       .withColumn("props", F.when(hot, F.lit('{"k": 5}')).otherwise(F.col("props")))
       .coalesce(1).write.parquet(f"{out}/events.parquet"))
    return out


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", KEYS)
def test_skewed_input_matches_oracle(spark, skewed_dir, name):
    local = skewed_dir.replace("file:", "")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{local}/events.parquet/*.parquet')")
    df = entry.queries()[name](spark, skewed_dir)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(cur.fetchall(), ocols)


def _largest_task(spark, rows, rows_per_range):
    from vitrine.operators.lateness import range_bounds, with_range
    key = rows.select("*", F.struct(F.col("ingestion_time").alias("t"), F.col("event_id").alias("e"), F.xxhash64(*rows.columns).alias("h")).alias("_key"))
    return with_range(key, range_bounds(key.select("_key"), rows_per_range)).groupBy("_range").count().agg(F.max("count")).first()[0]


def test_hot_millisecond_is_cut_into_ranges(spark, skewed_dir):
    """A third of the rows have one arrival time; no range holds a large part of them."""
    from vitrine.plans.queries import events
    ev = events(spark, skewed_dir)
    hot = ev.groupBy("ingestion_time").count().orderBy(F.desc("count")).first()
    assert hot["count"] > ev.count() / 4
    ev = ev.unionAll(ev.withColumn("event_id", F.concat(F.lit("b"), "event_id"))).unionAll(ev.withColumn("event_id", F.concat(F.lit("c"), "event_id")))
    assert _largest_task(spark, ev, 1 << 20) < ev.count() / 10


def test_rows_that_repeat_are_a_range_of_their_own_over_many_tasks(spark, skewed_dir):
    """A third of the rows are one row repeated: a bound of the ranges, salted, and every copy has the same exact watermark."""
    from vitrine.operators.lateness import with_arrival_watermark
    from vitrine.plans.queries import events
    ev = events(spark, skewed_dir)
    one = ev.orderBy("ingestion_time", "event_id").limit(1)
    copies = one.crossJoin(spark.range(12_000).select()).unionAll(ev.where("event_id > '000000004000'"))
    wm = with_arrival_watermark(copies, 3_600_000)
    plan = wm._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    got = wm.join(one.select("event_id"), "event_id").agg(F.countDistinct("watermark"), F.count(F.lit(1)), F.min(F.col("watermark") >= F.col("event_time") - 3_600_000)).first()
    assert got[0] == 1 and got[1] >= 12_000 and got[2]
    rest = {r.event_id: r.watermark for r in wm.select("event_id", "watermark").distinct().collect()}
    once = {r.event_id: r.watermark for r in with_arrival_watermark(copies.distinct(), 3_600_000).select("event_id", "watermark").collect()}
    assert rest == once
