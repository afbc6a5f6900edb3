"""Stored keyed tables: what is read does not grow with the log; merges and replays."""

import os

import pytest
from pyspark.sql import functions as F

from vitrine.operators.serving import versions_by_key
from vitrine.session import scratch_path
from vitrine.sinks.keyed import KeyedTable, by_prefix_and_time

COLUMNS = "row_key string, clicks bigint, put_seq bigint"


def _table(spark, name, versions=3, **layout):
    root = scratch_path(spark, name)
    return KeyedTable(spark, "vitrine_keyed_tests", root.rsplit("/", 1)[1].replace("-", "_"), root, "clicks bigint", versions, **layout).create()


def _puts(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _all_versions(table):
    return _rows(versions_by_key(table.rows(), table.versions).select("row_key", "clicks", "put_seq", "version"))


def test_merges_keep_the_last_versions(spark):
    table = _table(spark, "keyed", versions=2)
    batches = [[(f"k{i % 7}", 100 * b + i, 10 * b + i % 3) for i in range(30)] for b in range(4)]
    log = []
    for b, rows in enumerate(batches):
        table.put(_puts(spark, rows), b)
        log += rows
        want = _rows(versions_by_key(_puts(spark, log), 2).select("row_key", "clicks", "put_seq", "version"))
        assert _all_versions(table) == want
        if b % 2:
            table.merge()
            assert table.deltas() == [] and _all_versions(table) == want and table.rows().count() == 14
    assert [r.clicks for r in table.get("k3").collect()] == [max((r[2], r[1]) for r in log if r[0] == "k3")[1]]
    assert table.get("nothing").count() == 0 and table.versions_of("k3").count() == 2
    table.merge()                                                                     # nothing to do


def test_put_and_merge_run_again(spark):
    """A replayed batch replaces itself; a merge that ended before its deltas were removed changes nothing when run again."""
    from vitrine.sinks import keyed
    table = _table(spark, "again")
    a, b = [("x", 1, 1), ("x", 1, 1), ("y", 2, 1)], [("x", 3, 2), ("z", 4, 2)]
    table.put(_puts(spark, a), 0)
    table.merge()
    table.put(_puts(spark, b), 1)
    table.put(_puts(spark, b), 1)
    want = _all_versions(table)
    kept, keyed.delete = keyed.delete, lambda spark, path: None
    try:
        table.merge()
    finally:
        keyed.delete = kept
    assert table.deltas() == [1] and _all_versions(table) == want
    table.merge()
    assert table.deltas() == [] and _all_versions(table) == want and len(want) == 5


def test_a_new_session_finds_the_table(spark):
    table = _table(spark, "found")
    table.put(_puts(spark, [("a", 1, 1), ("b", 2, 1)]), 0)
    table.merge()
    spark.sql(f"DROP TABLE {table.table}")
    again = KeyedTable(spark, "vitrine_keyed_tests", "found_again", table.location, "clicks bigint", 3).create()
    assert _rows(again.get("b")) == [("b", 2, 1)]


def _scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


@pytest.mark.parametrize("days", [60, 240])
def test_files_read_do_not_grow_with_the_log(spark, days):
    """The newest keys and a point read open the newest partition, one bucket, whatever the length of the log."""
    table = _table(spark, f"days{days}", part=by_prefix_and_time, buckets=4)
    day = 86_400_000
    log = spark.range(days * 20).select(
        F.concat(F.lit("A#"), F.lpad((F.lit(9_999_999_999_999) - (F.col("id") * (day // 20) + 1_700_000_000_000)).cast("string"), 13, "0"),
                 F.lit("#o"), F.col("id").cast("string")).alias("row_key"), F.col("id").alias("clicks"), F.col("id").alias("put_seq"))
    table.put(log, 0)
    table.merge()
    files = sum(n.endswith(".parquet") for _, _, names in os.walk(table.location.removeprefix("file:")) for n in names)
    assert len(table.parts("A")) >= days // 12 and files >= len(table.parts("A"))
    assert table.parts("B") == [] and table.newest("B", 3).count() == 0
    last = log.orderBy("row_key").limit(25).collect()
    newest = table.newest("A", 25)
    assert [tuple(r) for r in newest.collect()] == [tuple(r) for r in last]
    one = table.get(last[0].row_key)
    assert _rows(one) == [tuple(last[0])]
    opened = [len(df.inputFiles()) for df in (newest, one)]
    assert opened[1] <= opened[0] <= 2 * 4                                            # at most two partitions of four buckets
    plan = _scanned(one)
    assert "SelectedBucketsCount: 1 out of 4" in plan or "1 out of 4" in plan
    assert "PartitionFilters: [isnotnull(part" in plan and "EqualTo(row_key" in plan


def test_parts_of_deltas_are_found(spark):
    table = _table(spark, "delta_parts", part=by_prefix_and_time)
    table.put(_puts(spark, [("A#8299999999999#x", 1, 1)]), 0)
    table.merge()
    table.put(_puts(spark, [("A#8288888888888#y", 2, 2), ("C#8288888888888#z", 2, 2)]), 1)
    assert table.parts("A") == ["A#8288", "A#8299"]
    assert [r.row_key for r in table.newest("A", 1).collect()] == ["A#8288888888888#y"]
    assert [r.row_key for r in table.newest("A", 5).collect()] == ["A#8288888888888#y", "A#8299999999999#x"]
