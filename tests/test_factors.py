"""Factorised click-checkout pairs, and landed days registered at commit."""

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from vitrine.operators.pairs import list_pairs, pair_factors
from vitrine.plans import queries as Q
from vitrine.session import scratch_path
from vitrine.sources import json_lines as J


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_listed_pairs_equal_the_plain_join(spark):
    ev = Q.events(spark, SF_MID)
    clicks = ev.where("event_type = 'CLICK'").select("user_id", "product_id")
    orders = ev.where("event_type = 'CHECKOUT_COMPLETED'").select(F.col("user_id").alias("u"), "order_id")
    plain = clicks.join(orders, clicks["user_id"].eqNullSafe(orders["u"])).groupBy("user_id", "product_id", "order_id").agg(F.count(F.lit(1)).alias("pairs"))
    for chunk in (1000, 3):
        assert _rows(list_pairs(pair_factors(ev, chunk))) == _rows(plain)


def test_hot_user_has_many_small_chunks_and_null_users_pair(spark, events_of):
    rows = [{"event_type": "CLICK", "user_id": "hot", "product_id": f"p{i % 50}"} for i in range(200)]
    rows += [{"event_type": "CHECKOUT_COMPLETED", "user_id": "hot", "order_id": f"o{i}"} for i in range(3000)]
    rows += [{"event_type": "CLICK", "product_id": "p"}, {"event_type": "CHECKOUT_COMPLETED", "order_id": None},
             {"event_type": "CLICK", "user_id": "no orders", "product_id": "p"}, {"event_type": "CHECKOUT_COMPLETED", "user_id": "no clicks"}]
    factors = pair_factors(events_of(rows), 100).withColumn("size", F.size("entries"))
    hot = factors.where("user_id = 'hot' AND side = 'orders'").collect()
    assert len(hot) == 30 and sum(r["size"] for r in hot) == 3000 and max(r["size"] for r in hot) < 160
    assert {r.user_id for r in factors.select("user_id").distinct().collect()} == {"hot", None}
    assert list_pairs(factors).where("user_id IS NULL").collect()[0]["pairs"] == 1


def test_a_load_registers_its_days_only(spark):
    root = scratch_path(spark, "zone")
    table = "vitrine_zone_" + root.rsplit("-", 1)[1]
    J.create_raw_table(spark, table, root, recover=False)

    def lines(day):
        at = day * 86_400_000
        return J.landing_layout(spark.createDataFrame([('{"event_id":"%d"}' % day, at)], "value string, at long"), "at")

    J.land(spark, lines(1), root, table)
    J.write_landing(lines(2), root)                       # a folder that no commit has named
    J.land(spark, lines(3).unionAll(lines(1)), root, table)
    assert sorted(r.event_id for r in spark.table(table).collect()) == ["1", "3"]
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    J.create_raw_table(spark, table + "_all", root)
    assert spark.table(table + "_all").count() == 3
