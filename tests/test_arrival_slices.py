"""Events without an arrival time are in the stream's slices too."""

from tests.conftest import SF_SMALL
from vitrine.plans import queries as Q
from vitrine.session import scratch_path


def test_slices_hold_every_row_with_null_props(spark):
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = scratch_path(spark, "null-props")
    (raw.selectExpr("event_id", "IF(event_id % 97 = 0, NULL, ts) AS ts", "user_id", "event_type", "value",
                    "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '{k' ELSE props END AS props")
     .write.parquet(f"{out}/events.parquet"))
    ev = Q.events(spark, out)
    none = ev.where("ingestion_time IS NULL").count()
    slices = Q.arrival_slices(ev, 4)
    ids = [sorted(r.event_id for r in s.select("event_id").collect()) for s in slices]
    assert none > 0 and len(slices) == 4
    assert sorted(i for part in ids for i in part) == sorted(r.event_id for r in ev.select("event_id").collect())
    assert slices[0].where("ingestion_time IS NULL").count() == none


def test_slices_of_a_log_without_arrival_times(spark, events_of):
    ev = events_of([{"event_id": str(i), "event_time": i} for i in range(5)])
    assert sum(s.count() for s in Q.arrival_slices(ev, 3)) == 5
