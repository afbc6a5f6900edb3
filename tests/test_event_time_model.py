"""Property tests: the streaming rules written down as definitions over whole
sequences, against the Spark operators on random out-of-order arrivals.

late       below the running maximum of (event time - tolerance), from 0
window     an aligned half-open interval that contains a click's event time
closed     ends not after the watermark of the last accepted click
"""

import json
from collections import Counter
from itertools import accumulate

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import make_events
from vitrine.operators.lateness import with_arrival_watermark
from vitrine.operators.windows import emitted_windows, sliding_click_counts

TOL, SIZE, SLIDE = 15_000, 60_000, 15_000


def definitions(events):
    """(accepted ids, emitted windows) of events given in arrival order."""
    watermark = list(accumulate((e["event_time"] - TOL for e in events), max, initial=0))[1:]
    accepted = [(e, w) for e, w in zip(events, watermark) if e["event_time"] >= w]
    clicks = [(e, w) for e, w in accepted if e["event_type"] == "CLICK"]
    count = Counter((start, e["product_id"]) for e, _ in clicks
                    for start in range(-SIZE, 2_000_000, SLIDE) if 0 <= e["event_time"] - start < SIZE)
    last = clicks[-1][1] if clicks else None
    return (sorted(e["event_id"] for e, _ in accepted),
            sorted((s, s + SIZE, p, n, s + SIZE > last) for (s, p), n in count.items()))


event = st.tuples(st.integers(0, 400_000), st.integers(0, 25_000),
                  st.sampled_from(["CLICK", "CLICK", "CART_ADD"]), st.sampled_from(["P1", "P2"]))


def arrivals(raw, coarse=1):
    """Events in arrival order; ``coarse`` puts neighbours into one arrival time."""
    return [{"event_id": f"{i:06d}", "ingestion_time": 1_000_000 + t // coarse * coarse, "event_time": 1_000_000 + t - delay,
             "event_type": typ, "product_id": pid, "category": "Casa"}
            for i, (t, delay, typ, pid) in enumerate(sorted(raw, key=lambda r: r[0]))]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=60), st.sampled_from([1, 50_000, 10_000_000]))
def test_spark_equals_the_definitions(spark, raw, coarse):
    evs = arrivals(raw, coarse)
    accepted, windows = definitions(evs)
    wm = with_arrival_watermark(make_events(spark, evs), TOL)
    assert sorted(r.event_id for r in wm.where("NOT is_late").collect()) == accepted
    counts = sliding_click_counts(wm.where("NOT is_late"), SIZE, SLIDE)
    got = sorted((r.window_start, r.window_end, r.product_id, r.clicks, r.is_final)
                 for r in emitted_windows(counts, wm).collect())
    assert got == windows


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=3, max_size=40), st.integers(1, 3))
def test_accept_stage_over_micro_batches_equals_the_definitions(spark, raw, cuts):
    """The accept stage, fed the same arrivals cut into micro-batches (carried
    watermark between them), accepts exactly the records that are not late."""
    from vitrine.session import scratch_path
    from vitrine.streaming.event_time import EventTimeJob
    evs = arrivals(raw)
    job = EventTimeJob(spark, scratch_path(spark, "model-stream"), tolerance_ms=TOL, size_ms=SIZE, slide_ms=SLIDE)
    step = max(1, len(evs) // (cuts + 1))
    for batch, at in enumerate(range(0, len(evs), step)):
        lines = spark.createDataFrame([(json.dumps(e),) for e in evs[at:at + step]], "value string")
        job.accept_batch(lines, batch)
    assert sorted(r.event_id for r in job.accepted().select("event_id").collect()) == definitions(evs)[0]


def _sequential(rows):
    """Watermarks of (arrival, id, event time) by walking through all rows in order."""
    known = [(a if a is not None else float("-inf"), i, e if e is not None else a) for a, i, e in rows]
    top, out = 0, {}
    for _, i, e in sorted(known):
        top = top if e is None else max(top, e - TOL)
        out[i] = (top, e is not None and e < top)
    return out


def test_many_spans_eras_bursts_and_missing_arrivals(spark, events_of):
    """Arrivals over years (several eras), a third in one millisecond, a third without an arrival time."""
    import random
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        at = rng.choice([None, 1_700_000_000_000, rng.randrange(1_500_000_000_000, 1_800_000_000_000)])
        base = at if at is not None else 1_500_000_000_000
        rows.append((at, f"{i:06d}", rng.choice([None, base - rng.randrange(0, 60_000), base + rng.randrange(0, 10 ** 9)])))
    df = events_of([{"ingestion_time": a, "event_id": i, "event_time": e} for a, i, e in rows]).repartition(7)
    got = {r.event_id: (r.watermark, r.is_late) for r in with_arrival_watermark(df, TOL).collect()}
    assert got == _sequential(rows)


def test_ties_are_ordered_by_the_row(spark, events_of):
    """Equal arrival and id: the same result under any order of the input."""
    rows = [{"ingestion_time": 5, "event_id": "x", "event_time": 1_000_000 + 40_000 * (i % 7), "user_id": str(i)} for i in range(40)]
    results = [sorted((r.user_id, r.watermark) for r in with_arrival_watermark(events_of(x), TOL).collect())
               for x in (rows, rows[::-1])]
    assert results[0] == results[1]


def test_watermark_plan_shuffles_the_rows_once(spark):
    """One exchange holds whole rows, dealt by range; only ranges' maxima are in one task or broadcast; no Python."""
    from vitrine.plans.queries import events
    from vitrine.session import materialize
    ev = materialize(events(spark, "/root/testdata/sf0.01").unionAll(events(spark, "/root/testdata/sf0.01")), "plan-test")
    df = with_arrival_watermark(ev, 3_600_000, rows_per_range=1000)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    lines = plan.splitlines()
    dealt = [x for x in lines if " Exchange " in x]
    assert len([x for x in dealt if "hashpartitioning(_range" in x and "_salt" in x]) == 1
    assert len(dealt) == 3 and plan.count("SortMergeJoin") == 0            # the rows; the maxima, twice
    single = [i for i, x in enumerate(lines) if "Exchange SinglePartition" in x]
    assert len(single) == 1 and "HashAggregate(keys=[_range" in "".join(lines[single[0] + 1:single[0] + 4])
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_close_watermark_does_not_depend_on_row_order(spark, events_of):
    """Twelve clicks of one arrival time and id: the largest watermark, under any order and partitioning."""
    from vitrine.operators.windows import last_click_watermark
    rows = [{"ingestion_time": 9, "event_id": "x", "event_type": "CLICK", "event_time": 1_000_000 + 60_000 * ((7 * i) % 12), "user_id": str(i)}
            for i in range(12)]
    found = set()
    for order in (rows, rows[::-1], rows[5:] + rows[:5]):
        for parts in (1, 3, 8):
            found.add(last_click_watermark(with_arrival_watermark(events_of(order).repartition(parts), TOL)).first()[0])
    assert found == {1_000_000 + 60_000 * 11 - TOL}
