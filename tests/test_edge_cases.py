"""Hand-made goldens for the edge cases of FIXTURES.md §3."""

import json

from pyspark.sql import functions as F

from vitrine.operators import alerts as A
from vitrine.operators import serving as S
from vitrine.operators.carts import abandoned_carts
from vitrine.operators.funnel import cart_subtotal_by_category, funnel
from vitrine.operators.lateness import with_arrival_watermark
from vitrine.operators.logistics import logistics_sla
from vitrine.operators.pairs import click_checkout_pair_count, click_checkout_pairs
from vitrine.operators.windows import emitted_windows, sliding_click_counts
from vitrine.session import scratch_path
from vitrine.sinks.warehouse import Warehouse, read_partitioned_path, write_partitioned_path
from vitrine.sources import json_lines as J

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def _lines(spark, lines):
    path = scratch_path(spark, "edge-lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_lines_are_quarantined(spark):
    path = _lines(spark, ["not json", "[1,2]", "[]", "null", "{}", "", "   ",
                          '{"event_id":"a","delay_minutes":"abc"}',
                          '{"event_id":"b","event_type":"CLICK","event_time":5}'])
    rejects = sorted(r.line for r in J.read_rejects(spark, path).collect())
    assert rejects == sorted(["not json", "[1,2]", "[]", "null", '{"event_id":"a","delay_minutes":"abc"}'])
    good = J.read_tolerant(spark, path).collect()
    assert len(good) == 2 and sorted(str(r.event_id) for r in good) == ["None", "b"]
    counts = J.line_counts(spark, path).first().asDict()
    assert counts == {"total_events": 7, "good_events": 2, "rejected_events": 5, "blank_lines": 2}


def test_null_category(events_of):
    ev = events_of([{"event_type": "CART_ADD", "category": None, "subtotal": 10.0},
                    {"event_type": "CART_ADD", "category": "Casa", "subtotal": None},
                    {"event_type": "CLICK", "category": None}])
    sub = {r.category: r.subtotal_sum for r in cart_subtotal_by_category(ev).collect()}
    assert sub == {None: 10.0, "Casa": 0.0}
    cats = {r.category for r in funnel(ev, dt="d", default_category="Outros").collect()}
    assert cats == {"Outros", "Casa"}
    casa = [r for r in funnel(ev, dt="d").collect() if r.category == "Casa"][0]
    assert casa.conversion_rate_cart == 0.0 and casa.conversion_rate_checkout == 0.0  # carts, no clicks


def test_logistics_alert_threshold_and_defaults(events_of):
    base = {"event_type": "DELIVERY_UPDATE", "event_time": T0, "ingestion_time": T0,
            "carrier": "Loggi", "region": "Sul"}
    ev = events_of([dict(base, event_id="1", order_id="o1", delivery_status="IN_TRANSIT", delay_minutes=59),
                    dict(base, event_id="2", order_id="o2", delivery_status="IN_TRANSIT", delay_minutes=60),
                    dict(base, event_id="3", order_id="o3", delivery_status="IN_TRANSIT", delay_minutes=None),
                    {"event_id": "4", "event_type": "DELIVERY_UPDATE", "event_time": T0 + 1,
                     "ingestion_time": T0 + 1, "delivery_status": None, "delay_minutes": 60}])
    out = {r.order_id: r for r in A.logistics_alerts(ev).collect()}
    assert set(out) == {"o2", "N/A"}
    nul = out["N/A"]
    assert (nul.carrier, nul.region, nul.delay_minutes) == ("Desconhecida", "N/A", 60)
    assert nul.row_key == f"LOGISTICS_ALERT#{9999999999999 - (T0 + 1)}#N/A"


def test_watermark_edges(events_of):
    # tolerance 10: wm after first = 90; 90 accepted (== wm), 89 late (wm - 1)
    ev = events_of([{"event_id": "a", "event_time": 100, "ingestion_time": 1, "event_type": "CLICK"},
                    {"event_id": "b", "event_time": 90, "ingestion_time": 2, "event_type": "CLICK"},
                    {"event_id": "c", "event_time": 89, "ingestion_time": 3, "event_type": "CLICK"}])
    got = {r.event_id: (r.watermark, r.is_late) for r in with_arrival_watermark(ev, 10).collect()}
    assert got == {"a": (90, False), "b": (90, False), "c": (90, True)}


def test_window_edges_and_threshold(events_of):
    size, slide = 4 * DAY, DAY
    start = T0  # a window start (multiple of the slide)
    clicks = [{"event_id": f"c{i}", "event_type": "CLICK", "product_id": "P1", "category": "Casa",
               "event_time": start, "ingestion_time": start + i} for i in range(5)]
    clicks += [{"event_id": "e", "event_type": "CLICK", "product_id": "P2", "category": "Moda",
                "event_time": start + size, "ingestion_time": start + 10}]
    ev = events_of(clicks)
    counts = sliding_click_counts(ev, size, slide)
    p1 = {r.window_start: r.clicks for r in counts.where("product_id = 'P1'").collect()}
    assert p1[start] == 5 and (start + slide) not in p1          # on the start: in it
    p2 = {r.window_start for r in counts.where("product_id = 'P2'").collect()}
    assert start not in p2                                        # on the end: not in it
    wm = with_arrival_watermark(ev, 0)
    trending = A.trending_alerts(emitted_windows(counts, wm), 5).collect()
    assert {r.product_id for r in trending} == {"P1"}
    four = events_of(clicks[:4])
    assert A.trending_alerts(emitted_windows(sliding_click_counts(four, size, slide),
                                             with_arrival_watermark(four, 0)), 5).count() == 0


def test_versions_views(spark):
    puts = spark.createDataFrame([("k", 1, 10), ("k", 2, 20)], "row_key string, v int, put_seq long")
    assert S.latest_by_key(puts).collect()[0].v == 2
    assert S.versions_by_key(puts, 3).count() == 2
    six = spark.createDataFrame([("m", i, i, i) for i in range(6)],
                                "row_key string, clicks_window long, last_window_end long, put_seq long")
    assert S.metrics_versions(six).count() == 5
    assert S.metrics_latest(six).first().clicks_window == 5


def test_null_user_pairs(events_of):
    ev = events_of([{"event_type": "CLICK", "user_id": None, "product_id": "P"},
                    {"event_type": "CHECKOUT_COMPLETED", "user_id": None, "order_id": "o"}])
    assert click_checkout_pair_count(ev).first().pair_count == 1
    assert click_checkout_pairs(ev).first().pairs == 1


def test_sla_only_null_orders(events_of):
    ev = events_of([{"event_type": "DELIVERY_UPDATE", "carrier": "X", "region": "R",
                     "order_id": None, "delivery_status": "DELIVERED", "delay_minutes": 0}])
    r = logistics_sla(ev, dt="d").first()
    assert r.total_orders == 0 and r.sla_percentage == 100.0


def test_abandoned_carts_edges(events_of):
    t = T0 + 1000
    ev = events_of([
        # user 1: checkout in the same ms as the last add -> not abandoned
        {"event_type": "CART_ADD", "user_id": "u1", "cart_id": "c1", "category": "Casa", "subtotal": 5.0, "event_time": t},
        {"event_type": "CHECKOUT_COMPLETED", "user_id": "u1", "event_time": t},
        # user 2: removes more than added, no checkout -> abandoned, lost 0
        {"event_type": "CART_ADD", "user_id": "u2", "cart_id": "c2", "category": "Casa", "subtotal": 5.0, "event_time": t},
        {"event_type": "CART_REMOVE", "user_id": "u2", "cart_id": "c2", "category": "Casa", "subtotal": 9.0, "event_time": t + 1},
        # user 3: removals only -> not a cart
        {"event_type": "CART_REMOVE", "user_id": "u3", "cart_id": "c3", "category": "Casa", "subtotal": 1.0, "event_time": t},
    ])
    r = abandoned_carts(ev).first()
    assert (r.carts_created, r.carts_abandoned, r.estimated_lost_revenue, r.abandonment_rate) == (2, 1, 0.0, 50.0)


def test_dw_rerun_is_idempotent_and_pruned(spark, events_of):
    ev = events_of([{"event_type": "CLICK", "category": "Casa", "event_time": T0}])
    root = scratch_path(spark, "edge-dw")
    wh = Warehouse(spark, "edge_dw_" + root.rsplit("-", 1)[-1], root).create()
    for _ in range(2):
        wh.write("dw_sales_funnel_daily", funnel(ev, dt="2024-01-01"))
    wh.write("dw_sales_funnel_daily", funnel(ev, dt="2024-01-02"))
    assert wh.read("dw_sales_funnel_daily", dt="2024-01-01").count() == 1
    plan = wh.read("dw_sales_funnel_daily", dt="2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-01" in plan
    wh.write("dw_sales_funnel_daily", funnel(ev, dt="2024-01-01"), mode="append")
    assert wh.read("dw_sales_funnel_daily", dt="2024-01-01").count() == 2
    path = scratch_path(spark, "edge-path")
    write_partitioned_path(funnel(ev, dt="2024-01-01"), "dw_sales_funnel_daily", path)
    write_partitioned_path(funnel(ev, dt="2024-01-01"), "dw_sales_funnel_daily", path)
    back = read_partitioned_path(spark, "dw_sales_funnel_daily", path)
    assert back.count() == 1 and dict(back.dtypes)["dt"] == "string"


def test_dt_defaults_to_today_utc(events_of):
    from datetime import datetime, timezone
    ev = events_of([{"event_type": "CLICK", "category": "Casa"}])
    today = datetime.now(timezone.utc).strftime("%Y-%m-%d")
    assert funnel(ev).first().dt == today
    assert logistics_sla(events_of([{"event_type": "DELIVERY_UPDATE", "carrier": "X"}])).first().dt == today


def test_source_waits_for_path(spark):
    import threading
    import time

    from vitrine.streaming.landing import wait_for_path
    path = scratch_path(spark, "late-source")
    threading.Timer(1.5, lambda: spark.createDataFrame([("x",)], "value string").write.text(path)).start()
    t0 = time.monotonic()
    wait_for_path(spark, path, timeout_s=60, poll_s=0.2)
    assert time.monotonic() - t0 >= 1.0


def test_changelog_compaction_keeps_n_versions(spark):
    path, out = scratch_path(spark, "log"), scratch_path(spark, "compacted")
    spark.createDataFrame([("m", i, i) for i in range(8)] + [("k", 1, 1)],
                          "row_key string, clicks_window long, put_seq long").write.parquet(path)
    S.compact(spark, path, out, 5)
    back = spark.read.parquet(out)
    assert back.where("row_key = 'm'").count() == 5 and back.where("row_key = 'k'").count() == 1
    assert sorted(r.put_seq for r in back.where("row_key = 'm'").collect()) == [3, 4, 5, 6, 7]


def test_missing_event_time_and_name_use_the_defaults(events_of):
    """A click without event time counts at its arrival; alerts of one order keep different keys; names default to the id."""
    rows = [{"event_type": "CLICK", "event_id": f"c{i}", "ingestion_time": 1_000_000 + i, "product_id": "P1",
             "event_time": 1_000_000 if i % 2 else None} for i in range(6)]
    rows += [{"event_type": "DELIVERY_UPDATE", "event_id": f"d{i}", "ingestion_time": 1_000_500 + 90_000 * i, "order_id": "o1",
              "delivery_status": "DELAYED"} for i in range(2)]
    rows.append({"event_type": "CLICK", "event_id": "z", "ingestion_time": 5_000_000, "product_id": "P2"})
    wm = with_arrival_watermark(events_of(rows), 10_000_000)
    windows = emitted_windows(sliding_click_counts(wm.where("NOT is_late")), wm)
    assert {r.clicks for r in windows.where("product_id = 'P1' AND window_start = 990000").collect()} == {6}
    closed = windows.withColumn("is_final", F.lit(False))
    alert = A.trending_alerts(closed, 5).first()
    assert (alert.product_name, alert.category) == ("P1", "Geral")
    keys = [r.row_key for r in A.logistics_alerts(wm.where("NOT is_late")).collect()]
    assert len(set(keys)) == 2 and all(k.count("#") == 2 for k in keys)


def test_equal_put_seq_gives_one_answer_under_any_order(spark):
    rows = [("k", 1, "x", 5), ("k", 2, "y", 5), ("k", None, "z", 5), ("k", 9, "a", 4), ("m", 1, "q", None), ("m", 1, "r", None)]
    answers = set()
    for x in (rows, rows[::-1], rows[2:] + rows[:2]):
        log = spark.createDataFrame(x, "row_key string, n long, name string, put_seq long").coalesce(1)
        answers.add((tuple(sorted(map(tuple, S.latest_by_key(log).collect()), key=str)),
                     tuple(sorted(map(tuple, S.versions_by_key(log, 2).collect()), key=str))))
    assert len(answers) == 1


def test_etl_keeps_every_load(spark, tmp_path):
    """A second load with late events of the first day loses nothing, and repeating either load changes nothing."""
    from vitrine.plans.batch_etl import read_rejects, read_silver, run_daily_etl
    day = 86_400_000
    line = lambda i, t: json.dumps({"event_id": f"e{i}", "event_type": "CLICK", "event_time": t, "ingestion_time": t, "category": "Casa"})
    loads = {"one": [line(i, day + i) for i in range(10)] + ["not json"],
             "two": [line(20 + i, 2 * day + i) for i in range(5)] + [line(30, day + 99), "[1]"]}
    for name, lines in loads.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.json").write_text("\n".join(lines))
    wh = Warehouse(spark, "etl_loads", str(tmp_path / "wh")).create()
    silver = str(tmp_path / "silver")
    for name in ("one", "two", "two", "one"):
        out = run_daily_etl(spark, str(tmp_path / name), silver, wh, daily=True)
        if name == "two":
            assert read_silver(spark, silver).count() == 16
            assert sorted(r.line for r in read_rejects(spark, silver).collect()) == ["[1]", "not json"]
            clicks = {r.dt: r.total_clicks for r in out.where("table = 'dw_sales_funnel_daily'").collect()}
            assert clicks == {"1970-01-02": 11, "1970-01-03": 5}
    assert read_silver(spark, silver).select("event_id").distinct().count() == 16 == read_silver(spark, silver).count()


def test_one_run_has_one_date(spark, tmp_path, monkeypatch):
    from vitrine.plans import batch_etl
    dates = iter(["2024-01-01", "2024-01-02", "2024-01-03"])
    monkeypatch.setattr(batch_etl, "run_date", lambda dt=None: dt or next(dates))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.json").write_text('{"event_type": "CLICK"}\n{"event_type": "DELIVERY_UPDATE", "carrier": "c"}')
    wh = Warehouse(spark, "etl_dates", str(tmp_path / "wh")).create()
    out = batch_etl.run_daily_etl(spark, str(tmp_path / "raw"), str(tmp_path / "silver"), wh)
    assert {r.dt for r in out.where("dt IS NOT NULL").collect()} == {"2024-01-01"}
