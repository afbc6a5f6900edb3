"""The incremental ETL equals one run over everything, reads only its own load, and retracts what it replaces."""

import os
import shutil

from tests.conftest import SF_SMALL
from vitrine.operators.carts import abandoned_carts
from vitrine.operators.funnel import cart_subtotal_by_category, funnel
from vitrine.operators.logistics import logistics_sla
from vitrine.operators.pairs import click_checkout_pair_count
from vitrine.plans import queries as Q
from vitrine.plans.batch_etl import read_silver, run_daily_etl
from vitrine.session import scratch_path

TABLES = {"dw_sales_funnel_daily": funnel, "dw_logistics_sla_daily": logistics_sla}


def _rows(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _loads(spark, n=3):
    """Log files of parts of the events; a date's events are in several loads."""
    from vitrine.sources.driver_events import noisy_event_log
    root = scratch_path(spark, "loads")
    ev = Q.events(spark, SF_SMALL)
    for i in range(n):
        noisy_event_log(ev.where(f"cast(event_id as long) % {n} = {i}")).write.text(f"{root}/{i}")
    return root


def _check(spark, wh, silver, daily, dt="2024-01-31"):
    events = read_silver(spark, silver).drop("event_date")
    for table, query in TABLES.items():
        assert _rows(wh.read(table).drop("load_id")) == _rows(query(events, daily=True) if daily else query(events, dt=dt)), table
    assert _rows(wh.read("dw_abandoned_carts_daily")) == _rows(abandoned_carts(events))


def test_loads_add_up_and_replacing_one_retracts_it(spark):
    root, silver, wh = _loads(spark), scratch_path(spark, "silver"), Q.warehouse(spark)
    for i in range(3):
        out = run_daily_etl(spark, f"{root}/{i}", silver, wh, daily=True, load_id=f"load{i}")
        _check(spark, wh, silver, daily=True)
    events = read_silver(spark, silver).drop("event_date")
    table = lambda name, query: _rows(out.where(f"table = '{name}'").select(*query.columns)) == _rows(query)
    assert table("cart_subtotal_by_category", cart_subtotal_by_category(events))
    assert table("click_checkout_pair_count", click_checkout_pair_count(events))
    # Load 1 again, with one day's events only: its other days lose what it had added, and days of no other load would go.
    first = Q.events(spark, SF_SMALL).where("cast(event_id as long) % 3 = 1 AND event_time_iso < '2024-01-03'")
    from vitrine.sources.driver_events import noisy_event_log
    noisy_event_log(first).write.text(f"{root}/short")
    run_daily_etl(spark, f"{root}/short", silver, wh, daily=True, load_id="load1")
    _check(spark, wh, silver, daily=True)


def test_dates_of_a_retracted_load_go(spark):
    root, silver, wh = scratch_path(spark, "gone"), scratch_path(spark, "gone-silver"), Q.warehouse(spark)
    line = '{{"event_id":"{i}","event_type":"{kind}","event_time":{t},"ingestion_time":{t},"category":"Casa","cart_id":"c","user_id":"u","carrier":"x","region":"r"}}'
    day = 86_400_000

    def log(name, days):
        rows = [(line.format(i=f"{d}{k}", kind=kind, t=d * day),) for d in days for k, kind in enumerate(("CLICK", "CART_ADD", "DELIVERY_UPDATE"))]
        spark.createDataFrame(rows, "value string").write.text(f"{root}/{name}")
        return f"{root}/{name}"

    run_daily_etl(spark, log("a", [100, 101]), silver, wh, daily=True, load_id="x")
    run_daily_etl(spark, log("b", [101]), silver, wh, daily=True, load_id="y")
    run_daily_etl(spark, log("c", [102]), silver, wh, daily=True, load_id="x")
    _check(spark, wh, silver, daily=True)
    assert {r.dt for r in wh.read("dw_sales_funnel_daily").select("dt").collect()} == {"1970-04-12", "1970-04-13"}


def test_a_second_load_reads_no_events_of_the_first(spark):
    """The first load's silver files are gone; the second run still adds to the tables."""
    root, silver, wh = _loads(spark, 2), scratch_path(spark, "silver2"), Q.warehouse(spark)
    run_daily_etl(spark, f"{root}/0", silver, wh, dt="2024-01-31", load_id="a")
    local = silver.removeprefix("file:")
    aside = f"{local}-aside"
    os.rename(f"{local}/load_id=a", aside)
    run_daily_etl(spark, f"{root}/1", silver, wh, dt="2024-01-31", load_id="b")
    shutil.copytree(aside, f"{local}/load_id=a")
    _check(spark, wh, silver, daily=False)
