"""Plan-shape checks: the physical plans we rely on for scale."""

import re

import pytest

from tests.conftest import SF_SMALL
from vitrine.plans.queries import QUERIES


def _plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["funnel", "logistics_sla", "cart_subtotal_by_category", "abandoned_carts",
                                  "click_checkout_pair_count", "sliding_clicks", "late_rate"])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "partial_" in plan, name          # map-side combine below every exchange of rows


@pytest.mark.parametrize("name", ["funnel", "logistics_sla", "click_checkout_pair_count", "event_time_iso"])
def test_scans_read_only_needed_columns(spark, name):
    plan = _plan(spark, name)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(len(s.split(",")) <= 4 for s in schemas), schemas


def test_versions_views_use_map_side_group_limit(spark):
    for name in ("alerts_versions", "metrics_versions"):
        plan = _plan(spark, name)
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_recent_alerts_is_a_top_n_without_full_sort(spark):
    plan = _plan(spark, "recent_alerts")
    assert "TakeOrderedAndProject" in plan
    assert "TRENDING" not in plan.split("TakeOrderedAndProject")[1].split("\n")[0]


def test_pair_count_never_joins_raw_rows(spark):
    plan = _plan(spark, "click_checkout_pair_count")
    join_line = [ln for ln in plan.splitlines() if "Join" in ln][0]
    below = plan[plan.index(join_line):]
    assert "HashAggregate" in below            # both join inputs are aggregates


def test_snapshot_filters_reach_the_parquet_scan(spark):
    plan = _plan(spark, "closed_windows")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,CLICK\)", plan)


@pytest.mark.parametrize("name", ["filter_event_type", "logistics_sla", "cart_subtotal_by_category", "abandoned_carts",
                                  "click_checkout_pair_count"])
def test_type_filters_reach_the_scan(spark, name):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", _plan(spark, name))
    assert pushed and all("event_type" in p for p in pushed), pushed
