"""Sales funnel (G3/G5) and cart subtotal per category.

All of them are one hash aggregate on ``category`` with conditional
aggregates: partial aggregation runs map-side, so only one row per
(category, map task) crosses the shuffle, whatever the skew of a category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import pct, run_date, utc_date


def _funnel_aggs() -> list[Column]:
    etype = F.col("event_type")
    return [
        F.count(F.when(etype == C.CLICK, 1)).alias("total_clicks"),
        F.count(F.when(etype == C.CART_ADD, 1)).alias("total_cart_adds"),
        F.count(F.when(etype == C.CHECKOUT, 1)).alias("total_checkouts"),
        F.round(F.sum(F.when(etype == C.CHECKOUT, F.col("total_amount")).otherwise(0.0)), 2)
        .alias("total_revenue"),
    ]


def funnel(events: DataFrame, dt: str | None = None, daily: bool = False,
           default_category: str | None = None) -> DataFrame:
    """Per category: clicks, cart adds, checkouts, revenue, two rates, ``dt``.

    ``dt`` is the run's literal partition value (parity mode: every run
    aggregates all input and stamps it).  ``daily=True`` instead groups by the
    UTC event date.  ``default_category`` replaces a NULL category (fallback
    flavour, G5); by default NULL is its own group.
    """
    category = F.col("category")
    if default_category is not None:
        category = F.coalesce(category, F.lit(default_category))
    keys = [category.alias("category")]
    if daily:
        keys.append(utc_date("event_time").alias("dt"))
    out = (events.select("event_type", "category", "total_amount", "event_time")
           .groupBy(*keys).agg(*_funnel_aggs())
           .withColumn("conversion_rate_cart", pct("total_cart_adds", "total_clicks", 0.0))
           .withColumn("conversion_rate_checkout", pct("total_checkouts", "total_clicks", 0.0)))
    if not daily:
        out = out.withColumn("dt", F.lit(run_date(dt)))
    return out.select("category", "total_clicks", "total_cart_adds", "total_checkouts",
                      "conversion_rate_cart", "conversion_rate_checkout", "total_revenue", "dt")


def cart_subtotal_by_category(events: DataFrame) -> DataFrame:
    """Sum of ``subtotal or 0.0`` of CART_ADD per category; NULL kept.

    The sum is presented at cents precision (the job prints it with 2
    decimals); inputs are cents, so rounding only removes float noise.
    """
    return (events.where(F.col("event_type") == C.CART_ADD)
            .groupBy("category")
            .agg(F.round(F.sum(F.coalesce(F.col("subtotal").cast("double"), F.lit(0.0))), 2)
                 .alias("subtotal_sum")))


def filter_event_type(events: DataFrame, event_type: str) -> DataFrame:
    """Equality filter on the event type."""
    return events.where(F.col("event_type") == event_type)
