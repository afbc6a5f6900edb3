"""Abandoned carts per (UTC event date, category).

Declared by the warehouse but never computed upstream, so the definition is
ours.  A cart *unit* is (dt, category, cart_id, user_id) with at least one
CART_ADD.  It is abandoned when the same user has no CHECKOUT_COMPLETED on
the same dt at or after the unit's last CART_ADD.  Lost revenue of an
abandoned unit is ``greatest(sum(ADD subtotal) - sum(REMOVE subtotal), 0)``.

Plan: both sides are aggregated first (units; latest checkout per (dt,
user)), then equi-joined on (dt, user) — a hot user contributes one row per
(dt) on the checkout side, no range join, no pair expansion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import pct, utc_date


def cart_units(events: DataFrame) -> DataFrame:
    etype = F.col("event_type")
    sub = F.coalesce(F.col("subtotal"), F.lit(0.0))
    return (events.where(etype.isin(C.CART_ADD, C.CART_REMOVE))
            .select(utc_date("event_time").alias("dt"), "category", "cart_id", "user_id",
                    "event_type", "event_time", "subtotal")
            .groupBy("dt", "category", "cart_id", "user_id")
            .agg(F.max(F.when(etype == C.CART_ADD, F.col("event_time"))).alias("last_add_time"),
                 F.sum(F.when(etype == C.CART_ADD, sub).otherwise(0.0)).alias("added"),
                 F.sum(F.when(etype == C.CART_REMOVE, sub).otherwise(0.0)).alias("removed"))
            .where(F.col("last_add_time").isNotNull()))


def latest_checkouts(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == C.CHECKOUT)
            .select(utc_date("event_time").alias("o_dt"), F.col("user_id").alias("o_user_id"),
                    "event_time")
            .groupBy("o_dt", "o_user_id").agg(F.max("event_time").alias("last_checkout_time")))


def abandoned_carts(events: DataFrame) -> DataFrame:
    return abandoned_from(cart_units(events), latest_checkouts(events))


def abandoned_from(units: DataFrame, checkouts: DataFrame) -> DataFrame:
    joined = units.join(
        checkouts,
        (units["dt"] == checkouts["o_dt"]) & units["user_id"].eqNullSafe(checkouts["o_user_id"]),
        "left")
    abandoned = F.col("last_checkout_time").isNull() | (F.col("last_checkout_time") < F.col("last_add_time"))
    lost = F.greatest(F.col("added") - F.col("removed"), F.lit(0.0))
    return (joined.groupBy("dt", "category")
            .agg(F.count(F.lit(1)).alias("carts_created"),
                 F.count(F.when(abandoned, 1)).alias("carts_abandoned"),
                 F.round(F.sum(F.when(abandoned, lost).otherwise(0.0)), 2).alias("estimated_lost_revenue"))
            .withColumn("abandonment_rate", pct("carts_abandoned", "carts_created", 0.0))
            .select("category", "carts_created", "carts_abandoned", "abandonment_rate",
                    "estimated_lost_revenue", "dt"))
