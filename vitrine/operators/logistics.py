"""Delivery SLA per (carrier, region)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import pct, run_date, utc_date


def logistics_sla(events: DataFrame, dt: str | None = None, daily: bool = False) -> DataFrame:
    """DELIVERY_UPDATE rows per (carrier, region).

    ``total_orders`` counts updates with a non-null order id (not distinct
    orders); OUT_FOR_DELIVERY is in the denominator but in no bucket; SLA
    defaults to 100.0 when every order id of the group is NULL.
    """
    status = F.col("delivery_status")
    keys = [F.col("carrier"), F.col("region")]
    if daily:
        keys.append(utc_date("event_time").alias("dt"))
    out = (events.where(F.col("event_type") == C.DELIVERY)
           .select("carrier", "region", "order_id", "delivery_status", "delay_minutes", "event_time")
           .groupBy(*keys)
           .agg(F.count("order_id").alias("total_orders"),
                F.count(F.when(status.isin(*C.ON_TIME_STATUSES), 1)).alias("on_time_deliveries"),
                F.count(F.when(status == C.DELAYED_STATUS, 1)).alias("delayed_deliveries"),
                F.count(F.when(status == C.FAILED_STATUS, 1)).alias("failed_attempts"),
                F.round(F.avg("delay_minutes"), 1).alias("avg_delay_minutes"))
           .withColumn("sla_percentage", pct("on_time_deliveries", "total_orders", 100.0)))
    if not daily:
        out = out.withColumn("dt", F.lit(run_date(dt)))
    return out.select("carrier", "region", "total_orders", "on_time_deliveries",
                      "delayed_deliveries", "failed_attempts", "sla_percentage",
                      "avg_delay_minutes", "dt")
