"""Alerts: logistics (T3), trending (T6/T7), their union (O2) and the keyed
cell / JSON views of the payloads (P9, P10, F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import reverse_ts, row_key
from vitrine.functions.defaults import stream_defaults

LOGISTICS_PAYLOAD = ["alert_type", "order_id", "region", "carrier", "delay_minutes",
                     "delivery_status", "timestamp"]
TRENDING_PAYLOAD = ["alert_type", "product_id", "product_name", "category",
                    "clicks_in_window", "window_start", "window_end"]
ALERT_COLUMNS = ["row_key", "alert_type", "order_id", "region", "carrier", "delay_minutes",
                 "delivery_status", "timestamp", "product_id", "product_name", "category",
                 "clicks_in_window", "window_start", "window_end"]


def logistics_alert_condition(status: str = "delivery_status", delay: str = "delay_minutes"):
    """status in (DELAYED, FAILED_ATTEMPT) or delay >= 60."""
    return (F.coalesce(F.col(status).isin(*C.ALERT_STATUSES), F.lit(False))
            | (F.coalesce(F.col(delay), F.lit(C.DEFAULT_DELAY_MINUTES)) >= C.ALERT_DELAY_MINUTES))


def logistics_alerts(accepted: DataFrame) -> DataFrame:
    """Stateless alert per accepted DELIVERY_UPDATE matching the rule."""
    defaults = stream_defaults()
    order_id, at = defaults["order_id"], defaults["event_time"]
    return (accepted.where((F.col("event_type") == C.DELIVERY) & logistics_alert_condition())
            .select(row_key(F.lit(C.LOGISTICS_ALERT_PREFIX), reverse_ts(at), order_id).alias("row_key"),
                    F.lit(C.LOGISTICS_ALERT_TYPE).alias("alert_type"),
                    order_id.alias("order_id"),
                    *[defaults[c].alias(c) for c in ("region", "carrier", "delay_minutes")],
                    F.col("delivery_status"),
                    at.alias("timestamp"),
                    F.col("ingestion_time").alias("put_seq")))


def trending_alerts(windows: DataFrame, threshold: int = C.HOT_PRODUCT_THRESHOLD) -> DataFrame:
    """Closed or final windows with ``clicks >= threshold``.  FINAL alerts
    carry no product name / category, as the end-of-input flush writes them."""
    final = F.col("is_final")
    return (windows.where(F.col("clicks") >= threshold)
            .select(row_key(F.lit(C.TRENDING_ALERT_PREFIX), reverse_ts("window_end"), F.col("product_id")).alias("row_key"),
                    F.lit(C.TRENDING_ALERT_TYPE).alias("alert_type"),
                    "product_id",
                    F.when(final, F.lit(None).cast("string")).otherwise(F.col("product_name")).alias("product_name"),
                    F.when(final, F.lit(None).cast("string")).otherwise(
                        F.coalesce(F.col("category"), F.lit(C.DEFAULT_STREAM_CATEGORY))).alias("category"),
                    F.col("clicks").alias("clicks_in_window"),
                    "window_start", "window_end",
                    F.col("window_end").alias("put_seq")))


def all_alerts(logistics: DataFrame, trending: DataFrame) -> DataFrame:
    """Both alert kinds in one table with different columns (O2)."""
    return logistics.unionByName(trending, allowMissingColumns=True).select(*ALERT_COLUMNS, "put_seq")


def alerts_kv(alerts: DataFrame, family: str = C.ALERT_FAMILY) -> DataFrame:
    """Payload flattened to ``(row_key, 'family:qualifier', value)`` cells,
    values as strings; absent (NULL) fields produce no cell (P10)."""
    payload = [c for c in ALERT_COLUMNS if c != "row_key"]
    strings = alerts.select("row_key", *[F.col(c).cast("string").alias(c) for c in payload])
    return (strings.unpivot("row_key", payload, "qualifier", "value")
            .where(F.col("value").isNotNull())
            .select("row_key", F.concat(F.lit(family + ":"), F.col("qualifier")).alias("column"), "value"))


def alerts_json(alerts: DataFrame) -> DataFrame:
    """``(row_key, payload)`` with the payload as JSON text in the producer's
    key order; absent fields are omitted (F8)."""
    is_log = F.col("alert_type") == C.LOGISTICS_ALERT_TYPE
    log_json = F.to_json(F.struct(*[F.col(c) for c in LOGISTICS_PAYLOAD]))
    trend_json = F.to_json(F.struct(*[F.col(c) for c in TRENDING_PAYLOAD]))
    return alerts.select("row_key", F.when(is_log, log_json).otherwise(trend_json).alias("payload"))


def recent_alerts(alerts: DataFrame, alert_type: str, n: int) -> DataFrame:
    """Newest ``n`` alerts of one type: the row key embeds the reversed
    timestamp, so ascending key order is newest first (O1, S8).  A top-n:
    Spark plans it as TakeOrderedAndProject (per-partition top-n, no full sort)."""
    return alerts.where(F.col("alert_type") == alert_type).orderBy("row_key").limit(n)
