"""Null/absent defaulting.

A JSON ``null`` and an absent key are both NULL after parsing; the streaming
job's defaults apply to both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.schemas import EVENT_COLUMNS


def stream_defaults() -> dict:
    """Column -> default expression applied by the streaming rules."""
    return {
        "event_time": F.coalesce(F.col("event_time"), F.col("ingestion_time")),
        "is_simulated_late": F.coalesce(F.col("is_simulated_late"), F.lit(False)),
        "delay_minutes": F.coalesce(F.col("delay_minutes"), F.lit(C.DEFAULT_DELAY_MINUTES)),
        "order_id": F.coalesce(F.col("order_id"), F.lit(C.DEFAULT_ORDER_ID)),
        "region": F.coalesce(F.col("region"), F.lit(C.DEFAULT_REGION)),
        "carrier": F.coalesce(F.col("carrier"), F.lit(C.DEFAULT_CARRIER)),
        "category": F.coalesce(F.col("category"), F.lit(C.DEFAULT_STREAM_CATEGORY)),
        "product_name": F.coalesce(F.col("product_name"), F.col("product_id")),
    }


def normalize_defaults(events: DataFrame) -> DataFrame:
    """Every event column, with the streaming defaults filled in."""
    defaults = stream_defaults()
    return events.select(*[defaults.get(c, F.col(c)).alias(c) for c in EVENT_COLUMNS])
