"""Explicit schemas: the event union and the warehouse tables.

Nothing in the library infers a schema: inference costs a full pass over
the input and yields BIGINT where the warehouse says INT, or no column at
all when an event type is absent from the input.
"""

from __future__ import annotations

from pyspark.sql import types as T

# One flat object per JSON line; the union of every event type's fields.
EVENT_FIELDS = [
    ("event_id", T.StringType()),
    ("event_time", T.LongType()),          # epoch ms
    ("event_time_iso", T.StringType()),
    ("ingestion_time", T.LongType()),      # epoch ms
    ("is_simulated_late", T.BooleanType()),
    ("event_type", T.StringType()),
    ("user_id", T.StringType()),
    ("region", T.StringType()),
    ("product_id", T.StringType()),
    ("product_name", T.StringType()),
    ("category", T.StringType()),
    ("price", T.DoubleType()),
    ("quantity", T.IntegerType()),
    ("subtotal", T.DoubleType()),
    ("order_id", T.StringType()),
    ("total_amount", T.DoubleType()),
    ("payment_method", T.StringType()),
    ("delivery_status", T.StringType()),
    ("delay_minutes", T.IntegerType()),
    ("carrier", T.StringType()),
    ("cart_id", T.StringType()),
    ("item_price", T.DoubleType()),
    ("items_count", T.IntegerType()),
]

EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])
EVENT_COLUMNS = [n for n, _ in EVENT_FIELDS]

CORRUPT_COLUMN = "_corrupt_record"
EVENT_SCHEMA_WITH_CORRUPT = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

# The raw external table over the landing zone declares only 20 columns.
RAW_TABLE_COLUMNS = [c for c in EVENT_COLUMNS if c not in ("cart_id", "item_price", "items_count")]

# Warehouse tables, in DDL column order (insertInto matches by position).
FUNNEL_COLUMNS = ["category", "total_clicks", "total_cart_adds", "total_checkouts",
                  "conversion_rate_cart", "conversion_rate_checkout", "total_revenue"]
LOGISTICS_COLUMNS = ["carrier", "region", "total_orders", "on_time_deliveries",
                     "delayed_deliveries", "failed_attempts", "sla_percentage",
                     "avg_delay_minutes"]
ABANDONED_COLUMNS = ["category", "carts_created", "carts_abandoned", "abandonment_rate",
                     "estimated_lost_revenue"]

DW_DDL = {
    "dw_sales_funnel_daily": """
        category STRING, total_clicks BIGINT, total_cart_adds BIGINT, total_checkouts BIGINT,
        conversion_rate_cart DOUBLE, conversion_rate_checkout DOUBLE, total_revenue DOUBLE,
        dt STRING""",
    "dw_logistics_sla_daily": """
        carrier STRING, region STRING, total_orders BIGINT, on_time_deliveries BIGINT,
        delayed_deliveries BIGINT, failed_attempts BIGINT, sla_percentage DOUBLE,
        avg_delay_minutes DOUBLE, dt STRING""",
    "dw_abandoned_carts_daily": """
        category STRING, carts_created BIGINT, carts_abandoned BIGINT,
        abandonment_rate DOUBLE, estimated_lost_revenue DOUBLE, dt STRING""",
}
DW_COLUMNS = {
    "dw_sales_funnel_daily": FUNNEL_COLUMNS,
    "dw_logistics_sla_daily": LOGISTICS_COLUMNS,
    "dw_abandoned_carts_daily": ABANDONED_COLUMNS,
}
