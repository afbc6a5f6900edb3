"""Mergeable partial aggregates per load and event date.

Each load writes, once, what its own events add to the warehouse tables:

    funnel     (event_date, category)                      counts, exact sums
    sla        (event_date, carrier, region)               counts, sum and count of delays
    units      (event_date, category, cart_id, user_id)    latest add, exact sums
    checkouts  (event_date, user_id)                       latest checkout
    users      (user_id)                                   clicks, checkouts

All of them are counts, sums of decimals, or maxima, so the tables follow from the
partials of all loads whatever way the events were cut into loads, and no events of
earlier loads are read again.  A load's partials are replaced as a whole, which retracts what it
held before.  Folders are ``<root>/<kind>/load_id=…[/event_date=…]``; readers that want some
dates open those folders only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import pct, run_date
from vitrine.operators.carts import abandoned_from
from vitrine.streaming.files import child_names, exists

#: Sums that do not depend on the order of additions.
EXACT = "decimal(38,6)"
NO_DATE = "unknown"

_KEYS = {"funnel": "event_date, category", "sla": "event_date, carrier, region", "units": "event_date, category, cart_id, user_id",
         "checkouts": "event_date, user_id", "users": "user_id"}
SCHEMAS = {
    "funnel": f"category string, clicks long, cart_adds long, checkouts long, revenue {EXACT}, subtotal {EXACT}, carts long",
    "sla": f"carrier string, region string, orders long, on_time long, late long, failed long, delay {EXACT}, delays long",
    "units": f"category string, cart_id string, user_id string, last_add_time long, added {EXACT}, removed {EXACT}",
    "checkouts": "user_id string, last_checkout_time long",
    "users": "user_id string, clicks long, checkouts long",
}


def _exact(c: str, when: Column) -> Column:
    return F.sum(F.when(when, F.coalesce(F.col(c), F.lit(0)).cast(EXACT)).otherwise(F.lit(0).cast(EXACT))).cast(EXACT)


def _partials(events: DataFrame) -> dict[str, DataFrame]:
    """events: a load's good events with ``event_date``."""
    kind, status = F.col("event_type"), F.col("delivery_status")
    count = lambda when: F.count(F.when(when, 1))
    by = lambda name, df: df.groupBy(*_KEYS[name].split(", "))
    return {
        "funnel": by("funnel", events).agg(
            count(kind == C.CLICK).alias("clicks"), count(kind == C.CART_ADD).alias("cart_adds"), count(kind == C.CHECKOUT).alias("checkouts"),
            _exact("total_amount", kind == C.CHECKOUT).alias("revenue"), _exact("subtotal", kind == C.CART_ADD).alias("subtotal"),
            count(kind == C.CART_ADD).alias("carts")),
        "sla": by("sla", events.where(kind == C.DELIVERY)).agg(
            F.count("order_id").alias("orders"), count(status.isin(*C.ON_TIME_STATUSES)).alias("on_time"),
            count(status == C.DELAYED_STATUS).alias("late"), count(status == C.FAILED_STATUS).alias("failed"),
            _exact("delay_minutes", F.lit(True)).alias("delay"), F.count("delay_minutes").alias("delays")),
        "units": by("units", events.where(kind.isin(C.CART_ADD, C.CART_REMOVE) & F.col("event_time").isNotNull())).agg(
            F.max(F.when(kind == C.CART_ADD, F.col("event_time"))).alias("last_add_time"),
            _exact("subtotal", kind == C.CART_ADD).alias("added"), _exact("subtotal", kind == C.CART_REMOVE).alias("removed")),
        "checkouts": by("checkouts", events.where(kind == C.CHECKOUT)).agg(F.max("event_time").alias("last_checkout_time")),
        "users": by("users", events.where(kind.isin(C.CLICK, C.CHECKOUT))).agg(
            count(kind == C.CLICK).alias("clicks"), count(kind == C.CHECKOUT).alias("checkouts")),
    }


class Partials:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def dates_of(self, load_id: str) -> set[str]:
        """Event dates that a load's partials hold (folder names)."""
        names = {n for kind in ("funnel", "sla", "units", "checkouts") for n in child_names(self.spark, f"{self.root}/{kind}/load_id={load_id}")}
        return {n.split("=", 1)[1] for n in names if n.startswith("event_date=")}

    def write(self, events: DataFrame, load_id: str) -> list[str]:
        """Replaces a load's partials; returns the dates that the load holds or held before."""
        before = self.dates_of(load_id)
        for kind, partial in _partials(events).items():
            writer = partial.write.mode("overwrite").option("partitionOverwriteMode", "static")
            if "event_date" in partial.columns:
                writer = writer.partitionBy("event_date")
            writer.parquet(f"{self.root}/{kind}/load_id={load_id}")
        return sorted(before | self.dates_of(load_id))

    def read(self, kind: str, dates: list[str] | None = None) -> DataFrame:
        """Partials of all loads, of some dates."""
        schema = SCHEMAS[kind] + ", load_id string" + (", event_date string" if "event_date" in _KEYS[kind] else "")
        if not exists(self.spark, f"{self.root}/{kind}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        return rows if dates is None else rows.where(F.col("event_date").isin(dates))

    # ------------------------------------------------------------ tables
    def _dated(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("dt", F.when(F.col("event_date") != NO_DATE, F.col("event_date")))

    def funnel(self, dt: str | None = None, dates: list[str] | None = None) -> DataFrame:
        """As ``operators.funnel.funnel``: all stamped with ``dt``, or by event date for some dates."""
        daily = dates is not None
        rows = self._dated(self.read("funnel", dates)).groupBy("category", *(["dt"] if daily else [])).agg(
            F.sum("clicks").alias("total_clicks"), F.sum("cart_adds").alias("total_cart_adds"), F.sum("checkouts").alias("total_checkouts"),
            F.round(F.sum("revenue").cast("double"), 2).alias("total_revenue"))
        rows = rows.withColumn("conversion_rate_cart", pct("total_cart_adds", "total_clicks", 0.0)) \
            .withColumn("conversion_rate_checkout", pct("total_checkouts", "total_clicks", 0.0))
        rows = rows if daily else rows.withColumn("dt", F.lit(run_date(dt)))
        return rows.select("category", "total_clicks", "total_cart_adds", "total_checkouts", "conversion_rate_cart",
                           "conversion_rate_checkout", "total_revenue", "dt")

    def logistics_sla(self, dt: str | None = None, dates: list[str] | None = None) -> DataFrame:
        daily = dates is not None
        rows = self._dated(self.read("sla", dates)).groupBy("carrier", "region", *(["dt"] if daily else [])).agg(
            F.sum("orders").alias("total_orders"), F.sum("on_time").alias("on_time_deliveries"), F.sum("late").alias("delayed_deliveries"),
            F.sum("failed").alias("failed_attempts"), F.sum("delay").cast("double").alias("delay"), F.sum("delays").alias("delays"))
        average = F.when(F.col("delays") > 0, F.col("delay") / F.col("delays"))
        rows = rows.withColumn("avg_delay_minutes", F.round(average, 1)).withColumn("sla_percentage", pct("on_time_deliveries", "total_orders", 100.0))
        rows = rows if daily else rows.withColumn("dt", F.lit(run_date(dt)))
        return rows.select("carrier", "region", "total_orders", "on_time_deliveries", "delayed_deliveries", "failed_attempts",
                           "sla_percentage", "avg_delay_minutes", "dt")

    def abandoned_carts(self, dates: list[str]) -> DataFrame:
        units = self._dated(self.read("units", dates)).groupBy("dt", "category", "cart_id", "user_id").agg(
            F.max("last_add_time").alias("last_add_time"), F.sum("added").cast("double").alias("added"), F.sum("removed").cast("double").alias("removed"))
        checkouts = self._dated(self.read("checkouts", dates)).groupBy(F.col("dt").alias("o_dt"), F.col("user_id").alias("o_user_id")).agg(
            F.max("last_checkout_time").alias("last_checkout_time"))
        return abandoned_from(units.where(F.col("last_add_time").isNotNull()), checkouts)

    def cart_subtotal_by_category(self) -> DataFrame:
        rows = self.read("funnel").where(F.col("carts") > 0)
        return rows.groupBy("category").agg(F.round(F.sum("subtotal").cast("double"), 2).alias("subtotal_sum"))

    def click_checkout_pair_count(self) -> DataFrame:
        users = self.read("users").groupBy("user_id").agg(F.sum("clicks").alias("clicks"), F.sum("checkouts").alias("checkouts"))
        return users.agg(F.coalesce(F.sum(F.col("clicks") * F.col("checkouts")), F.lit(0)).cast("long").alias("pair_count"))
