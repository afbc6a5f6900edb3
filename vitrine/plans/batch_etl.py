"""The daily batch ETL job: raw JSON lines -> warehouse tables.

    raw lines ──parse once (explicit schema)──> silver Parquet, one folder per load
                 load_id=…/quality=good/event_date=…  ·  load_id=…/quality=rejected (quarantine)
                                    this load's columns ▼
                 partial aggregates per load and event date (``plans/partials.py``)
                                    partials of all loads, of the dates that this load touches ▼
                 dw_sales_funnel_daily · dw_logistics_sla_daily · dw_abandoned_carts_daily
                 cart subtotals · click-checkout pair count

The raw text of a load is parsed exactly once, and its events are aggregated once.  A run
reads its own load's events and, of the others, only partial aggregates; tables by event date are
rewritten for the dates that the load holds, or held before it was replaced.  A load is named after its input (or by
the caller).  Running it again replaces that load and no other, so late events of
an earlier day, and earlier quarantined lines, are never lost.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.columns import run_date, utc_date
from vitrine.plans.partials import NO_DATE, Partials
from vitrine.schemas import CORRUPT_COLUMN, EVENT_COLUMNS, EVENT_SCHEMA
from vitrine.session import materialize
from vitrine.sinks.warehouse import Warehouse
from vitrine.sources.json_lines import parse_json_lines, read_lines
from vitrine.streaming.files import exists


def load_name(raw_path: str) -> str:
    """Name of a load: fixed by its input path."""
    return hashlib.sha256(raw_path.rstrip("/").encode()).hexdigest()[:16]


def write_silver(spark: SparkSession, raw_path: str, silver_path: str, load_id: str | None = None) -> dict:
    """Parse once, write once: ``load_id=…/quality=good/event_date=…`` holds
    the events, ``quality=rejected`` the malformed lines (``_line`` is kept only
    for those, so it costs nothing on good rows).  The whole load is replaced, no
    other one is touched.  Returns the loaded-record counters (Q1), observed during
    that same write — no extra pass."""
    from pyspark.sql import Observation

    parsed = parse_json_lines(read_lines(spark, raw_path))
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    counters = Observation("silver")
    (parsed.select(*EVENT_COLUMNS,
                   F.when(bad, F.col("_line")).alias("line"),
                   F.when(bad, "rejected").otherwise("good").alias("quality"),
                   F.when(bad, "unknown").otherwise(
                       F.coalesce(utc_date("event_time"), F.lit("unknown"))).alias("event_date"))
     .observe(counters, F.count(F.when(F.col("quality") == "good", 1)).alias("silver_events"),
              F.count(F.when(F.col("quality") == "rejected", 1)).alias("rejects"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("quality", "event_date").parquet(f"{silver_path.rstrip('/')}/load_id={load_id or load_name(raw_path)}"))
    return counters.get


def _silver(spark: SparkSession, silver_path: str) -> DataFrame:
    schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField("line", T.StringType()),
                                                 T.StructField("quality", T.StringType()),
                                                 T.StructField("event_date", T.StringType()),
                                                 T.StructField("load_id", T.StringType())])
    return spark.read.schema(schema).parquet(silver_path)


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """Good events (partition-pruned to ``quality=good``)."""
    return _silver(spark, silver_path).where(F.col("quality") == "good").select(*EVENT_COLUMNS, "event_date")


def read_rejects(spark: SparkSession, silver_path: str) -> DataFrame:
    return _silver(spark, silver_path).where(F.col("quality") == "rejected").select("line")


def load_events(spark: SparkSession, silver_path: str, load_id: str) -> DataFrame:
    """Good events of one load: its folder alone is listed and read."""
    schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField("event_date", T.StringType())])
    path = f"{silver_path.rstrip('/')}/load_id={load_id}/quality=good"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _write_dates(wh: Warehouse, table: str, rows: DataFrame, dates: list[str]) -> None:
    """Partitions of these dates as `rows` has them; those without rows go."""
    rows = materialize(rows, f"etl-{table}")
    wh.write(table, rows)
    left = {r.dt for r in rows.select("dt").distinct().collect()}
    wh.drop_dates(table, [d for d in dates if d not in left and d != NO_DATE])


def run_daily_etl(spark: SparkSession, raw_path: str, silver_path: str, wh: Warehouse,
                  dt: str | None = None, daily: bool = False, load_id: str | None = None) -> DataFrame:
    """Runs the job over one load and what is known of all earlier ones; returns what the tables hold.

    ``dt`` given and ``daily`` False: parity mode, all input stamped with ``dt``
    (default: today's UTC date, taken once for the run).  ``daily``: funnel and SLA
    grouped by UTC event date.  Abandoned carts are always per event date (their
    definition).  Result: column ``table`` and the columns of that table; besides the
    three warehouse tables the cart subtotals (G2), the pair count (J2) and this load's
    record counters (Q1).
    """
    dt, load_id = run_date(dt), load_id or load_name(raw_path)
    loaded = write_silver(spark, raw_path, silver_path, load_id)
    partials = Partials(spark, f"{silver_path.rstrip('/')}_partials")
    dates = partials.write(load_events(spark, silver_path, load_id), load_id)
    if daily:
        _write_dates(wh, "dw_sales_funnel_daily", partials.funnel(dates=dates), dates)
        _write_dates(wh, "dw_logistics_sla_daily", partials.logistics_sla(dates=dates), dates)
    else:
        wh.write("dw_sales_funnel_daily", partials.funnel(dt))
        wh.write("dw_logistics_sla_daily", partials.logistics_sla(dt))
    _write_dates(wh, "dw_abandoned_carts_daily", partials.abandoned_carts(dates), dates)
    parts = {t: wh.read(t) for t in ("dw_sales_funnel_daily", "dw_logistics_sla_daily", "dw_abandoned_carts_daily")}
    parts["cart_subtotal_by_category"] = partials.cart_subtotal_by_category()
    parts["click_checkout_pair_count"] = partials.click_checkout_pair_count()
    parts |= {k: spark.range(1).select(F.lit(int(v)).cast("long").alias("rows")) for k, v in loaded.items()}
    out = None
    for name, part in parts.items():
        part = part.withColumn("table", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
