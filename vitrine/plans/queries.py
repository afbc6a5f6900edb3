"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the driver tables in ``sf_dir`` (through the event
adaptor), so its work grows with the data.  Queries that exercise a sink or a
stream write below ``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import iso_utc
from vitrine.functions.defaults import normalize_defaults
from vitrine.operators import alerts as A
from vitrine.operators import serving as S
from vitrine.operators.carts import abandoned_carts
from vitrine.operators.funnel import cart_subtotal_by_category, filter_event_type, funnel
from vitrine.operators.lateness import (accepted_events, arrival_key_cols, late_events, late_rate, with_arrival_watermark,
                                        with_late_pct)
from vitrine.operators.logistics import logistics_sla
from vitrine.operators.pairs import click_checkout_pair_count, click_checkout_pairs, factor_entries, pair_factors
from vitrine.operators.windows import emitted_windows, sliding_click_counts, split_windows
from vitrine.plans.batch_etl import run_daily_etl
from vitrine.schemas import EVENT_COLUMNS
from vitrine.session import ensure_session_settings, materialize, scratch_path
from vitrine.sinks.keyed import KeyedTable, by_prefix_and_time
from vitrine.sinks.rolled import merge_idle, read_landed, start_rolled
from vitrine.sinks.warehouse import Warehouse, read_partitioned_path, write_partitioned_path
from vitrine.sources import json_lines as J
from vitrine.sources.driver_events import noisy_event_log, read_driver_events
from vitrine.sources.tail import local_path, tail_stream
from vitrine.streaming import landing as L
from vitrine.streaming.event_time import EventTimeJob
from vitrine.streaming.files import publish

# Run parameters of the registered queries (FIXTURES.md): a fixed run date
# for the literal ``dt``, and event-time parameters scaled to the driver
# data, whose events are minutes apart (same 4:1 window:slide ratio).
RUN_DT = "2024-01-31"
WINDOW_MS = 24 * 3600 * 1000
SLIDE_MS = 6 * 3600 * 1000
TOLERANCE_MS = 3600 * 1000
HOT_THRESHOLD = C.HOT_PRODUCT_THRESHOLD
LOOKUP_METRIC_KEY = "Casa#P-03"
RECENT_ALERTS_N = 20
PRUNED_DT = "2024-01-15"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session_settings(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        QUERIES[name] = run
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return read_driver_events(spark, sf_dir, types)


# ---------------------------------------------------------------- batch
@register("funnel")
def q_funnel(spark, sf_dir):
    return funnel(events(spark, sf_dir), dt=RUN_DT)


@register("funnel_default_category")
def q_funnel_default(spark, sf_dir):
    return funnel(events(spark, sf_dir), dt=RUN_DT, default_category=C.DEFAULT_FALLBACK_CATEGORY)


@register("logistics_sla")
def q_logistics(spark, sf_dir):
    return logistics_sla(events(spark, sf_dir, C.DELIVERY), dt=RUN_DT)


@register("cart_subtotal_by_category")
def q_cart_subtotal(spark, sf_dir):
    return cart_subtotal_by_category(events(spark, sf_dir, C.CART_ADD))


@register("click_checkout_pairs")
def q_pairs(spark, sf_dir):
    return click_checkout_pairs(events(spark, sf_dir, C.CLICK, C.CHECKOUT))


@register("click_checkout_pair_count")
def q_pair_count(spark, sf_dir):
    return click_checkout_pair_count(events(spark, sf_dir, C.CLICK, C.CHECKOUT))


@register("click_checkout_factors")
def q_factors(spark, sf_dir):
    return factor_entries(pair_factors(events(spark, sf_dir, C.CLICK, C.CHECKOUT)))


@register("abandoned_carts")
def q_abandoned(spark, sf_dir):
    return abandoned_carts(events(spark, sf_dir, C.CART_ADD, C.CART_REMOVE, C.CHECKOUT))


@register("filter_event_type")
def q_filter(spark, sf_dir):
    return filter_event_type(events(spark, sf_dir, C.CLICK), C.CLICK).select(
        "event_id", "event_time", "user_id", "product_id", "category", "price")


@register("normalize_defaults")
def q_defaults(spark, sf_dir):
    return normalize_defaults(events(spark, sf_dir))


@register("event_time_iso")
def q_iso(spark, sf_dir):
    ev = events(spark, sf_dir)
    return ev.select("event_id", "event_time", iso_utc("event_time").alias("event_time_iso"))


# ---------------------------------------------------------------- lateness
def watermarked(spark, sf_dir) -> DataFrame:
    return with_arrival_watermark(events(spark, sf_dir), TOLERANCE_MS)


@register("arrival_watermark")
def q_arrival_watermark(spark, sf_dir):
    return watermarked(spark, sf_dir).select(
        "event_id", "event_type", "ingestion_time", "event_time", "watermark", "is_late")


@register("accepted_events")
def q_accepted(spark, sf_dir):
    return accepted_events(watermarked(spark, sf_dir)).select(*EVENT_COLUMNS)


@register("late_events")
def q_late(spark, sf_dir):
    return late_events(watermarked(spark, sf_dir)).select(*EVENT_COLUMNS, "watermark")


@register("late_rate")
def q_late_rate(spark, sf_dir):
    return late_rate(watermarked(spark, sf_dir))


# ---------------------------------------------------------------- windows, alerts, serving
#: What the snapshot's readers use: keys of the arrival order, clicks, deliveries.
CLICK_COLUMNS = ["event_id", "ingestion_time", "event_time", "event_type", "product_id", "category", "product_name",
                 "watermark", "is_late"]
DELIVERY_COLUMNS = ["order_id", "region", "carrier", "delay_minutes", "delivery_status"]


def accepted_snapshot(spark, sf_dir, deliveries: bool = False) -> DataFrame:
    """Accepted clicks (and deliveries) for queries with several branches, written
    once as Parquet below spark.checkpoint.dir: all types take part in the
    watermark, but only the rows and columns that the branches read are written."""
    types = [C.CLICK, C.DELIVERY] if deliveries else [C.CLICK]
    wm = accepted_events(watermarked(spark, sf_dir)).where(F.col("event_type").isin(*types))
    return materialize(wm.select(*CLICK_COLUMNS, *(DELIVERY_COLUMNS if deliveries else [])), "accepted")


def window_counts(wm: DataFrame) -> DataFrame:
    return sliding_click_counts(accepted_events(wm), WINDOW_MS, SLIDE_MS)


def emitted(wm: DataFrame) -> DataFrame:
    return emitted_windows(window_counts(wm), wm)


def alert_changelog(wm: DataFrame) -> DataFrame:
    return A.all_alerts(A.logistics_alerts(accepted_events(wm)),
                        A.trending_alerts(emitted(wm), HOT_THRESHOLD))


WINDOW_OUT = ["window_start", "window_end", "product_id", "clicks"]


@register("sliding_clicks")
def q_sliding(spark, sf_dir):
    return window_counts(watermarked(spark, sf_dir)).select(*WINDOW_OUT)


@register("closed_windows")
def q_closed(spark, sf_dir):
    wm = accepted_snapshot(spark, sf_dir)
    closed, _ = split_windows(window_counts(wm), wm)
    return closed.select(*WINDOW_OUT, "row_key")


@register("final_windows")
def q_final(spark, sf_dir):
    wm = accepted_snapshot(spark, sf_dir)
    _, final = split_windows(window_counts(wm), wm)
    return final.select(*WINDOW_OUT, "row_key")


@register("trending_alerts")
def q_trending(spark, sf_dir):
    wm = accepted_snapshot(spark, sf_dir)
    return A.trending_alerts(emitted(wm), HOT_THRESHOLD).drop("put_seq")


@register("logistics_alerts")
def q_logistics_alerts(spark, sf_dir):
    return A.logistics_alerts(accepted_events(watermarked(spark, sf_dir))).drop("put_seq")


@register("alerts_all")
def q_alerts_all(spark, sf_dir):
    return alert_changelog(accepted_snapshot(spark, sf_dir, deliveries=True)).drop("put_seq")


@register("alerts_kv")
def q_alerts_kv(spark, sf_dir):
    return A.alerts_kv(alert_changelog(accepted_snapshot(spark, sf_dir, deliveries=True)))


@register("alerts_json")
def q_alerts_json(spark, sf_dir):
    return A.alerts_json(alert_changelog(accepted_snapshot(spark, sf_dir, deliveries=True)))


#: Batches that the stored tables are put in; all but the last are merged into the base.
PUT_BATCHES = 3


def stored(spark: SparkSession, name: str, puts: DataFrame, cells: str, versions: int, **layout) -> KeyedTable:
    """A keyed table that holds `puts`: a merged base of the earlier batches, and the last one as a delta."""
    root = scratch_path(spark, name)
    table = KeyedTable(spark, "vitrine_keyed", f"{name}_{root.rsplit('-', 1)[-1]}", root, cells, versions, **layout).create()
    puts = materialize(puts, f"{name}-puts")
    batch = F.pmod(F.xxhash64("row_key", "put_seq"), F.lit(PUT_BATCHES))
    for i in range(PUT_BATCHES):
        if i == PUT_BATCHES - 1:
            table.merge()
        table.put(puts.where(batch == i), i)
    return table


def stored_alerts(spark, sf_dir) -> KeyedTable:
    puts = alert_changelog(accepted_snapshot(spark, sf_dir, deliveries=True))
    cells = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in puts.schema if f.name not in ("row_key", "put_seq"))
    return stored(spark, "alerts", puts, cells, C.ALERT_VERSIONS, part=by_prefix_and_time, buckets=2)


def stored_metrics(spark, sf_dir) -> KeyedTable:
    return stored(spark, "metrics", metric_puts(spark, sf_dir), "clicks_window bigint, last_window_end bigint", C.METRIC_VERSIONS)


@register("recent_alerts")
def q_recent_alerts(spark, sf_dir):
    return stored_alerts(spark, sf_dir).newest(C.LOGISTICS_ALERT_PREFIX, RECENT_ALERTS_N).select(*A.ALERT_COLUMNS)


@register("alerts_latest")
def q_alerts_latest(spark, sf_dir):
    return S.alerts_latest(alert_changelog(accepted_snapshot(spark, sf_dir, deliveries=True)))


@register("alerts_versions")
def q_alerts_versions(spark, sf_dir):
    return S.alerts_versions(alert_changelog(accepted_snapshot(spark, sf_dir, deliveries=True)))


def metric_puts(spark, sf_dir) -> DataFrame:
    return S.metric_puts(emitted(accepted_snapshot(spark, sf_dir)))


@register("metrics_latest")
def q_metrics_latest(spark, sf_dir):
    return S.metrics_latest(metric_puts(spark, sf_dir))


@register("metrics_versions")
def q_metrics_versions(spark, sf_dir):
    return S.metrics_versions(metric_puts(spark, sf_dir))


@register("metric_lookup")
def q_metric_lookup(spark, sf_dir):
    return stored_metrics(spark, sf_dir).get(LOOKUP_METRIC_KEY).drop("put_seq")


# ---------------------------------------------------------------- JSON sources
def _write_text(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").text(path)
    return path


def clean_log(spark, sf_dir) -> str:
    """The driver events as a JSON-lines log below spark.checkpoint.dir."""
    return _write_text(J.to_json_lines(events(spark, sf_dir)), scratch_path(spark, "log"))


def noisy_log(spark, sf_dir) -> str:
    return _write_text(noisy_event_log(events(spark, sf_dir)), scratch_path(spark, "noisy-log"))


@register("scan_raw_json")
def q_scan_raw_json(spark, sf_dir):
    return J.read_events_json(spark, clean_log(spark, sf_dir))


@register("scan_raw_table")
def q_scan_raw_table(spark, sf_dir):
    ev = events(spark, sf_dir)
    layout = J.landing_layout(J.to_json_lines(ev, keep=("ingestion_time",)), "ingestion_time")
    root = scratch_path(spark, "raw")
    table = "vitrine_raw_" + root.rsplit("-", 1)[-1]
    J.create_raw_table(spark, table, root, recover=False)
    J.land(spark, layout, root, table)
    return spark.table(table)


@register("scan_tolerant")
def q_scan_tolerant(spark, sf_dir):
    return J.read_tolerant(spark, noisy_log(spark, sf_dir))


@register("scan_rejects")
def q_scan_rejects(spark, sf_dir):
    return J.read_rejects(spark, noisy_log(spark, sf_dir))


@register("parse_json_lines")
def q_parse_json_lines(spark, sf_dir):
    parsed = J.parse_json_lines(noisy_event_log(events(spark, sf_dir)))
    return parsed.drop("_line")


@register("total_events")
def q_total_events(spark, sf_dir):
    return J.line_counts(spark, noisy_log(spark, sf_dir))


# ---------------------------------------------------------------- warehouse
def warehouse(spark) -> Warehouse:
    root = scratch_path(spark, "dw")
    return Warehouse(spark, "vitrine_dw_" + root.rsplit("-", 1)[-1], root).create()


@register("dw_write_funnel")
def q_dw_write_funnel(spark, sf_dir):
    wh = warehouse(spark)
    wh.write("dw_sales_funnel_daily", funnel(events(spark, sf_dir), dt=RUN_DT))
    return wh.read("dw_sales_funnel_daily")


@register("dw_write_logistics")
def q_dw_write_logistics(spark, sf_dir):
    wh = warehouse(spark)
    wh.write("dw_logistics_sla_daily", logistics_sla(events(spark, sf_dir), dt=RUN_DT))
    return wh.read("dw_logistics_sla_daily")


@register("dw_write_abandoned")
def q_dw_write_abandoned(spark, sf_dir):
    wh = warehouse(spark)
    wh.write("dw_abandoned_carts_daily", abandoned_carts(events(spark, sf_dir)))
    return wh.read("dw_abandoned_carts_daily")


@register("dw_write_path")
def q_dw_write_path(spark, sf_dir):
    path = scratch_path(spark, "dw-path")
    write_partitioned_path(funnel(events(spark, sf_dir), dt=RUN_DT), "dw_sales_funnel_daily", path)
    return read_partitioned_path(spark, "dw_sales_funnel_daily", path)


@register("dw_read_funnel_dt")
def q_dw_read_funnel_dt(spark, sf_dir):
    wh = warehouse(spark)
    wh.write("dw_sales_funnel_daily", funnel(events(spark, sf_dir), daily=True))
    return wh.read("dw_sales_funnel_daily", dt=PRUNED_DT)


# ---------------------------------------------------------------- streaming
STREAM_SLICES = 4


def arrival_slices(ev: DataFrame, n: int) -> list[DataFrame]:
    """The events cut into ``n`` consecutive ranges of arrival time, so that
    writing them one after the other replays the log in arrival order.
    Events without an arrival time come first, as in ``arrival_key_cols``."""
    arrival, _ = arrival_key_cols()
    qs = ev.approxQuantile("ingestion_time", [i / n for i in range(1, n)], 0.001)
    bounds = sorted(set(int(q) for q in qs))
    out, lo = [], None
    for b in bounds + [None]:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (arrival >= lo)
        if b is not None:
            cond = cond & (arrival < b)
        out.append(ev.where(cond))
        lo = b
    return out


def _await(*queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


@register("land_raw_stream")
def q_land_raw_stream(spark, sf_dir):
    root = scratch_path(spark, "landing")
    _write_text(noisy_event_log(events(spark, sf_dir)), f"{root}/source")
    lines = L.line_stream(spark, f"{root}/source")
    _await(L.start_landing(lines, f"{root}/landing", f"{root}/_chk/landing", once=True))
    return J.read_tolerant(spark, f"{root}/landing")


@register("fanout_counts")
def q_fanout_counts(spark, sf_dir):
    root = scratch_path(spark, "fanout")
    _write_text(noisy_event_log(events(spark, sf_dir)), f"{root}/source")
    lines = L.line_stream(spark, f"{root}/source")
    _await(L.start_landing(lines, f"{root}/landing", f"{root}/_chk/landing", once=True),
           L.start_type_counter(lines, f"{root}/counts", f"{root}/_chk/counts", once=True))
    landed = (J.read_tolerant(spark, f"{root}/landing").groupBy("event_type")
              .agg(F.count(F.lit(1)).alias("events"))
              .withColumns({"consumer": F.lit("landing"), "source_stream": F.lit(None).cast("string")}))
    streamed = L.read_type_counts(spark, f"{root}/counts").withColumn("consumer", F.lit("stream"))
    return landed.unionByName(streamed).select("consumer", "source_stream", "event_type", "events")


def stream_job(spark, sf_dir, slices: int = STREAM_SLICES, flush: bool = True, keep_accepted: bool = False) -> EventTimeJob:
    """Runs the two-stage event-time stream over the log while it arrives:
    both stages run continuously; the log is published in arrival slices
    (each written aside and renamed into the source folder, so a slice is one
    micro-batch); then end of input and, unless it is to be read live, the flush."""
    root = scratch_path(spark, "stream")
    job = EventTimeJob(spark, root, TOLERANCE_MS, WINDOW_MS, SLIDE_MS, HOT_THRESHOLD, keep_accepted=keep_accepted)
    parts = arrival_slices(events(spark, sf_dir), slices)

    def arrive(i: int) -> None:
        publish(spark, noisy_event_log(parts[i]), f"{root}/source/slice={i}", f"{root}/_staging", fmt="text")

    arrive(0)
    accept = job.start_accept(L.line_stream(spark, f"{root}/source/*/*.txt"), once=False, interval_seconds=0)
    windows = job.start_windows(once=False, interval_seconds=0)
    try:
        accept.processAllAvailable()
        for i in range(1, len(parts)):
            arrive(i)
            accept.processAllAvailable()
        windows.processAllAvailable()
    finally:
        accept.stop()
        windows.stop()
    for q in (accept, windows):
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    if flush:
        job.flush(catch_up=False)          # processAllAvailable() has just ended with nothing left
    return job


@register("stream_once")
def q_stream_once(spark, sf_dir):
    return stream_job(spark, sf_dir).windows().select(*WINDOW_OUT, "row_key")


@register("stream_follow")
def q_stream_follow(spark, sf_dir):
    """Live results (K8, K9, T6, T8): what is readable before any flush, the closed windows with their alert keys."""
    job = stream_job(spark, sf_dir, flush=False)
    trending = job.alert_puts().where(F.col("alert_type") == C.TRENDING_ALERT_TYPE) \
        .select("window_start", "product_id", F.col("row_key").alias("alert_key"))
    return job.windows().join(trending, ["window_start", "product_id"], "left").select(*WINDOW_OUT, "row_key", "alert_key")


# ---------------------------------------------------------------- daily mode, ETL job, stream serving
@register("funnel_daily")
def q_funnel_daily(spark, sf_dir):
    return funnel(events(spark, sf_dir), daily=True)


@register("logistics_sla_daily")
def q_logistics_daily(spark, sf_dir):
    return logistics_sla(events(spark, sf_dir), daily=True)


@register("batch_etl")
def q_batch_etl(spark, sf_dir):
    raw = noisy_log(spark, sf_dir)
    wh = warehouse(spark)
    return run_daily_etl(spark, raw, scratch_path(spark, "silver"), wh, dt=RUN_DT)


@register("stream_alerts_latest")
def q_stream_alerts_latest(spark, sf_dir):
    return S.alerts_latest(stream_job(spark, sf_dir).alert_puts())


@register("stream_metrics_latest")
def q_stream_metrics_latest(spark, sf_dir):
    return S.metrics_latest(stream_job(spark, sf_dir).metric_puts())


@register("stream_late_rate")
def q_stream_late_rate(spark, sf_dir):
    """Counters that the accept stage commits with its batches; nothing is read again."""
    return with_late_pct(stream_job(spark, sf_dir, flush=False).counters())


#: Bytes of a landed file in the registered query: small, so that files roll at every scale.
ROLL_BYTES = 64 << 10


@register("land_rolled")
def q_land_rolled(spark, sf_dir):
    """Landing with byte roll and manifests (K2), then the small files of the idle days merged."""
    root = scratch_path(spark, "rolled")
    for i, part in enumerate(arrival_slices(events(spark, sf_dir), STREAM_SLICES)):
        _write_text(noisy_event_log(part), f"{root}/source/slice={i}")
        _await(start_rolled(spark, L.line_stream(spark, f"{root}/source/*/*.txt"), f"{root}/landing", f"{root}/_chk", ROLL_BYTES, once=True))
    merge_idle(spark, f"{root}/landing", 0, ROLL_BYTES)
    return J.good_events(J.parse_json_lines(read_landed(spark, f"{root}/landing")))


# ---------------------------------------------------------------- files that grow
GROWING_LOGS = 4


def append_to_logs(spark: SparkSession, root: str, part: DataFrame | None) -> None:
    """A producer: appends the lines of `part`, in arrival order, to ``GROWING_LOGS`` files (users are dealt over
    them), a task each.  The last line stays half written until the next call; None ends all lines."""
    folder = local_path(root)
    schema = "log int, lines long"
    if part is None:
        lines = spark.range(0).selectExpr("cast(null AS string) AS value", "0 AS log")
    else:
        lines = noisy_event_log(part.repartitionById(GROWING_LOGS, F.pmod(F.xxhash64("user_id"), F.lit(GROWING_LOGS)).cast("int"))
                                .sortWithinPartitions("ingestion_time", "event_id")).selectExpr("value", "spark_partition_id() AS log")
    os.makedirs(folder, exist_ok=True)

    def append(batches):
        for batch in batches:
            for log in sorted(set(batch.column("log").to_pylist())):
                own = [v for v, k in zip(batch.column("value").to_pylist(), batch.column("log").to_pylist()) if k == log]
                path = f"{folder}/events-{log}.log"
                data = b"".join(v.encode() + b"\n" for v in own)
                rest = f"{folder}/half-{log}"                # (not a name that a rotated log would have)
                if os.path.exists(rest):
                    with open(rest, "rb") as f:
                        data = f.read() + data
                cut = len(data) - min(len(data), 9)          # inside the last line, or behind an empty one
                with open(path, "ab") as f:
                    f.write(data[:cut])
                with open(rest, "wb") as f:
                    f.write(data[cut:])
                yield pa.RecordBatch.from_arrays([pa.array([log], pa.int32()), pa.array([len(own)], pa.int64())], ["log", "lines"])

    lines.mapInArrow(append, schema).write.format("noop").mode("overwrite").save()
    if part is None:
        for path in glob.glob(f"{folder}/half-*"):
            with open(path, "rb") as f, open(f"{folder}/events-{path.rsplit('-', 1)[1]}.log", "ab") as log:
                log.write(f.read())
            os.remove(path)


@register("stream_tail")
def q_stream_tail(spark, sf_dir):
    """Log files that grow while they are landed (S4, S5): slices end inside a line, and the query restarts in between."""
    root = scratch_path(spark, "tail")
    parts = arrival_slices(events(spark, sf_dir), STREAM_SLICES)
    for step in (parts[:1], parts[1:3], parts[3:] + [None]):
        append_to_logs(spark, f"{root}/logs", step[0])
        query = L.start_landing(tail_stream(spark, f"{root}/logs/*.log"), f"{root}/landing", f"{root}/_chk/landing", interval_seconds=0)
        try:
            query.processAllAvailable()
            for part in step[1:]:
                append_to_logs(spark, f"{root}/logs", part)
                query.processAllAvailable()
        finally:
            query.stop()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return J.read_tolerant(spark, f"{root}/landing")
