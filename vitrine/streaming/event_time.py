"""Event-time stream: exact late filter, sliding windows, alerts, flush
(T1-T9, K8, K9) as two Structured Streaming queries.

Stage A (accept), ``foreachBatch`` over the line source:
  parse -> quarantine rejects -> exact per-record watermark within the batch,
  starting from the watermark carried from earlier batches -> publish
  ``accepted``/``late``/logistics alerts for the batch -> commit the batch's
  state row: running watermark, last click's watermark, and the record counters
  of the whole stream, observed while the batch is written.  The carried values of
  batch N are those of the last commit with id < N, so a replayed batch computes
  the same result; a batch whose output is already complete is not rewritten (a
  downstream file source would read rewritten files again).

Stage B (windows), a native stateful aggregate over the accepted clicks:
  ``withWatermark`` + ``groupBy(window(ts, size, slide), product_id)`` in
  append mode.  Only clicks move its watermark, by the same tolerance, so it never
  passes the exact watermark at the last accepted click: it drops no
  accepted click, and every window that it emits is closed.  Emitted windows
  become metric puts and trending alerts.

Flush (T7): Spark does not emit still-open windows at end of input.  They are read
from the aggregate's state with Spark's state reader, not recounted.  Closed vs FINAL
follows the per-record rule: closed iff ``end <= watermark at the last accepted click``.

What a batch costs does not grow with the stream's life: state rows of old batches
go, and accepted files go once stage B has committed the batch that read them
(``keep_accepted`` keeps them).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine import constants as C
from vitrine.functions.columns import epoch_ms_to_ts, row_key
from vitrine.functions.defaults import stream_defaults
from vitrine.operators import alerts as A
from vitrine.operators.lateness import event_time_or_arrival, with_arrival_watermark
from vitrine.operators.windows import check_window
from vitrine.schemas import EVENT_SCHEMA
from vitrine.sources.json_lines import good_events, parse_json_lines, rejected_lines
from vitrine.streaming.files import child_names, delete, exists, publish, publish_parts
from vitrine.streaming.landing import trigger_kwargs

ACCEPTED_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField("watermark", T.LongType())])
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTERS = ["total_events", "late_events", "flagged_late", "flagged_and_late"]
_COUNTER_SCHEMA = "array<struct<event_type:string," + ",".join(f"{c}:bigint" for c in COUNTERS) + ">>"
WM_STATE_SCHEMA = f"wm_end long, click_wm long, batch_id long, counters {_COUNTER_SCHEMA}"
WINDOW_SCHEMA = ("window_start long, window_end long, product_id string, clicks long, "
                 "category string, product_name string")
#: Event types that are counted apart; every other one is counted under NULL.
COUNTED_TYPES = [C.CLICK, C.CART_ADD, C.CART_REMOVE, C.CHECKOUT, C.DELIVERY]
#: Commit rows and folders of accepted files that stay behind the newest batch.
KEPT_BATCHES = 10


class EventTimeJob:
    def __init__(self, spark: SparkSession, root: str, tolerance_ms: int = C.MAX_ALLOWED_DELAY_MS,
                 size_ms: int = C.WINDOW_SIZE_MS, slide_ms: int = C.WINDOW_SLIDE_MS,
                 threshold: int = C.HOT_PRODUCT_THRESHOLD,
                 state_store: str | None = ROCKSDB_PROVIDER, state_partitions: int | None = None,
                 keep_accepted: bool = False, fail_after: str | None = None):
        check_window(size_ms, slide_ms)
        self.spark, self.root = spark, root.rstrip("/")
        self.tol, self.size, self.slide, self.threshold = tolerance_ms, size_ms, slide_ms, threshold
        self.state_store = state_store
        self.state_partitions = state_partitions
        self.keep_accepted = keep_accepted
        self.fail_after = fail_after          # fault injection for tests

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # ------------------------------------------------------------ state
    def _wm_state(self) -> DataFrame:
        return self.spark.read.schema(WM_STATE_SCHEMA).parquet(self.path("wm_state"))

    def _has_state(self) -> bool:
        return exists(self.spark, self.path("wm_state"))

    def _batch_ids(self, name: str) -> list[int]:
        names = child_names(self.spark, self.path(name))
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))

    def _committed_ids(self) -> list[int]:
        return self._batch_ids("wm_state")

    def _last_state(self, before: int | None = None):
        """The commit row of the latest committed batch (with id < ``before``).

        Rows are cumulative (running watermark, last click's watermark, counters), so one
        small file is read, and old ones are deleted, so few are listed."""
        ids = [i for i in self._committed_ids() if before is None or i < before]
        if not ids:
            return None
        return (self.spark.read.schema(WM_STATE_SCHEMA)
                .parquet(self.path("wm_state", f"batch_id={ids[-1]}")).first())

    def _forget(self, batch_id: int) -> None:
        """Deletes commit rows of batches long before this one, and their folders of accepted files that stage B has emptied."""
        for i in self._committed_ids():
            if i < batch_id - KEPT_BATCHES:
                delete(self.spark, self.path("wm_state", f"batch_id={i}"))
        if not self.keep_accepted:
            for i in self._batch_ids("accepted"):
                folder = self.path("accepted", f"batch_id={i}")
                if i < batch_id - KEPT_BATCHES and not [n for n in child_names(self.spark, folder) if n.endswith(".parquet")]:
                    delete(self.spark, folder)

    def carried_watermark(self, batch_id: int) -> int:
        row = self._last_state(before=batch_id)
        return int(row.wm_end) if row is not None and row.wm_end is not None else 0

    def close_watermark(self) -> int | None:
        """Watermark right after the last accepted CLICK so far."""
        row = self._last_state()
        return None if row is None or row.click_wm is None else int(row.click_wm)

    def counters(self) -> DataFrame:
        """Record counters per event type of all committed batches (T9, Q1, Q2), from the last commit row alone."""
        row = self._last_state()
        counted = [] if row is None else [tuple(c) for c in row.counters if c.total_events]
        return self.spark.createDataFrame(counted, "event_type string, " + ", ".join(f"{c} long" for c in COUNTERS))

    # ------------------------------------------------------------ stage A
    def accept_batch(self, lines: DataFrame, batch_id: int) -> None:
        out = {name: self.path(name, f"batch_id={batch_id}")
               for name in ("accepted", "late", "rejects", "alert_puts", "wm_state")}
        if exists(self.spark, out["wm_state"]):
            return                                  # replay of a committed batch
        staging = self.path("_staging")
        parsed = parse_json_lines(lines.select("value")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            previous = self._last_state(before=batch_id)
            carried = int(previous.wm_end) if previous is not None and previous.wm_end is not None else 0
            events = good_events(parsed).withColumn("event_time", event_time_or_arrival())
            wm = with_arrival_watermark(events, self.tol, carried_watermark=carried)
            wm = wm.persist(StorageLevel.MEMORY_AND_DISK)
            # Each output appears atomically and only once; a replay after a
            # crash between these steps recomputes identical data and skips
            # what is already published.  Accepted and late rows go out in one
            # write, during which the batch's state is observed.
            seen = Observation(f"batch-{batch_id}")
            written = publish_parts(self.spark, wm.observe(seen, *self._observed()), "is_late",
                                    {"false": out["accepted"], "true": out["late"]}, staging)
            found = seen.get if written else wm.agg(*self._observed()).first().asDict()
            publish(self.spark, rejected_lines(parsed), out["rejects"], staging)
            publish(self.spark, A.logistics_alerts(wm.where(~F.col("is_late")))
                    .withColumn("batch_id", F.lit(batch_id).cast("long")), out["alert_puts"], staging)
            if self.fail_after == "publish":
                raise RuntimeError("injected failure after publishing the batch")
            publish(self.spark, self._state_row(found, previous, carried, batch_id), out["wm_state"], staging)   # the commit record
            self._forget(batch_id)
            wm.unpersist()
        finally:
            parsed.unpersist()

    @staticmethod
    def _observed() -> list[Column]:
        """What the commit row needs of a batch, in one pass: the watermarks reached, and counts per event type."""
        late = F.col("is_late")
        flagged = F.coalesce(F.col("is_simulated_late"), F.lit(False))
        kinds = [F.col("event_type") == t for t in COUNTED_TYPES]
        kinds.append(~F.coalesce(F.col("event_type").isin(*COUNTED_TYPES), F.lit(False)))
        whether = dict(zip(COUNTERS, (F.lit(True), late, flagged, late & flagged)))
        click = (F.col("event_type") == C.CLICK) & ~late
        return [F.max("watermark").alias("wm_end"), F.max(F.when(click, F.col("watermark"))).alias("click_wm"),
                *[F.count(F.when(kind & cond, 1)).alias(f"{name}_{k}") for k, kind in enumerate(kinds) for name, cond in whether.items()]]

    def _state_row(self, found: dict, previous, carried: int, batch_id: int) -> DataFrame:
        """The cumulative row after a batch."""
        before = None if previous is None else previous.click_wm
        clicks = [w for w in (before, found["click_wm"]) if w is not None]
        counters = [(t, *[found[f"{name}_{k}"] + (0 if previous is None else previous.counters[k][name]) for name in COUNTERS])
                    for k, t in enumerate([*COUNTED_TYPES, None])]
        row = (max(carried, found["wm_end"] or 0), max(clicks) if clicks else None, batch_id, counters)
        return self.spark.createDataFrame([row], WM_STATE_SCHEMA).coalesce(1)

    def start_accept(self, lines: DataFrame, once: bool = True, interval_seconds: int = 10):
        return (lines.writeStream.foreachBatch(self.accept_batch)
                .option("checkpointLocation", self.path("_chk", "accept"))
                .trigger(**trigger_kwargs(once, interval_seconds)).start())

    # ------------------------------------------------------------ stage B
    def window_stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(ACCEPTED_SCHEMA)
        if not self.keep_accepted:
            reader = reader.option("cleanSource", "delete")
        defaults = stream_defaults()
        clicks = (reader.parquet(self.path("accepted", "*", "*.parquet")).where(F.col("event_type") == C.CLICK)
                  .select("event_time", "product_id", *[defaults[c].alias(c) for c in ("category", "product_name")])
                  .withColumn("ts", epoch_ms_to_ts("event_time"))
                  .withWatermark("ts", f"{self.tol} milliseconds"))
        win = F.window("ts", f"{self.size} milliseconds", f"{self.slide} milliseconds")
        return (clicks.groupBy(win.alias("w"), "product_id")
                .agg(F.count(F.lit(1)).alias("clicks"), F.max(F.struct("event_time", "category")).alias("c"),   # (the state's fields are
                     F.max_by("product_name", F.struct("event_time", "product_name")).alias("product_name"))    # named after the functions)
                .select(*self._window_columns()))

    @staticmethod
    def _window_columns() -> list[Column]:
        return [F.unix_millis(F.col("w.start")).alias("window_start"), F.unix_millis(F.col("w.end")).alias("window_end"),
                F.col("product_id"), F.col("clicks"), F.col("c.category").alias("category"), F.col("product_name")]

    def emit_batch(self, windows: DataFrame, batch_id: int) -> None:
        """Windows that Spark closed in this micro-batch.  Its watermark is the largest click's event time less the
        tolerance, which the exact one has reached, so they are closed by the per-record rule too."""
        (windows.withColumn("row_key", row_key(F.col("category"), F.col("product_id")))
         .withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(self.path("native", f"batch_id={batch_id}")))

    def start_windows(self, once: bool = True, interval_seconds: int = 10):
        """Starts the stateful window query.  Its state-store settings are
        fixed in the checkpoint at the first start: window state in RocksDB
        (it grows with windows x products) split into ``state_partitions``
        (default: the cluster's cores), independent of the session's
        ``spark.sql.shuffle.partitions``."""
        writer = (self.window_stream().writeStream.outputMode("append").foreachBatch(self.emit_batch)
                  .option("checkpointLocation", self.path("_chk", "windows"))
                  .trigger(**trigger_kwargs(once, interval_seconds)))
        scoped = {"spark.sql.shuffle.partitions":
                  str(self.state_partitions or self.spark.sparkContext.defaultParallelism)}
        if self.state_store:
            scoped["spark.sql.streaming.stateStore.providerClass"] = self.state_store
        before = {k: self.spark.conf.get(k) for k in scoped}
        for k, v in scoped.items():
            self.spark.conf.set(k, v)
        try:
            return writer.start()
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)

    # ------------------------------------------------------------ flush
    def accepted(self) -> DataFrame:
        """Accepted events: all with ``keep_accepted``, else those that stage B has not deleted."""
        return self.spark.read.schema(ACCEPTED_SCHEMA).parquet(self.path("accepted", "*", "*.parquet"))

    def late(self) -> DataFrame:
        """Late events of every batch (the side output of the late filter)."""
        if not exists(self.spark, self.path("late")):
            return self.spark.createDataFrame([], ACCEPTED_SCHEMA)
        return self.spark.read.schema(ACCEPTED_SCHEMA).parquet(self.path("late", "*", "*.parquet"))

    def native(self) -> DataFrame:
        """Windows published by the window stage (all closed)."""
        return self.spark.read.schema(
            WINDOW_SCHEMA + ", row_key string, batch_id long").parquet(self.path("native"))

    def open_windows(self) -> DataFrame:
        """Windows that stage B has not emitted, read from its state."""
        chk = self.path("_chk", "windows")
        if not exists(self.spark, chk + "/state"):
            return self.spark.createDataFrame([], WINDOW_SCHEMA)
        state = self.spark.read.format("statestore").load(chk)
        name = next(f.name for f in state.schema["value"].dataType.fields if isinstance(f.dataType, T.StringType))
        flat = state.select("key.*", F.col("value.count").alias("clicks"), F.col("value.max").alias("c"),
                            F.col(f"value.{name}").alias("product_name")).withColumnRenamed("window", "w")
        return flat.select(*self._window_columns())

    def flush(self, catch_up: bool = True) -> None:
        """End of input (T7): the windows still open, labelled closed / FINAL by the final close watermark.

        ``catch_up``: stage B, which must be stopped, first reads what is left of the accepted files."""
        if catch_up and exists(self.spark, self.path("accepted")):
            query = self.start_windows(once=True)
            query.awaitTermination()
        close_wm = self.close_watermark()
        closed = F.lit(False) if close_wm is None else F.col("window_end") <= F.lit(close_wm)
        (self.open_windows().select("window_start", "window_end", "product_id", "clicks", "category", "product_name",
                                    F.when(closed, row_key(F.col("category"), F.col("product_id")))
                                    .otherwise(row_key(F.lit(C.FINAL_METRIC_PREFIX), F.col("product_id"))).alias("row_key"),
                                    (~closed).alias("is_final"))
         .write.mode("overwrite").parquet(self.path("flushed")))

    # ------------------------------------------------------------ results
    def windows(self) -> DataFrame:
        """Every window emitted so far: published ones, and after the end of input
        the flushed ones.  Readable at any time of a running stream."""
        columns = ["window_start", "window_end", "product_id", "clicks", "category", "product_name", "row_key", "is_final"]
        out = self.spark.createDataFrame([], WINDOW_SCHEMA + ", row_key string, is_final boolean").select(*columns)
        if exists(self.spark, self.path("native")):
            out = out.unionByName(self.native().withColumn("is_final", F.lit(False)).select(*columns))
        if exists(self.spark, self.path("flushed")):
            out = out.unionByName(self.spark.read.parquet(self.path("flushed")).select(*columns))
        return out

    def metric_puts(self) -> DataFrame:
        return self.windows().select("row_key", F.col("clicks").alias("clicks_window"),
                                     F.col("window_end").alias("last_window_end"),
                                     F.col("window_end").alias("put_seq"))

    def alert_puts(self) -> DataFrame:
        trending = A.trending_alerts(self.windows(), self.threshold)
        if not exists(self.spark, self.path("alert_puts")):
            return A.all_alerts(A.logistics_alerts(self.spark.createDataFrame([], EVENT_SCHEMA)), trending)
        return A.all_alerts(self.spark.read.parquet(self.path("alert_puts")).drop("batch_id"), trending)


def start_native_only(spark: SparkSession, lines: DataFrame, out_dir: str, checkpoint: str,
                      tolerance_ms: int = C.MAX_ALLOWED_DELAY_MS, size_ms: int = C.WINDOW_SIZE_MS,
                      slide_ms: int = C.WINDOW_SLIDE_MS, once: bool = True):
    """Native-only mode: Spark's own watermark, no exact pre-filter.

    Cheaper (one streaming query, no per-batch scan), but NOT the per-record
    rule: Spark advances its watermark between micro-batches and drops a late
    click only once all of its windows have expired, so this mode keeps more
    late events than the exact job.  Emitted windows go to ``out_dir``.
    """
    check_window(size_ms, slide_ms)
    events = (good_events(parse_json_lines(lines.select("value")))
              .withColumn("ts", epoch_ms_to_ts(F.coalesce(F.col("event_time"), F.col("ingestion_time"))))
              .withWatermark("ts", f"{tolerance_ms} milliseconds"))
    win = F.window("ts", f"{size_ms} milliseconds", f"{slide_ms} milliseconds")
    counts = (events.where(F.col("event_type") == C.CLICK)
              .groupBy(win.alias("w"), "product_id").agg(F.count(F.lit(1)).alias("clicks"))
              .select(F.unix_millis(F.col("w.start")).alias("window_start"),
                      F.unix_millis(F.col("w.end")).alias("window_end"), "product_id", "clicks"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return (counts.writeStream.outputMode("append").foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(once)).start())


def rows_dropped_by_watermark(query) -> int:
    """Late-row counter of a native-watermark query (T9): rows its stateful
    operators dropped as too late, summed over the retained progress reports."""
    total = 0
    for progress in query.recentProgress:
        for op in progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators:
            value = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(value or 0)
    return total
