"""Ingestion streams: raw landing zone and replicating fan-out.

* Landing: ``readStream.text`` -> ``year=/month=/day=`` of the wall clock at
  ingestion -> text files.  Roll policy = trigger interval (60 s) plus
  ``maxRecordsPerFile``; Spark has no byte-exact roll.
* Fan-out: every consumer is its own streaming query with its own checkpoint
  over the same source, so each sees every event and a crash of one does not
  lose or duplicate the other's data (what the memory channels could not
  guarantee).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine import constants as C
from vitrine.functions.columns import date_parts
from vitrine.sources.json_lines import good_events, parse_json_lines


def trigger_kwargs(once: bool, interval_seconds: int = C.LANDING_ROLL_SECONDS) -> dict:
    """Follow forever (processing-time trigger) or stop at end of input."""
    return {"availableNow": True} if once else {"processingTime": f"{interval_seconds} seconds"}


def wait_for_path(spark: SparkSession, path: str, timeout_s: float, poll_s: float = 1.0) -> None:
    """Block until ``path`` exists (the source waits for its input, S4)."""
    import time

    from vitrine.streaming.files import exists
    deadline = time.monotonic() + timeout_s
    while not exists(spark, path):
        if time.monotonic() > deadline:
            raise TimeoutError(f"{path} did not appear within {timeout_s} s")
        time.sleep(poll_s)


def line_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None,
                wait_seconds: float | None = None) -> DataFrame:
    """Continuous line source over immutable files; the checkpoint keeps the
    read position (S4, S5).  Tagged with the source header (S6).
    ``wait_seconds``: wait that long for a plain (non-glob) source folder."""
    if wait_seconds and not any(ch in source for ch in "*?["):
        wait_for_path(spark, source, wait_seconds)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source).withColumn("source_stream", F.lit(C.SOURCE_STREAM_TAG))


def start_landing(lines: DataFrame, landing_dir: str, checkpoint: str, once: bool = False,
                  max_records_per_file: int = C.LANDING_ROLL_RECORDS,
                  interval_seconds: int = C.LANDING_ROLL_SECONDS) -> StreamingQuery:
    """Raw line text to ``landing_dir/year=YYYY/month=MM/day=DD`` (K1, K2).  Files roll with
    the trigger and at ``max_records_per_file`` (0: by the trigger alone)."""
    layout = lines.select("value", *date_parts(F.current_timestamp()))
    writer = (layout.writeStream.format("text").outputMode("append")
              .option("path", landing_dir).option("checkpointLocation", checkpoint)
              .partitionBy("year", "month", "day"))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    return writer.trigger(**trigger_kwargs(once, interval_seconds)).start()


def start_type_counter(lines: DataFrame, out_dir: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Second consumer of the fan-out: per micro-batch, good events counted
    per (source_stream, event_type), appended as partial counts.  Readers sum
    them; a replayed batch overwrites its own folder (idempotent)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_json_lines(batch.select("value", "source_stream"), keep=("source_stream",))
        counts = (good_events(parsed, keep=("source_stream",)).groupBy("source_stream", "event_type")
                  .agg(F.count(F.lit(1)).alias("events")))
        counts.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return (lines.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once)).start())


def read_type_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    return (spark.read.schema("event_type string, events long, source_stream string, batch_id long")
            .parquet(out_dir)
            .groupBy("source_stream", "event_type").agg(F.sum("events").alias("events")))
