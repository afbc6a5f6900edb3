"""JSON-lines event sources (S1, S2, S3, F8, F9) and the landing-zone
layout (K1 in batch form).

Parsing is ``text -> from_json`` with an explicit schema and a corrupt-record
column, for three reasons: no inference pass, malformed lines can be counted
and quarantined (Spark refuses queries that reference only the corrupt column
of a raw JSON scan), and the same expression serves batch and streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.columns import date_parts, epoch_ms_to_ts, non_blank
from vitrine.schemas import (CORRUPT_COLUMN, EVENT_COLUMNS, EVENT_SCHEMA,
                             EVENT_SCHEMA_WITH_CORRUPT, RAW_TABLE_COLUMNS)

PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def to_json_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events -> one JSON object per row in ``value``; NULL fields omitted
    (each event type carries only its own keys).  ``keep`` columns ride along."""
    return events.select(F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS])).alias("value"), *keep)


def parse_json_lines(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Non-blank lines parsed against EVENT_SCHEMA; keeps the raw line and a
    ``_corrupt_record`` that is set for malformed, non-object or wrongly typed
    lines.  Blank lines are dropped (they are not rejects).  ``keep`` columns
    of the lines ride along."""
    parsed = F.from_json(F.col(line_col), EVENT_SCHEMA_WITH_CORRUPT, PARSE_OPTIONS)
    return (lines.where(non_blank(line_col))
            .select(F.col(line_col).alias("_line"), *keep, parsed.alias("_j"))
            .select("_line", *keep, "_j.*"))


def good_events(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COLUMN).isNull()).select(*EVENT_COLUMNS, *keep)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COLUMN).isNotNull()).select(F.col("_line").alias("line"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_events_json(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan with the explicit schema (S1): files or a directory."""
    return spark.read.schema(EVENT_SCHEMA).json(path)


def read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Blank and malformed lines skipped (S3)."""
    return good_events(parse_json_lines(read_lines(spark, path)))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine output: malformed lines, verbatim."""
    return rejected_lines(parse_json_lines(read_lines(spark, path)))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Loaded-record counters (G1, Q1): good and rejected reported apart;
    ``total_events`` = good + rejected, what a permissive JSON scan counts."""
    lines = read_lines(spark, path)
    parsed = F.from_json(F.col("value"), EVENT_SCHEMA_WITH_CORRUPT, PARSE_OPTIONS)
    blank = ~non_blank("value")
    bad = F.col("_j." + CORRUPT_COLUMN).isNotNull()
    return (lines.select(blank.alias("_blank"), F.when(~blank, parsed).alias("_j"))
            .agg(F.count(F.when(~F.col("_blank"), 1)).alias("total_events"),
                 F.count(F.when(~F.col("_blank") & ~bad, 1)).alias("good_events"),
                 F.count(F.when(~F.col("_blank") & bad, 1)).alias("rejected_events"),
                 F.count(F.when(F.col("_blank"), 1)).alias("blank_lines")))


# ------------------------------------------------------------- landing zone
def landing_layout(lines: DataFrame, arrival_ms_col: str | None = None) -> DataFrame:
    """Raw line text plus ``year``/``month``/``day`` of the arrival time
    (``arrival_ms_col``) or of the wall clock when None (K1, F7)."""
    ts = F.current_timestamp() if arrival_ms_col is None else epoch_ms_to_ts(arrival_ms_col)
    return lines.select("value", *date_parts(ts))


def write_landing(layout: DataFrame, path: str) -> None:
    """Text files under ``year=/month=/day=``; reruns of a day replace it."""
    (layout.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day").text(path))


def land(spark: SparkSession, layout: DataFrame, path: str, table: str) -> None:
    """Writes one load to the landing zone and registers its days with the table.

    Only the days of this load are named (a row per day comes to the driver), so the zone is
    never listed, however many days it holds."""
    days = layout.select("year", "month", "day").distinct().collect()
    write_landing(layout, path)
    for lo in range(0, len(days), 100):
        named = " ".join(f"PARTITION (year='{d.year}', month='{d.month}', day='{d.day}')" for d in days[lo:lo + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {named}")


def create_raw_table(spark: SparkSession, table: str, location: str, recover: bool = True) -> None:
    """External table over the landing zone (S2): the declared 20 columns
    plus the ``year/month/day`` partitions.  ``recover``: those of a zone that exists are
    discovered from its folders, once; later loads register theirs (``land``)."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields
                     if f.name in RAW_TABLE_COLUMNS)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"""CREATE TABLE {table} ({cols}, year STRING, month STRING, day STRING)
                  USING json PARTITIONED BY (year, month, day) LOCATION '{location}'""")
    if recover:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
