"""Exact per-record watermark in arrival order and the late filter.

The streaming rule is sequential: for each record in arrival order
``wm = max(wm, event_time - tolerance)`` (starting at 0), then the record is
late when ``event_time < wm``.  That is a prefix maximum over a total order,
arrival = (ingestion_time, event_id, hash of the row), NULLs first.

It is computed without putting all rows in one order, and rows are shuffled once:

1. *Bounds.*  A sketch of the rows (in each slot of a hash, the key with the least hash; with
   map-side combine) gives bounds that cut the arrival order into ranges of about
   ``ROWS_PER_RANGE`` rows.  Only the bounds, at most ``MOST_RANGES`` keys, come to the driver.
2. *Ranges.*  Each row finds its range by binary search.  A bound's own key is a range of
   its own.  Rows of one key are the same row repeated, so their order does not matter: a
   hot one, which is a bound because the sketch goes by rows, is dealt over ``SALTS`` tasks.
3. *Maxima.*  The largest candidate of each range, and a window over the ranges.
4. *Prefix.*  The rows, dealt by range, get the running maximum within their range, and join
   what the earlier ranges reached (a broadcast of one short row per range).

Nothing joins the rows with themselves, no row holds an array, and there is no Python.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from vitrine import constants as C

LONG_MIN = -(2 ** 63)
#: Rows of one range, and how many ranges there are at most; up to ROWS_IN_ONE rows are not cut at all.
ROWS_PER_RANGE = 1 << 20
LEAST_RANGES, MOST_RANGES = 32, 1 << 16
ROWS_IN_ONE = 1 << 14
#: Slots of the first sketch.  A larger input is sketched again, with SAMPLES slots for each range.
SKETCH_SLOTS, SAMPLES = 1 << 12, 4
#: Tasks that the repeated rows of one key are dealt to.
SALTS = 64
_KEY = "struct<t:bigint,e:string,h:bigint>"


def arrival_key_cols() -> tuple[Column, Column]:
    """(time, id) of the arrival order; NULLs sort first."""
    return (F.coalesce(F.col("ingestion_time"), F.lit(LONG_MIN)),
            F.coalesce(F.col("event_id"), F.lit("")))


def event_time_or_arrival() -> Column:
    """``event_time``, else ``ingestion_time`` (deterministic on replays)."""
    return F.coalesce(F.col("event_time"), F.col("ingestion_time"))


def _sketch(keys: DataFrame, slots: int, rows_per_range: int) -> Row:
    """``n`` rows, and ``cuts``: keys in order, every so many rows of a uniform sample."""
    place = F.xxhash64("_key", F.monotonically_increasing_id())
    slot = (keys.select("_key", place.alias("_hash")).groupBy(F.col("_hash").bitwiseAND(F.lit(slots - 1)))
            .agg(F.min_by("_key", "_hash").alias("_cut"), F.count(F.lit(1)).alias("_n")))
    found = slot.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.array_sort(F.collect_list("_cut")).alias("cuts"))
    ranges = F.greatest(F.lit(LEAST_RANGES), F.least(F.lit(MOST_RANGES), F.ceil(F.col("n") / F.lit(rows_per_range))))
    step = F.greatest(F.lit(1), F.floor(F.size("cuts") / ranges))
    thinned = F.array_distinct(F.filter("cuts", lambda _, i: (i + 1) % step == 0))
    return found.select("n", F.when(F.col("n") > ROWS_IN_ONE, thinned).otherwise(F.array().cast(f"array<{_KEY}>")).alias("cuts")).first()


def range_bounds(keys: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> list[Row]:
    """Keys that cut the order of ``_key`` into ranges of about as many rows each."""
    found = _sketch(keys, SKETCH_SLOTS, rows_per_range)
    wanted = min(MOST_RANGES, -(-found.n // rows_per_range))
    if SAMPLES * wanted > SKETCH_SLOTS:
        found = _sketch(keys, 1 << (SAMPLES * wanted - 1).bit_length(), rows_per_range)
    return found.cuts


def with_range(rows: DataFrame, bounds: list[Row]) -> DataFrame:
    """``rows`` with ``_range``: 2 p for the key of bound p, 2 p + 1 for those between it and the next."""
    cuts = F.from_json(F.lit(json.dumps([b.asDict() for b in bounds])), f"array<{_KEY}>")          # a constant of the plan
    halves = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))])
    place = F.aggregate(halves, F.lit(0), lambda at, half: at + F.when(F.get(cuts, at + half - 1) <= F.col("_key"), half).otherwise(0))
    at = rows.withColumn("_place", F.coalesce(place, F.lit(0)))
    own = F.coalesce(F.get(cuts, F.col("_place") - 1) == F.col("_key"), F.lit(False))
    return at.withColumn("_range", 2 * F.col("_place") + F.when(own, 0).otherwise(1)).drop("_place")


def earlier_maxima(ranged: DataFrame) -> DataFrame:
    """(``_range``, ``_above``): the largest ``_cand`` of all earlier ranges; a row per range."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.groupBy("_range").agg(F.max("_cand").alias("_max")).select("_range", F.max("_max").over(earlier).alias("_above"))


def with_arrival_watermark(df: DataFrame, tolerance_ms: int = C.MAX_ALLOWED_DELAY_MS,
                           carried_watermark: Column | int | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``watermark`` (after this record's update) and ``is_late``.

    ``event_time`` NULL falls back to ``ingestion_time``; a record with neither is
    accepted and moves nothing.  ``carried_watermark`` is the watermark reached by
    earlier input (streaming micro-batches); default 0.  The bounds of the ranges are
    taken here, in a job that reads the keys.
    """
    et = event_time_or_arrival()
    staged = df.withColumns({"_key": F.struct(F.col("ingestion_time").alias("t"), F.col("event_id").alias("e"),
                                              F.xxhash64(*df.columns).alias("h")),
                             "_cand": et - F.lit(tolerance_ms)})
    bounds = range_bounds(staged.select("_key"), rows_per_range)
    order = [F.col("ingestion_time").asc_nulls_first(), F.col("event_id").asc_nulls_first(), F.col("_hash")]
    if bounds:
        ranged = with_range(staged, bounds)
        above = earlier_maxima(ranged.select("_range", "_cand"))
        salt = F.when(F.col("_range") % 2 == 0, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0)
        rows = ranged.withColumns({"_salt": salt.cast("int"), "_hash": F.col("_key.h")}).drop("_key")
        dealt = Window.partitionBy("_range", "_salt")
    else:
        rows = staged.withColumn("_hash", F.col("_key.h")).drop("_key")
        dealt = Window.partitionBy()
    so_far = dealt.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_within", F.max("_cand").over(so_far)).drop("_cand", "_hash")
    if bounds:
        rows = rows.join(F.broadcast(above), "_range").withColumn("_within", F.greatest("_within", "_above")).drop("_range", "_salt", "_above")
    start = carried_watermark if isinstance(carried_watermark, Column) else F.lit(carried_watermark or 0)
    return (rows.withColumn("watermark", F.greatest(start.cast("long"), F.col("_within")))
            .withColumn("is_late", F.coalesce(et < F.col("watermark"), F.lit(False))).drop("_within"))


def accepted_events(with_wm: DataFrame) -> DataFrame:
    return with_wm.where(~F.col("is_late"))


def late_events(with_wm: DataFrame) -> DataFrame:
    return with_wm.where(F.col("is_late"))


def late_rate(with_wm: DataFrame) -> DataFrame:
    """Late counters per event type (T9) next to the producer's flag (Q2)."""
    late, flagged = F.col("is_late"), F.col("is_simulated_late")
    return with_late_pct(with_wm.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_events"), F.count(F.when(late, 1)).alias("late_events"),
        F.count(F.when(flagged, 1)).alias("flagged_late"), F.count(F.when(late & flagged, 1)).alias("flagged_and_late")))


def with_late_pct(counted: DataFrame) -> DataFrame:
    return counted.withColumn("late_pct", F.round(F.col("late_events") / F.col("total_events") * 100, 2))
