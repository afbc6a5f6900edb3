"""Sliding event-time windows over accepted clicks.

Counts per (window, product) use Spark's own ``window()``: each click is
expanded to ``size/slide`` epoch-aligned windows ``[start, end)`` and counted
with a partial + final hash aggregate, so a hot product costs one row per
(window, map task) in the shuffle.

Closing: the streaming rule closes a window when ``end <= watermark`` while
handling an accepted CLICK; anything still open at end of input is flushed as
FINAL.  An accepted click can never reopen a closed window (its windows all
end after the watermark), so the split needs only one number: the watermark
at the last accepted click in arrival order, a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C
from vitrine.functions.columns import row_key
from vitrine.functions.defaults import stream_defaults
from vitrine.operators.lateness import event_time_or_arrival


def check_window(size_ms: int, slide_ms: int) -> None:
    if size_ms <= 0 or slide_ms <= 0 or size_ms % slide_ms != 0:
        raise ValueError(f"window size {size_ms} ms must be a positive multiple of slide {slide_ms} ms")


def sliding_click_counts(accepted: DataFrame, size_ms: int = C.WINDOW_SIZE_MS,
                         slide_ms: int = C.WINDOW_SLIDE_MS) -> DataFrame:
    """(window_start, window_end, product_id, clicks, category, product_name).

    Epoch-aligned sliding windows ``[start, start + size)``, starts at
    multiples of the slide — the same windows as ``F.window(ts, size, slide)``.
    Because the slide divides the size, a window is a union of ``size/slide``
    slide buckets, so clicks are first counted per (bucket, product) — a hash
    aggregate with map-side combine over the raw clicks, no expansion — and
    only those bucket counts are fanned out to the windows that cover them.
    The expansion grows with buckets x products, not with clicks.

    ``category``/``product_name`` are the product's own latest in the window
    (not those of whichever click happened to close it; of equal times the
    largest).  The streaming defaults apply: a click without event time counts at its
    arrival, without category or name under the defaults.
    """
    check_window(size_ms, slide_ms)
    defaults = stream_defaults()
    t = F.col("event_time")
    clicks = accepted.where(F.col("event_type") == C.CLICK).select(
        event_time_or_arrival().alias("event_time"), "product_id", defaults["category"].alias("category"),
        defaults["product_name"].alias("product_name"))
    per_bucket = (clicks.groupBy((t - F.pmod(t, F.lit(slide_ms))).alias("bucket"),
                           "product_id", "category", "product_name")
                  .agg(F.count(F.lit(1)).alias("n"), F.max(t).alias("last_time")))
    bucket = F.col("bucket")
    starts = F.sequence(bucket - F.lit(size_ms - slide_ms), bucket, F.lit(slide_ms).cast("long"))
    fanned = per_bucket.select(F.explode(starts).alias("window_start"),
                               "product_id", "category", "product_name", "n", "last_time")
    return (fanned.groupBy("window_start", "product_id")
            .agg(F.sum("n").alias("clicks"),
                 F.max_by("category", F.struct("last_time", "category")).alias("category"),
                 F.max_by("product_name", F.struct("last_time", "product_name")).alias("product_name"))
            .select("window_start", (F.col("window_start") + F.lit(size_ms)).alias("window_end"),
                    "product_id", "clicks", "category", "product_name"))


def last_click_watermark(watermarked: DataFrame) -> DataFrame:
    """One row: the watermark right after the last accepted CLICK arrived.

    The watermark never falls in arrival order, so it is the largest of all accepted
    clicks, whatever order ties come in.
    """
    return (watermarked.where((F.col("event_type") == C.CLICK) & ~F.col("is_late"))
            .agg(F.max("watermark").alias("close_wm")))


def emitted_windows(counts: DataFrame, watermarked: DataFrame) -> DataFrame:
    """Every (window, product) labelled in one pass: ``is_final`` and its
    metric row key (``category#product`` when closed, ``FINAL#product``)."""
    close_wm = last_click_watermark(watermarked).scalar()
    final = ~F.coalesce(F.col("window_end") <= close_wm, F.lit(False))
    cat = F.coalesce(F.col("category"), F.lit(C.DEFAULT_STREAM_CATEGORY))
    return (counts.withColumn("is_final", final)
            .withColumn("row_key", F.when(F.col("is_final"), row_key(F.lit(C.FINAL_METRIC_PREFIX), F.col("product_id")))
                        .otherwise(row_key(cat, F.col("product_id")))))


def split_windows(counts: DataFrame, watermarked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed, final) windows."""
    labelled = emitted_windows(counts, watermarked)
    return labelled.where(~F.col("is_final")), labelled.where(F.col("is_final"))
