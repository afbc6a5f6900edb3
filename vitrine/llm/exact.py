"""Exact deduplication with a heavy-hitter split (Misra-Gries).

1. Every text becomes a SHA-256 digest of its normalised form (A-Z lower-cased,
   NULL as empty).  Only (row number, doc_id, digest) go on, as a table in the
   shared folder; texts are never shuffled.
2. Each task keeps a Misra-Gries summary of ``counters`` digests; the summaries
   are added up per digest.  With n rows and k counters a digest of more than
   2n/(k+1) rows always ends above n/(k+1), and at most k+1 digests can: they are
   the candidates.
3. The candidates are counted exactly.  Their winners, at most k+1 rows, are
   broadcast and decide their rows map-side, without a shuffle.
4. All other digests are shuffled; none has over 2n/(k+1) rows.

Of equal texts the row with the largest doc_id stays (NULL is the smallest;
among repeated rows of one doc_id, one stays).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.text import utf8
from vitrine.session import materialize

COUNTERS = 1000
#: Losing rows are removed by a broadcast up to this many; beyond it by a shuffled join.
BROADCAST_ROWS = 2_000_000


@F.arrow_udf(T.BinaryType())
def normalised_sha256(text: pa.Array) -> pa.Array:
    """SHA-256 of the UTF-8 text with A-Z lower-cased (bytes.lower changes only ASCII)."""
    data, at = utf8(text)
    whole = data.tobytes()
    return pa.array([hashlib.sha256(whole[a:b].lower()).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())],
                    pa.binary())


def _reduce(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Misra-Gries: back to k counters by taking off the (k+1)-th largest count."""
    if len(counts) <= k:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    off = int(np.partition(values, len(values) - k - 1)[len(values) - k - 1])
    return {d: c - off for d, c in counts.items() if c > off}


def misra_gries(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most counters + 1 candidates (digest), among them every one with over 2n/(counters+1) rows."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        n = 0
        for batch in batches:
            n += batch.num_rows
            for x in batch.column(0).value_counts().to_pylist():
                counts[x["values"]] = counts.get(x["values"], 0) + x["counts"]
            counts = _reduce(counts, counters)
        yield pa.RecordBatch.from_arrays([pa.array([*counts, None], pa.binary()),
                                          pa.array([*counts.values(), n], pa.int64())], ["digest", "n"])

    sums = digests.select(F.col(column).alias("digest")).mapInArrow(summary, "digest binary, n long") \
        .groupBy("digest").agg(F.sum("n").alias("n"))
    sums = materialize(sums, "misra-gries")
    total = sums.where("digest IS NULL").agg(F.sum("n")).first()[0] or 0
    return sums.where(F.col("digest").isNotNull() & (F.col("n") * (counters + 1) > total)).select("digest")


def digest_rows(docs: DataFrame) -> DataFrame:
    """One narrow row per document, written once: row (a number fixed by that table), doc_id, digest."""
    return materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                                   normalised_sha256("text").alias("digest")), "exact-digests")


def exact_groups(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Adds keep_id, group_size and kept to (row, doc_id, digest)."""
    spark = rows.sparkSession
    winner = F.max(F.struct(F.coalesce("doc_id", F.lit(-2 ** 63)).alias("id"), "doc_id", "row")).alias("best")
    size = F.count(F.lit(1)).alias("group_size")
    candidates = misra_gries(rows, "digest", counters)
    found = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(winner, size).collect()
    heavy = spark.createDataFrame([(bytes(x["digest"]), x["best"], x["group_size"]) for x in found],
                                  f"digest binary, best struct<id:long,doc_id:long,row:long>, group_size long")
    hot = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").repartition("digest")
    rest = rest.join(rest.groupBy("digest").agg(winner, size), "digest")
    return hot.unionByName(rest).select("row", "doc_id", "digest", F.col("best.doc_id").alias("keep_id"),
                                        "group_size", (F.col("row") == F.col("best.row")).alias("kept"))


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    NULL and empty texts are equal.  An empty table gives an empty result.
    """
    return exact_groups(digest_rows(docs), counters).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_exact(docs: DataFrame, counters: int = COUNTERS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The documents that stay, with all their columns.

    The decisions are made on narrow rows.  Losing (doc_id, digest) keys are
    broadcast when counted to be few, else joined by a shuffle.  Where a winning
    key has several rows (repeated rows), one of them stays.
    """
    columns = docs.columns
    groups = exact_groups(digest_rows(docs), counters)
    keys = groups.groupBy("doc_id", "digest").agg(F.max("kept").alias("wins"), F.count(F.lit(1)).alias("n"))
    keys = materialize(keys.where("NOT wins OR n > 1"), "exact-losers")
    small = keys.count() <= broadcast_rows
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
                         F.col("doc_id").cast("long").alias("doc_id"), normalised_sha256("text").alias("digest"))
    keys = keys.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    joined = marked.join(F.broadcast(keys) if small else keys,
                         F.col("digest").eqNullSafe(F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    single = joined.where("wins IS NULL").select("doc")
    repeated = joined.where("wins AND n > 1").groupBy("doc_id", "digest").agg(F.first("doc").alias("doc")).select("doc")
    return single.unionAll(repeated).select("doc.*")
