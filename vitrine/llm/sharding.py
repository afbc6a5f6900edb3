"""Sharding by vector bin packing over bytes, tokens and rows.

Documents with equal texts form a group; a group is placed whole.  Each group is
a vector (bytes, tokens, rows), and it goes to the shard whose residual capacity
has the highest dot product with it.

Packing every group in one place would not scale, so it is done in two levels:

* Groups that weigh at least ``1/heavy`` of a shard in a dimension are packed
  first, against the whole shards.  There are at most 3 * shards * heavy of them,
  whatever the input.  A group above that weight is split by a hash of doc_id
  into pieces of about that weight first (a group of copies may be larger than a
  shard), and its pieces are packed like groups.
* All other groups are dealt by a hash of their digest into lots of about
  ``lot_groups``; each lot is packed in its own task, from the largest to the
  smallest group, against its proportional part of what the heavy ones left.
  Within a lot the last groups placed are the smallest, so each lot is level to
  within a small document.

Slots: a row's number within its shard is (rows of that shard in earlier lots) +
(rows of earlier groups of the lot) + (its rank within the group), so no shard is
ever sorted as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.text import WORD_PATTERN
from vitrine.session import materialize

SHARDS = 24
HEAVY = 32
LOT_GROUPS = 4096
#: Weight of each dimension in the dot product; bytes is the one whose balance is promised.
WEIGHTS = (64.0, 1.0, 1.0)
DIMENSIONS = ["bytes", "tokens", "rows"]


def place(vectors: np.ndarray, residual: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Greedy packing of (m, 3) vectors, in the given order; `residual` (shards, 3) is used up.

    Both are measured in units of a shard (`scale`); ties go to the lowest shard.
    """
    left = residual / scale * np.sqrt(WEIGHTS)
    unit = vectors / scale * np.sqrt(WEIGHTS)
    out = np.empty(len(unit), np.int32)
    for i, v in enumerate(unit):
        out[i] = s = int(np.argmax(left @ v))
        left[s] -= v
    residual[:] = left * scale / np.sqrt(WEIGHTS)
    return out


def _largest_first(frame: pd.DataFrame, scale: np.ndarray) -> pd.DataFrame:
    weight = (frame[DIMENSIONS].to_numpy(float) / scale * WEIGHTS).sum(axis=1)
    return frame.assign(_w=-weight).sort_values(["_w", "digest", "piece"]).drop(columns="_w")


def _with_bases(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.assign(base=frame.groupby("shard")["rows"].cumsum() - frame["rows"])


def shard_rows(docs: DataFrame) -> DataFrame:
    """The narrow rows that decide: one per document, written once.  Texts stay where they are.

    NULL texts form a group of their own (0 bytes of text, as for empty ones).
    """
    text = F.coalesce("text", F.lit(""))
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
        F.when(F.col("text").isNull(), F.lit("")).otherwise(F.sha2("text", 256)).alias("digest"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("tokens")), "shard-rows")


def vector_shards(docs: DataFrame, shards: int = SHARDS, heavy: int = HEAVY, lot_groups: int = LOT_GROUPS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens.

    An empty table gives an empty result.  Repeated rows are rows of one group.  A very long
    text is one group of many bytes, placed whole.  Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = shard_rows(docs)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                        F.count(F.lit(1)).alias("rows"))
    groups = materialize(groups, "shard-groups")
    n, *sums = groups.agg(F.count(F.lit(1)), *[F.sum(c) for c in DIMENSIONS]).first()
    total = np.array([x or 0 for x in sums], float)
    share = np.maximum(total / shards, 1e-9)
    lots = max(1, -(-n // lot_groups))

    # Groups of at least 1/heavy of a shard: at most 3 * shards * heavy by their sum.
    weight = F.greatest(*[F.col(c) / float(s) for c, s in zip(DIMENSIONS, share)])
    large = groups.where(weight >= 1 / heavy).select("digest", F.ceil(weight * heavy).cast("long").alias("most"),
                                                     "rows").collect()
    pieces = spark.createDataFrame([(x["digest"], int(min(x["most"], x["rows"]))) for x in large],
                                   "digest string, pieces long")
    cut = F.pmod(F.xxhash64("doc_id", "row"), F.coalesce("pieces", F.lit(1))).cast("long")
    parts = rows.join(F.broadcast(pieces), "digest").withColumn("piece", cut) \
        .groupBy("digest", "piece").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                        F.count(F.lit(1)).alias("rows")).toPandas()
    parts = _largest_first(parts, share)
    residual = np.tile(share, (shards, 1))
    parts["shard"] = place(parts[DIMENSIONS].to_numpy(float), residual, share)
    parts = _with_bases(parts)
    first = np.bincount(parts["shard"], parts["rows"], shards).astype(int)
    packed_first = spark.createDataFrame(
        [(r.digest, int(r.piece), int(r.shard), int(r.base)) for r in parts.itertuples()],
        "digest string, piece long, shard int, base long")
    rest = np.maximum(total - parts[DIMENSIONS].sum().to_numpy(float), 1e-9)

    def pack_lot(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[DIMENSIONS].sum().to_numpy(float)
        left = residual * (own / rest)
        frame = _largest_first(frame.assign(piece=0), np.maximum(own / shards, 1e-9))
        frame["shard"] = place(frame[DIMENSIONS].to_numpy(float), left, np.maximum(own / shards, 1e-9))
        return _with_bases(frame)[["lot", "digest", "piece", "shard", "base", "rows"]]

    light = groups.join(F.broadcast(pieces), "digest", "left_anti") \
        .withColumn("lot", F.pmod(F.xxhash64("digest"), F.lit(lots)))
    placed = light.groupBy("lot").applyInPandas(
        pack_lot, "lot long, digest string, piece long, shard int, base long, rows long")
    placed = materialize(placed, "shard-placed")
    # Rows of each shard before each lot: one row per lot and shard goes in.
    before = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("lot", "shard").agg(F.sum("rows").alias("n")) \
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    offset = F.element_at(F.array(*[F.lit(int(x)) for x in first]), F.col("shard") + 1)
    small = placed.join(starts, ["lot", "shard"]).select("digest", "piece", "shard",
                                                         (F.col("base") + F.col("before") + offset).alias("base"))
    rank = F.row_number().over(Window.partitionBy("digest", "piece").orderBy("doc_id", "row")) - 1
    numbered = rows.join(F.broadcast(pieces), "digest", "left").withColumn("piece", cut)
    hot = numbered.where("pieces IS NOT NULL").withColumn("rank", rank).join(F.broadcast(packed_first), ["digest", "piece"])
    light_rows = numbered.where("pieces IS NULL").withColumn("rank", rank).join(small, ["digest", "piece"])
    return hot.unionByName(light_rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")
