"""Best-fit packing of documents into fixed-length sequences, with conflicts.

A bin holds ``capacity`` tokens.  A text longer than that is cut into full bins
and a remainder; nothing is truncated.  Two pieces conflict when their documents
are in one duplicate cluster, and a bin takes at most ``per_source`` pieces of one
source.

Documents are dealt by a hash of their row number into lots of about
``lot_rows``, so a hot source or cluster is spread evenly and every task's work
is bounded.  In a lot, pieces are placed from the longest to the shortest.  Bins
are kept in order of residual; each carries a bitmap of its clusters and a bitmap
with ``per_source`` bits for each source.  The search starts at the smallest residual that fits
and goes on to its successors until a bin is compatible: that one is the tightest
compatible bin.  If there is none, a new bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.exact import normalised_sha256
from vitrine.llm.text import BATCH_ROWS, batches_of, release, word_counts
from vitrine.session import materialize

CAPACITY = 2048
PER_SOURCE = 4
LOT_ROWS = 4096


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, placed in the given order; sizes are at most `capacity`.

    ``clusters`` None: in conflict with nothing.
    """
    source_bit = {s: i * per_source for i, s in enumerate(dict.fromkeys(sources))}
    cluster_bit = {c: 1 << i for i, c in enumerate(dict.fromkeys(clusters))} | {None: 0}
    order: list[tuple[int, int]] = []          # (residual, bin), ascending
    by_source: list[int] = []                  # a bin's bitmap: the lowest per_source bits of a field, filled from below
    by_cluster: list[int] = []
    field = (1 << per_source) - 1
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        at, bit = source_bit[source], cluster_bit[cluster]
        full = field << at
        i = bisect_left(order, (size, -1))
        while i < len(order):
            b = order[i][1]
            if not by_cluster[b] & bit and by_source[b] & full != full:
                break
            i += 1
        if i < len(order):
            left, b = order.pop(i)
        else:
            left, b = capacity, len(by_source)
            by_source.append(0)
            by_cluster.append(0)
        used = by_source[b] >> at & field
        by_source[b] |= (used << 1 | 1) << at
        by_cluster[b] |= bit
        insort(order, (left - size, b))
        out.append((b, capacity - left))
    return out


@F.arrow_udf(T.LongType())
def _tokens(text: pa.Array) -> pa.Array:
    """Words of each text, counted on its bytes: regexp_count makes a string of every word in the JVM first."""
    out = pa.array(word_counts(text))
    release()
    return out


def packing_rows(docs: DataFrame) -> DataFrame:
    """The narrow rows that decide, written once: row, doc_id, source, cluster, tokens.

    Cluster: documents of equal text after lower-casing A-Z.  Empty texts have no cluster.
    """
    text = F.coalesce("text", F.lit(""))
    with batches_of(docs.sparkSession, BATCH_ROWS):
        return materialize(docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"),
            F.when(text != "", normalised_sha256("text")).alias("cluster"), _tokens("text").alias("tokens")), "packing-rows")


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE,
                     lot_rows: int = LOT_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, n_pieces, first_token, tokens, bin, bin_offset, source.

    Every token of every document is in exactly one piece; a text without tokens
    is one piece of none.  NULL sources count as one source.  An empty table gives
    an empty result.  Repeated rows are documents of their own; a very long text fills bins of its own.
    """
    rows = packing_rows(docs)
    lots = max(1, -(-rows.count() // lot_rows))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(capacity))).cast("long")
    # pandas would turn a column of integers with NULLs into floats
    dealt = rows.withColumns({"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0)),
                              "n_pieces": pieces}).withColumn("lot", F.pmod(F.xxhash64("row"), F.lit(lots)))

    def pack_lot(frame: pd.DataFrame) -> pd.DataFrame:
        each = frame.loc[frame.index.repeat(frame["n_pieces"])].copy()
        each["piece"] = each.groupby("row").cumcount()
        each["first_token"] = each["piece"] * capacity
        each["tokens"] = (each["tokens"] - each["first_token"]).clip(upper=capacity)
        each = each.sort_values(["tokens", "row", "piece"], ascending=[False, True, True])
        source = each["source"].where(each["source"].notna(), None)
        cluster = [bytes(c) if c is not None else None for c in each["cluster"]]
        placed = best_fit(each["tokens"].tolist(), source.tolist(), cluster, capacity, per_source)
        each["bin"] = [(int(lot) << 32) + b for lot, (b, _) in zip(each["lot"], placed)]
        each["bin_offset"] = [offset for _, offset in placed]
        return each[["doc_id", "no_id", "piece", "n_pieces", "first_token", "tokens", "bin", "bin_offset", "source"]]

    packed = dealt.groupBy("lot").applyInPandas(
        pack_lot, "doc_id long, no_id boolean, piece long, n_pieces long, first_token long, tokens long, bin long, "
                  "bin_offset long, source string")
    return packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
