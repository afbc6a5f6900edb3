"""Click x checkout correlation per user.

The batch job joins every CLICK with every CHECKOUT of the same user and
counts the pairs.  Materialising the pairs grows with clicks x checkouts per
user, quadratic in a hot user.  Both forms here aggregate *before* the join:

* ``click_checkout_pairs``: one row per (user, product) with the click count,
  the user's checkout count and their product = the number of pairs for that
  (user, product).  Order ids are not in it.
* ``click_checkout_pair_count``: ``sum(clicks * checkouts)`` over users.
* ``pair_factors``: which orders belong to which clicks, not multiplied out: of each user one
  side of (product, clicks) and one of (order, checkouts), in chunks of bounded
  size.  Every pair is in exactly one (chunk, chunk), so a task can list or sample
  some without the others; ``list_pairs`` lists all.

Each side is partially aggregated map-side, so a user holding a third of all
events contributes one row per map task to the shuffle.  The join keys are
null-safe: the RDD join of the original matches ``None`` user ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine import constants as C


def _click_side(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == C.CLICK)
            .groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("clicks")))


def _checkout_side(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == C.CHECKOUT)
            .groupBy(F.col("user_id").alias("o_user_id"))
            .agg(F.count(F.lit(1)).alias("checkouts")))


def click_checkout_pairs(events: DataFrame) -> DataFrame:
    clicks = _click_side(events)
    orders = _checkout_side(events)
    return (clicks.join(orders, clicks["user_id"].eqNullSafe(orders["o_user_id"]), "inner")
            .select("user_id", "product_id", "clicks", "checkouts",
                    (F.col("clicks") * F.col("checkouts")).alias("pairs")))


def click_checkout_pair_count(events: DataFrame) -> DataFrame:
    clicks = (events.where(F.col("event_type") == C.CLICK)
              .groupBy("user_id").agg(F.count(F.lit(1)).alias("clicks")))
    orders = _checkout_side(events)
    return (clicks.join(orders, clicks["user_id"].eqNullSafe(orders["o_user_id"]), "inner")
            .agg(F.coalesce(F.sum(F.col("clicks") * F.col("checkouts")), F.lit(0))
                 .cast("long").alias("pair_count")))


#: Entries of a chunk, on average; a hash deals them, so none is much larger.
CHUNK = 1000


def pair_factors(events: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(user_id, side, chunk, entries): ``clicks`` and ``orders`` of the users that have both.

    ``entries`` is an array of (id, n): product ids with their clicks, or order ids with their checkouts.
    A side's number of chunks follows its number of distinct ids, so a hot user has many
    chunks in many tasks and no large one.
    """
    sides = {"clicks": (C.CLICK, "product_id"), "orders": (C.CHECKOUT, "order_id")}
    out = None
    for side, (kind, key) in sides.items():
        other = C.CHECKOUT if kind == C.CLICK else C.CLICK
        partners = events.where(F.col("event_type") == other).select(F.col("user_id").alias("_user")).distinct()
        entries = (events.where(F.col("event_type") == kind).groupBy("user_id", F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n")))
        entries = entries.join(partners, entries["user_id"].eqNullSafe(partners["_user"]), "left_semi")
        sizes = entries.groupBy(F.col("user_id").alias("_user")).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("_chunks"))
        dealt = entries.join(sizes, entries["user_id"].eqNullSafe(sizes["_user"]))
        place = F.pmod(F.xxhash64("id"), F.col("_chunks")).cast("int").alias("chunk")
        rows = (dealt.select("user_id", place, F.struct("id", "n").alias("e")).groupBy("user_id", "chunk")
                .agg(F.array_sort(F.collect_list("e")).alias("entries"))
                .select("user_id", F.lit(side).alias("side"), "chunk", "entries"))
        out = rows if out is None else out.unionByName(rows)
    return out


def factor_entries(factors: DataFrame) -> DataFrame:
    """(user_id, side, id, n): the chunks' entries, one a row."""
    return factors.select("user_id", "side", F.explode("entries").alias("e")).select("user_id", "side", "e.id", "e.n")


def list_pairs(factors: DataFrame) -> DataFrame:
    """(user_id, product_id, order_id, pairs): every pair, chunk by chunk.  As large as the plain join."""
    side = lambda name, user: factors.where(F.col("side") == name).select(F.col("user_id").alias(user), F.col("entries").alias(name))
    clicks, orders = side("clicks", "user_id"), side("orders", "_user")
    both = clicks.join(orders, clicks["user_id"].eqNullSafe(orders["_user"]))
    one = both.select("user_id", F.explode("clicks").alias("c"), "orders").select("user_id", "c", F.explode("orders").alias("o"))
    return one.select("user_id", F.col("c.id").alias("product_id"), F.col("o.id").alias("order_id"), (F.col("c.n") * F.col("o.n")).alias("pairs"))
