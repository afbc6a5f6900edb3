"""Adaptor: the driver's generic ``events`` table -> this domain's events.

The driver table has (event_id, ts, user_id, event_type, value, props='{"k": n}').
The mapping is a pure per-row projection, so it is a narrow transformation
that Catalyst fuses into the scan stage (no shuffle, column pruning reaches
the parquet reader).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.columns import iso_utc, ts_to_epoch_ms
from vitrine.schemas import EVENT_SCHEMA

# --- fixed values: adaptor vocabulary, in index order ---------------------
TYPE_MAP = {"click": "CLICK", "view": "CART_ADD", "error": "CART_REMOVE",
            "purchase": "CHECKOUT_COMPLETED", "signup": "DELIVERY_UPDATE"}
REGIONS = ["Sudeste", "Sul", "Nordeste", "Centro-Oeste", "Norte"]
CATEGORIES = ["Eletronicos", "Informatica", "Moda", "Casa", "Esportes"]
PAYMENT_METHODS = ["PIX", "CREDIT_CARD", "BOLETO"]
DELIVERY_STATUSES = ["DISPATCHED", "IN_TRANSIT", "DELAYED", "OUT_FOR_DELIVERY",
                     "DELIVERED", "FAILED_ATTEMPT"]
CARRIERS = ["Correios", "Loggi", "Total Express", "Jadlog"]
# ---------------------------------------------------------------------------


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def adapt_events(raw: DataFrame) -> DataFrame:
    """Driver ``events`` rows -> EVENT_SCHEMA rows (see FIXTURES.md §2)."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    etype = F.col("_etype")
    is_click = etype == "CLICK"
    is_cart = etype.isin("CART_ADD", "CART_REMOVE")
    is_product = is_click | is_cart
    is_checkout = etype == "CHECKOUT_COMPLETED"
    is_delivery = etype == "DELIVERY_UPDATE"
    value = F.col("value")

    type_expr = None  # one flat CASE; filters on it do not reach the scan, see read_driver_events
    for src, dst in TYPE_MAP.items():
        cond = F.col("event_type") == src
        type_expr = F.when(cond, F.lit(dst)) if type_expr is None else type_expr.when(cond, F.lit(dst))

    staged = raw.select(
        F.col("event_id").alias("_eid"),
        ts_to_epoch_ms("ts").alias("_et"),
        F.col("user_id").alias("_uid"),
        type_expr.alias("_etype"),
        value.alias("value"),
        k.alias("_k"),
    )
    k = F.col("_k")
    eid = F.col("_eid")
    uid = F.col("_uid")
    prod_idx = F.pmod(k, F.lit(20))
    none_s = F.lit(None).cast("string")
    none_d = F.lit(None).cast("double")
    none_i = F.lit(None).cast("int")

    cols = {
        "event_id": F.lpad(eid.cast("string"), 12, "0"),
        "event_time": F.col("_et"),
        "event_time_iso": iso_utc(F.col("_et")),
        "ingestion_time": F.col("_et") + k.cast("long") * F.lit(60000),
        "is_simulated_late": k > 0,
        "event_type": etype,
        "user_id": F.concat(F.lit("USR_"), F.lpad(uid.cast("string"), 4, "0")),
        "region": _pick(REGIONS, F.pmod(eid, F.lit(5))),
        "product_id": F.when(is_product, F.concat(F.lit("P-"), F.lpad(prod_idx.cast("string"), 2, "0"))).otherwise(none_s),
        "product_name": F.when(is_click, F.concat(F.lit("Product "), prod_idx.cast("string"))).otherwise(none_s),
        "category": F.when(is_product, _pick(CATEGORIES, F.pmod(k, F.lit(5)))).otherwise(none_s),
        "price": F.when(is_click, value).otherwise(none_d),
        "quantity": F.when(is_cart, F.pmod(k, F.lit(3)) + 1).otherwise(none_i),
        "subtotal": F.when(is_cart, value).otherwise(none_d),
        "order_id": F.when(is_checkout | is_delivery,
                           F.concat(F.lit("ORD_"), F.lpad(eid.cast("string"), 9, "0"))).otherwise(none_s),
        "total_amount": F.when(is_checkout, value).otherwise(none_d),
        "payment_method": F.when(is_checkout, _pick(PAYMENT_METHODS, F.pmod(k, F.lit(3)))).otherwise(none_s),
        "delivery_status": F.when(is_delivery, _pick(DELIVERY_STATUSES, F.pmod(k, F.lit(6)))).otherwise(none_s),
        "delay_minutes": F.when(is_delivery, F.when(F.pmod(k, F.lit(6)).isin(2, 5), 30 + 2 * k).otherwise(0)).otherwise(none_i),
        "carrier": F.when(is_delivery, _pick(CARRIERS, F.pmod(uid, F.lit(4)))).otherwise(none_s),
        "cart_id": F.when(is_cart, F.concat(F.lit("CRT_"), uid.cast("string"))).otherwise(none_s),
        "item_price": F.when(is_cart, value).otherwise(none_d),
        "items_count": F.when(is_checkout, F.pmod(k, F.lit(2)) + 1).otherwise(none_i),
    }
    return staged.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


def read_driver_events(spark: SparkSession, sf_dir: str, types: tuple[str, ...] = ()) -> DataFrame:
    """The adapted events.  ``types``: only these, filtered on the source column, so the filter reaches the scan."""
    raw = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    if types:
        raw = raw.where(F.col("event_type").isin(*[src for src, dst in TYPE_MAP.items() if dst in types]))
    return adapt_events(raw)


# --- fixed values: noise lines mixed into the event log for the tolerant
# --- scan, keyed by the last two digits of the driver event id.
NOISE_RULES = {
    11: "not json",            # 'not json <event_id>'
    22: "array of a number",   # '[<event_time>]'
    33: "json null",           # 'null'
    44: "wrong type",          # '{"event_id":"<id>","delay_minutes":"abc"}'
    55: "blank line",          # ''
    66: "empty array",         # '[]'
    77: "empty object",        # '{}'
}


def noisy_event_log(events: DataFrame) -> DataFrame:
    """The event log as JSON lines plus deterministic malformed / blank /
    empty lines derived from the events themselves (one extra line for each
    event whose id ends in a NOISE_RULES key).  Column ``value``."""
    d = F.pmod(F.col("event_id").cast("long"), F.lit(100))
    eid, et = F.col("event_id"), F.col("event_time").cast("string")
    noise = (F.when(d == 11, F.concat(F.lit("not json "), eid))
             .when(d == 22, F.concat(F.lit("["), et, F.lit("]")))
             .when(d == 33, F.lit("null"))
             .when(d == 44, F.concat(F.lit('{"event_id":"'), eid, F.lit('","delay_minutes":"abc"}')))
             .when(d == 55, F.lit(""))
             .when(d == 66, F.lit("[]"))
             .when(d == 77, F.lit("{}")))
    with_json = events.select(
        F.to_json(F.struct(*[F.col(c) for c in EVENT_SCHEMA.fieldNames()])).alias("_json"),
        noise.alias("_noise"))
    return with_json.select(F.explode(F.array_compact(F.array("_json", "_noise"))).alias("value"))
