"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement starts from the driver's pre-registered ``events`` view and
inlines the FIXTURES.md adaptor as CTEs ``base`` and ``ev``; ``with_ev(...)``
prepends them.  Column names equal the Spark queries' aliases.
"""

from __future__ import annotations

# --- adaptor as CTEs (same fixed vocabulary as vitrine.sources.driver_events)
_ADAPTOR = """
base AS (
  SELECT event_id AS _eid, epoch_us(ts) // 1000 AS _et, user_id AS _uid, value AS _v,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS _k,
         CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'CART_ADD'
              WHEN 'error' THEN 'CART_REMOVE' WHEN 'purchase' THEN 'CHECKOUT_COMPLETED'
              WHEN 'signup' THEN 'DELIVERY_UPDATE' END AS _t
  FROM events
),
ev AS (
  SELECT
    lpad(CAST(_eid AS VARCHAR), 12, '0') AS event_id,
    _et AS event_time,
    strftime(epoch_ms(_et), '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN _et % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(_et % 1000 AS VARCHAR), 3, '0') || '000' END
      || '+00:00' AS event_time_iso,
    _et + CAST(_k AS BIGINT) * 60000 AS ingestion_time,
    _k > 0 AS is_simulated_late,
    _t AS event_type,
    'USR_' || lpad(CAST(_uid AS VARCHAR), 4, '0') AS user_id,
    (['Sudeste', 'Sul', 'Nordeste', 'Centro-Oeste', 'Norte'])[_eid % 5 + 1] AS region,
    CASE WHEN _t IN ('CLICK', 'CART_ADD', 'CART_REMOVE')
         THEN 'P-' || lpad(CAST(_k % 20 AS VARCHAR), 2, '0') END AS product_id,
    CASE WHEN _t = 'CLICK' THEN 'Product ' || CAST(_k % 20 AS VARCHAR) END AS product_name,
    CASE WHEN _t IN ('CLICK', 'CART_ADD', 'CART_REMOVE')
         THEN (['Eletronicos', 'Informatica', 'Moda', 'Casa', 'Esportes'])[_k % 5 + 1] END AS category,
    CASE WHEN _t = 'CLICK' THEN _v END AS price,
    CAST(CASE WHEN _t IN ('CART_ADD', 'CART_REMOVE') THEN _k % 3 + 1 END AS INTEGER) AS quantity,
    CASE WHEN _t IN ('CART_ADD', 'CART_REMOVE') THEN _v END AS subtotal,
    CASE WHEN _t IN ('CHECKOUT_COMPLETED', 'DELIVERY_UPDATE')
         THEN 'ORD_' || lpad(CAST(_eid AS VARCHAR), 9, '0') END AS order_id,
    CASE WHEN _t = 'CHECKOUT_COMPLETED' THEN _v END AS total_amount,
    CASE WHEN _t = 'CHECKOUT_COMPLETED'
         THEN (['PIX', 'CREDIT_CARD', 'BOLETO'])[_k % 3 + 1] END AS payment_method,
    CASE WHEN _t = 'DELIVERY_UPDATE'
         THEN (['DISPATCHED', 'IN_TRANSIT', 'DELAYED', 'OUT_FOR_DELIVERY', 'DELIVERED',
                'FAILED_ATTEMPT'])[_k % 6 + 1] END AS delivery_status,
    CAST(CASE WHEN _t = 'DELIVERY_UPDATE'
              THEN CASE WHEN _k % 6 IN (2, 5) THEN 30 + 2 * _k ELSE 0 END END AS INTEGER) AS delay_minutes,
    CASE WHEN _t = 'DELIVERY_UPDATE'
         THEN (['Correios', 'Loggi', 'Total Express', 'Jadlog'])[_uid % 4 + 1] END AS carrier,
    CASE WHEN _t IN ('CART_ADD', 'CART_REMOVE') THEN 'CRT_' || CAST(_uid AS VARCHAR) END AS cart_id,
    CASE WHEN _t IN ('CART_ADD', 'CART_REMOVE') THEN _v END AS item_price,
    CAST(CASE WHEN _t = 'CHECKOUT_COMPLETED' THEN _k % 2 + 1 END AS INTEGER) AS items_count
  FROM base
)"""

EVENT_COLS = ("event_id, event_time, event_time_iso, ingestion_time, is_simulated_late, event_type, "
              "user_id, region, product_id, product_name, category, price, quantity, subtotal, "
              "order_id, total_amount, payment_method, delivery_status, delay_minutes, carrier, "
              "cart_id, item_price, items_count")


def with_ev(body: str, *ctes: str) -> str:
    """``WITH base, ev[, more ctes] <body>``."""
    parts = [_ADAPTOR.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


ORACLE: dict[str, str] = {}

RUN_DT = "2024-01-31"

_FUNNEL = """
SELECT {cat} AS category,
       CAST(count(CASE WHEN event_type = 'CLICK' THEN 1 END) AS BIGINT) AS total_clicks,
       CAST(count(CASE WHEN event_type = 'CART_ADD' THEN 1 END) AS BIGINT) AS total_cart_adds,
       CAST(count(CASE WHEN event_type = 'CHECKOUT_COMPLETED' THEN 1 END) AS BIGINT) AS total_checkouts,
       round(sum(CASE WHEN event_type = 'CHECKOUT_COMPLETED' THEN total_amount ELSE 0.0 END), 2) AS total_revenue,
       CASE WHEN count(CASE WHEN event_type = 'CLICK' THEN 1 END) > 0
            THEN round(count(CASE WHEN event_type = 'CART_ADD' THEN 1 END)
                       / count(CASE WHEN event_type = 'CLICK' THEN 1 END) * 100, 2) ELSE 0.0 END AS conversion_rate_cart,
       CASE WHEN count(CASE WHEN event_type = 'CLICK' THEN 1 END) > 0
            THEN round(count(CASE WHEN event_type = 'CHECKOUT_COMPLETED' THEN 1 END)
                       / count(CASE WHEN event_type = 'CLICK' THEN 1 END) * 100, 2) ELSE 0.0 END AS conversion_rate_checkout,
       {dt} AS dt
FROM ev GROUP BY {group}"""

ORACLE["funnel"] = with_ev(_FUNNEL.format(cat="category", dt=f"'{RUN_DT}'", group="category"))
ORACLE["funnel_default_category"] = with_ev(_FUNNEL.format(
    cat="coalesce(category, 'Outros')", dt=f"'{RUN_DT}'", group="coalesce(category, 'Outros')"))

_LOGISTICS = """
SELECT carrier, region,
       CAST(count(order_id) AS BIGINT) AS total_orders,
       CAST(count(CASE WHEN delivery_status IN ('DELIVERED', 'IN_TRANSIT', 'DISPATCHED') THEN 1 END) AS BIGINT) AS on_time_deliveries,
       CAST(count(CASE WHEN delivery_status = 'DELAYED' THEN 1 END) AS BIGINT) AS delayed_deliveries,
       CAST(count(CASE WHEN delivery_status = 'FAILED_ATTEMPT' THEN 1 END) AS BIGINT) AS failed_attempts,
       CASE WHEN count(order_id) > 0
            THEN round(count(CASE WHEN delivery_status IN ('DELIVERED', 'IN_TRANSIT', 'DISPATCHED') THEN 1 END)
                       / count(order_id) * 100, 2) ELSE 100.0 END AS sla_percentage,
       round(avg(delay_minutes), 1) AS avg_delay_minutes,
       {dt} AS dt
FROM ev WHERE event_type = 'DELIVERY_UPDATE' GROUP BY {group}"""

ORACLE["logistics_sla"] = with_ev(_LOGISTICS.format(dt=f"'{RUN_DT}'", group="carrier, region"))

ORACLE["cart_subtotal_by_category"] = with_ev("""
SELECT category, round(sum(coalesce(subtotal, 0.0)), 2) AS subtotal_sum
FROM ev WHERE event_type = 'CART_ADD' GROUP BY category""")

_CLICKS_PER_USER_PRODUCT = """
c AS (SELECT user_id, product_id, count(*) AS clicks FROM ev WHERE event_type = 'CLICK' GROUP BY user_id, product_id),
o AS (SELECT user_id, count(*) AS checkouts FROM ev WHERE event_type = 'CHECKOUT_COMPLETED' GROUP BY user_id)"""

ORACLE["click_checkout_pairs"] = with_ev("""
SELECT c.user_id, c.product_id, CAST(c.clicks AS BIGINT) AS clicks, CAST(o.checkouts AS BIGINT) AS checkouts,
       CAST(c.clicks * o.checkouts AS BIGINT) AS pairs
FROM c JOIN o ON c.user_id IS NOT DISTINCT FROM o.user_id""", _CLICKS_PER_USER_PRODUCT)

ORACLE["click_checkout_pair_count"] = with_ev("""
SELECT CAST(count(*) AS BIGINT) AS pair_count
FROM (SELECT user_id FROM ev WHERE event_type = 'CLICK') c
JOIN (SELECT user_id FROM ev WHERE event_type = 'CHECKOUT_COMPLETED') o
  ON c.user_id IS NOT DISTINCT FROM o.user_id""")

ORACLE["abandoned_carts"] = with_ev("""
SELECT u.category, CAST(count(*) AS BIGINT) AS carts_created,
       CAST(count(CASE WHEN lc IS NULL OR lc < last_add THEN 1 END) AS BIGINT) AS carts_abandoned,
       CASE WHEN count(*) > 0 THEN round(count(CASE WHEN lc IS NULL OR lc < last_add THEN 1 END) / count(*) * 100, 2)
            ELSE 0.0 END AS abandonment_rate,
       round(sum(CASE WHEN lc IS NULL OR lc < last_add THEN greatest(added - removed, 0.0) ELSE 0.0 END), 2)
         AS estimated_lost_revenue,
       u.dt
FROM units u LEFT JOIN chk ON u.dt = chk.dt AND u.user_id IS NOT DISTINCT FROM chk.user_id
GROUP BY u.dt, u.category""", """
units AS (
  SELECT strftime(epoch_ms(event_time), '%Y-%m-%d') AS dt, category, cart_id, user_id,
         max(CASE WHEN event_type = 'CART_ADD' THEN event_time END) AS last_add,
         sum(CASE WHEN event_type = 'CART_ADD' THEN coalesce(subtotal, 0.0) ELSE 0.0 END) AS added,
         sum(CASE WHEN event_type = 'CART_REMOVE' THEN coalesce(subtotal, 0.0) ELSE 0.0 END) AS removed
  FROM ev WHERE event_type IN ('CART_ADD', 'CART_REMOVE')
  GROUP BY 1, category, cart_id, user_id
  HAVING max(CASE WHEN event_type = 'CART_ADD' THEN event_time END) IS NOT NULL)""", """
chk AS (
  SELECT strftime(epoch_ms(event_time), '%Y-%m-%d') AS dt, user_id, max(event_time) AS lc
  FROM ev WHERE event_type = 'CHECKOUT_COMPLETED' GROUP BY 1, user_id)""")

ORACLE["filter_event_type"] = with_ev("""
SELECT event_id, event_time, user_id, product_id, category, price FROM ev WHERE event_type = 'CLICK'""")

ORACLE["normalize_defaults"] = with_ev("""
SELECT event_id, coalesce(event_time, ingestion_time) AS event_time, event_time_iso, ingestion_time,
       coalesce(is_simulated_late, false) AS is_simulated_late, event_type, user_id,
       coalesce(region, 'N/A') AS region, product_id, coalesce(product_name, product_id) AS product_name,
       coalesce(category, 'Geral') AS category, price, quantity, subtotal,
       coalesce(order_id, 'N/A') AS order_id, total_amount, payment_method, delivery_status,
       coalesce(delay_minutes, 0) AS delay_minutes, coalesce(carrier, 'Desconhecida') AS carrier,
       cart_id, item_price, items_count
FROM ev""")

ORACLE["event_time_iso"] = with_ev("SELECT event_id, event_time, event_time_iso FROM ev")

TOLERANCE_MS = 3600 * 1000
_WM = f"""
wm AS (
  SELECT *, greatest(0, max(coalesce(event_time, ingestion_time) - {TOLERANCE_MS}) OVER (
              ORDER BY ingestion_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS watermark
  FROM ev),
wml AS (SELECT *, coalesce(event_time, ingestion_time) < watermark AS is_late FROM wm)"""

ORACLE["arrival_watermark"] = with_ev(
    "SELECT event_id, event_type, ingestion_time, event_time, watermark, is_late FROM wml", _WM)
ORACLE["accepted_events"] = with_ev(f"SELECT {EVENT_COLS} FROM wml WHERE NOT is_late", _WM)
ORACLE["late_events"] = with_ev(f"SELECT {EVENT_COLS}, watermark FROM wml WHERE is_late", _WM)
ORACLE["late_rate"] = with_ev("""
SELECT event_type, CAST(count(*) AS BIGINT) AS total_events,
       CAST(count(CASE WHEN is_late THEN 1 END) AS BIGINT) AS late_events,
       CAST(count(CASE WHEN is_simulated_late THEN 1 END) AS BIGINT) AS flagged_late,
       CAST(count(CASE WHEN is_late AND is_simulated_late THEN 1 END) AS BIGINT) AS flagged_and_late,
       round(count(CASE WHEN is_late THEN 1 END) / count(*) * 100, 2) AS late_pct
FROM wml GROUP BY event_type""", _WM)

WINDOW_MS = 24 * 3600 * 1000
SLIDE_MS = 6 * 3600 * 1000
HOT = 5
_WIN = f"""
acc AS (SELECT * FROM wml WHERE NOT is_late),
clk AS (SELECT * FROM acc WHERE event_type = 'CLICK'),
wexp AS (SELECT c.*, (c.event_time // {SLIDE_MS}) * {SLIDE_MS} - i * {SLIDE_MS} AS window_start
         FROM clk c, unnest(range(0, {WINDOW_MS // SLIDE_MS})) AS r(i)),
win AS (SELECT window_start, window_start + {WINDOW_MS} AS window_end, product_id,
               CAST(count(*) AS BIGINT) AS clicks, arg_max(category, event_time) AS category,
               arg_max(product_name, event_time) AS product_name
        FROM wexp GROUP BY window_start, product_id),
cwm AS (SELECT watermark AS close_wm FROM clk ORDER BY ingestion_time DESC, event_id DESC LIMIT 1),
emitted AS (
  SELECT win.*, coalesce(window_end <= (SELECT close_wm FROM cwm), false) AS closed,
         CASE WHEN coalesce(window_end <= (SELECT close_wm FROM cwm), false)
              THEN coalesce(category, 'Geral') || '#' || product_id
              ELSE 'FINAL#' || product_id END AS row_key
  FROM win),
la AS (
  SELECT 'LOGISTICS_ALERT#' || lpad(CAST(9999999999999 - event_time AS VARCHAR), 13, '0') || '#' || coalesce(order_id, 'N/A') AS row_key,
         'LOGISTICS_DELAY' AS alert_type, coalesce(order_id, 'N/A') AS order_id, coalesce(region, 'N/A') AS region,
         coalesce(carrier, 'Desconhecida') AS carrier, coalesce(delay_minutes, 0) AS delay_minutes,
         delivery_status, event_time AS timestamp, ingestion_time AS put_seq
  FROM acc
  WHERE event_type = 'DELIVERY_UPDATE'
    AND (coalesce(delivery_status IN ('DELAYED', 'FAILED_ATTEMPT'), false) OR coalesce(delay_minutes, 0) >= 60)),
ta AS (
  SELECT 'TRENDING_SURGE#' || lpad(CAST(9999999999999 - window_end AS VARCHAR), 13, '0') || '#' || product_id AS row_key,
         'TRENDING_PRODUCT_SURGE' AS alert_type, product_id,
         CASE WHEN closed THEN product_name END AS product_name,
         CASE WHEN closed THEN coalesce(category, 'Geral') END AS category,
         clicks AS clicks_in_window, window_start, window_end, window_end AS put_seq
  FROM emitted WHERE clicks >= {HOT}),
alerts AS (
  SELECT row_key, alert_type, order_id, region, carrier, delay_minutes, delivery_status, timestamp,
         NULL::VARCHAR AS product_id, NULL::VARCHAR AS product_name, NULL::VARCHAR AS category,
         NULL::BIGINT AS clicks_in_window, NULL::BIGINT AS window_start, NULL::BIGINT AS window_end, put_seq
  FROM la
  UNION ALL
  SELECT row_key, alert_type, NULL, NULL, NULL, NULL, NULL, NULL,
         product_id, product_name, category, clicks_in_window, window_start, window_end, put_seq
  FROM ta),
mputs AS (SELECT row_key, clicks AS clicks_window, window_end AS last_window_end FROM emitted)"""

_ALERT_COLS = ("row_key, alert_type, order_id, region, carrier, delay_minutes, delivery_status, timestamp, "
               "product_id, product_name, category, clicks_in_window, window_start, window_end")

ORACLE["sliding_clicks"] = with_ev("SELECT window_start, window_end, product_id, clicks FROM win", _WM, _WIN)
ORACLE["closed_windows"] = with_ev(
    "SELECT window_start, window_end, product_id, clicks, row_key FROM emitted WHERE closed", _WM, _WIN)
ORACLE["final_windows"] = with_ev(
    "SELECT window_start, window_end, product_id, clicks, row_key FROM emitted WHERE NOT closed", _WM, _WIN)
ORACLE["trending_alerts"] = with_ev(
    "SELECT row_key, alert_type, product_id, product_name, category, clicks_in_window, window_start, window_end FROM ta",
    _WM, _WIN)
ORACLE["logistics_alerts"] = with_ev(
    "SELECT row_key, alert_type, order_id, region, carrier, delay_minutes, delivery_status, timestamp FROM la",
    _WM, _WIN)
ORACLE["alerts_all"] = with_ev(f"SELECT {_ALERT_COLS} FROM alerts", _WM, _WIN)
ORACLE["alerts_kv"] = with_ev("""
SELECT row_key, 'info:' || qualifier AS "column", value
FROM (UNPIVOT (SELECT row_key, alert_type, order_id, region, carrier, CAST(delay_minutes AS VARCHAR) AS delay_minutes,
                      delivery_status, CAST(timestamp AS VARCHAR) AS timestamp, product_id, product_name, category,
                      CAST(clicks_in_window AS VARCHAR) AS clicks_in_window, CAST(window_start AS VARCHAR) AS window_start,
                      CAST(window_end AS VARCHAR) AS window_end FROM alerts)
      ON COLUMNS(* EXCLUDE (row_key)) INTO NAME qualifier VALUE value)
WHERE value IS NOT NULL""", _WM, _WIN)
ORACLE["alerts_json"] = with_ev("""
SELECT row_key,
       CASE WHEN alert_type = 'LOGISTICS_DELAY'
            THEN '{"alert_type":"' || alert_type || '","order_id":"' || order_id || '","region":"' || region
                 || '","carrier":"' || carrier || '","delay_minutes":' || delay_minutes
                 || CASE WHEN delivery_status IS NULL THEN '' ELSE ',"delivery_status":"' || delivery_status || '"' END
                 || ',"timestamp":' || timestamp || '}'
            ELSE '{"alert_type":"' || alert_type || '","product_id":"' || product_id || '"'
                 || CASE WHEN product_name IS NULL THEN '' ELSE ',"product_name":"' || product_name || '"' END
                 || CASE WHEN category IS NULL THEN '' ELSE ',"category":"' || category || '"' END
                 || ',"clicks_in_window":' || clicks_in_window || ',"window_start":' || window_start
                 || ',"window_end":' || window_end || '}' END AS payload
FROM alerts""", _WM, _WIN)
ORACLE["recent_alerts"] = with_ev(
    f"SELECT {_ALERT_COLS} FROM alerts WHERE alert_type = 'LOGISTICS_DELAY' ORDER BY row_key LIMIT 20", _WM, _WIN)
ORACLE["alerts_latest"] = with_ev(f"""
SELECT {_ALERT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY put_seq DESC) AS rn FROM alerts) WHERE rn = 1""",
    _WM, _WIN)
ORACLE["alerts_versions"] = with_ev(f"""
SELECT {_ALERT_COLS}, version FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY row_key ORDER BY put_seq DESC) AS INTEGER) AS version FROM alerts)
WHERE version <= 3""", _WM, _WIN)
ORACLE["metrics_latest"] = with_ev("""
SELECT row_key, arg_max(clicks_window, last_window_end) AS clicks_window, max(last_window_end) AS last_window_end
FROM mputs GROUP BY row_key""", _WM, _WIN)
ORACLE["metrics_versions"] = with_ev("""
SELECT row_key, clicks_window, last_window_end, version FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY row_key ORDER BY last_window_end DESC) AS INTEGER) AS version
  FROM mputs) WHERE version <= 5""", _WM, _WIN)
ORACLE["metric_lookup"] = with_ev("""
SELECT row_key, arg_max(clicks_window, last_window_end) AS clicks_window, max(last_window_end) AS last_window_end
FROM mputs WHERE row_key = 'Casa#P-03' GROUP BY row_key""", _WM, _WIN)

# ---- JSON sources: the noise lines mixed into the log (same rules as
# ---- vitrine.sources.driver_events.NOISE_RULES)
_NOISE = """
noise AS (
  SELECT CAST(right(event_id, 2) AS INTEGER) AS d, event_id AS src_id,
         CASE CAST(right(event_id, 2) AS INTEGER)
              WHEN 11 THEN 'not json ' || event_id
              WHEN 22 THEN '[' || CAST(event_time AS VARCHAR) || ']'
              WHEN 33 THEN 'null'
              WHEN 44 THEN '{"event_id":"' || event_id || '","delay_minutes":"abc"}'
              WHEN 55 THEN ''
              WHEN 66 THEN '[]'
              WHEN 77 THEN '{}' END AS line
  FROM ev WHERE CAST(right(event_id, 2) AS INTEGER) IN (11, 22, 33, 44, 55, 66, 77))"""

_NULL_EVENT = ("NULL::VARCHAR, NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, NULL::BOOLEAN, NULL::VARCHAR, "
               "NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE, "
               "NULL::INTEGER, NULL::DOUBLE, NULL::VARCHAR, NULL::DOUBLE, NULL::VARCHAR, NULL::VARCHAR, "
               "NULL::INTEGER, NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE, NULL::INTEGER")

ORACLE["scan_raw_json"] = with_ev(f"SELECT {EVENT_COLS} FROM ev")
_RAW20 = ("event_id, event_time, event_time_iso, ingestion_time, is_simulated_late, event_type, user_id, region, "
          "product_id, product_name, category, price, quantity, subtotal, order_id, total_amount, payment_method, "
          "delivery_status, delay_minutes, carrier")
ORACLE["scan_raw_table"] = with_ev(f"""
SELECT {_RAW20}, strftime(epoch_ms(ingestion_time), '%Y') AS year, strftime(epoch_ms(ingestion_time), '%m') AS month,
       strftime(epoch_ms(ingestion_time), '%d') AS day FROM ev""")
ORACLE["scan_tolerant"] = with_ev(f"""
SELECT {EVENT_COLS} FROM ev
UNION ALL SELECT {_NULL_EVENT} FROM noise WHERE d = 77""", _NOISE)
ORACLE["scan_rejects"] = with_ev("SELECT line FROM noise WHERE d IN (11, 22, 33, 44, 66)", _NOISE)
ORACLE["parse_json_lines"] = with_ev(f"""
SELECT {EVENT_COLS}, NULL::VARCHAR AS _corrupt_record FROM ev
UNION ALL
SELECT {_NULL_EVENT.replace("NULL::VARCHAR", "CASE WHEN d = 44 THEN src_id END", 1)},
       CASE WHEN d = 77 THEN NULL ELSE line END
FROM noise WHERE d <> 55""", _NOISE)
ORACLE["total_events"] = with_ev("""
SELECT CAST((SELECT count(*) FROM ev) + count(CASE WHEN d <> 55 THEN 1 END) AS BIGINT) AS total_events,
       CAST((SELECT count(*) FROM ev) + count(CASE WHEN d = 77 THEN 1 END) AS BIGINT) AS good_events,
       CAST(count(CASE WHEN d IN (11, 22, 33, 44, 66) THEN 1 END) AS BIGINT) AS rejected_events,
       CAST(count(CASE WHEN d = 55 THEN 1 END) AS BIGINT) AS blank_lines
FROM noise""", _NOISE)

# ---- warehouse: what is read back equals the source query
ORACLE["dw_write_funnel"] = ORACLE["funnel"]
ORACLE["dw_write_logistics"] = ORACLE["logistics_sla"]
ORACLE["dw_write_abandoned"] = ORACLE["abandoned_carts"]
ORACLE["dw_write_path"] = ORACLE["funnel"]
PRUNED_DT = "2024-01-15"
ORACLE["dw_read_funnel_dt"] = with_ev(f"""
SELECT * FROM ({_FUNNEL.format(cat="category", dt="strftime(epoch_ms(event_time), '%Y-%m-%d')",
                               group="category, strftime(epoch_ms(event_time), '%Y-%m-%d')")})
WHERE dt = '{PRUNED_DT}'""")

# ---- streaming: equal to the batch results
ORACLE["land_raw_stream"] = ORACLE["scan_tolerant"]
ORACLE["fanout_counts"] = with_ev("""
SELECT c.consumer, CASE WHEN c.consumer = 'stream' THEN 'ecommerce_stream' END AS source_stream, t.event_type, CAST(count(*) AS BIGINT) AS events
FROM (SELECT event_type FROM ev UNION ALL SELECT NULL FROM noise WHERE d = 77) t,
     (VALUES ('landing'), ('stream')) AS c(consumer)
GROUP BY c.consumer, t.event_type""", _NOISE)
ORACLE["stream_follow"] = with_ev("""
SELECT e.window_start, e.window_end, e.product_id, e.clicks, e.row_key, ta.row_key AS alert_key
FROM emitted e LEFT JOIN ta ON e.window_start = ta.window_start AND e.product_id = ta.product_id
WHERE e.closed""", _WM, _WIN)
ORACLE["stream_once"] = with_ev(
    "SELECT window_start, window_end, product_id, clicks, row_key FROM emitted", _WM, _WIN)

# ---- daily mode, ETL job, serving views fed by the stream
_DAY = "strftime(epoch_ms(event_time), '%Y-%m-%d')"
ORACLE["funnel_daily"] = with_ev(_FUNNEL.format(cat="category", dt=_DAY, group=f"category, {_DAY}"))
ORACLE["logistics_sla_daily"] = with_ev(_LOGISTICS.format(dt=_DAY, group=f"carrier, region, {_DAY}"))
ORACLE["batch_etl"] = "\nUNION ALL BY NAME\n".join([
    *[f"""SELECT '{table}' AS "table", * FROM ({ORACLE[key]})""" for table, key in (
        ("dw_sales_funnel_daily", "funnel"), ("dw_logistics_sla_daily", "logistics_sla"),
        ("dw_abandoned_carts_daily", "abandoned_carts"), ("cart_subtotal_by_category", "cart_subtotal_by_category"),
        ("click_checkout_pair_count", "click_checkout_pair_count"))],
    f"""SELECT 'silver_events' AS "table", good_events AS "rows" FROM ({ORACLE["total_events"]})""",
    f"""SELECT 'rejects' AS "table", rejected_events AS "rows" FROM ({ORACLE["total_events"]})"""])
ORACLE["stream_alerts_latest"] = ORACLE["alerts_latest"]
ORACLE["stream_metrics_latest"] = ORACLE["metrics_latest"]
# ---- the stream's own counters: the noisy log's empty objects are events without a type
ORACLE["stream_late_rate"] = with_ev("""
SELECT event_type, CAST(count(*) AS BIGINT) AS total_events,
       CAST(count(CASE WHEN is_late THEN 1 END) AS BIGINT) AS late_events,
       CAST(count(CASE WHEN is_simulated_late THEN 1 END) AS BIGINT) AS flagged_late,
       CAST(count(CASE WHEN is_late AND is_simulated_late THEN 1 END) AS BIGINT) AS flagged_and_late,
       round(count(CASE WHEN is_late THEN 1 END) / count(*) * 100, 2) AS late_pct
FROM wml GROUP BY event_type
UNION ALL SELECT NULL, CAST(count(*) AS BIGINT), 0, 0, 0, 0.0 FROM noise WHERE d = 77 HAVING count(*) > 0""", _WM, _NOISE)
ORACLE["stream_tail"] = ORACLE["land_raw_stream"]
ORACLE["click_checkout_factors"] = with_ev("""
SELECT c.user_id, 'clicks' AS side, c.product_id AS id, CAST(count(*) AS BIGINT) AS n
FROM ev c WHERE event_type = 'CLICK' AND user_id IN (SELECT user_id FROM ev WHERE event_type = 'CHECKOUT_COMPLETED') GROUP BY 1, 3
UNION ALL
SELECT o.user_id, 'orders', o.order_id, CAST(count(*) AS BIGINT)
FROM ev o WHERE event_type = 'CHECKOUT_COMPLETED' AND user_id IN (SELECT user_id FROM ev WHERE event_type = 'CLICK') GROUP BY 1, 3""")
ORACLE["land_rolled"] = ORACLE["land_raw_stream"]
