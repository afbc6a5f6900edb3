"""Fixed values of the event domain and the pipeline's defaults.

FIXED VALUES: these must equal the event producer's vocabulary and the
streaming job's defaults for results to match.  They are stated plainly,
in natural order, together.
"""

# --- fixed values: event types -------------------------------------------
CLICK = "CLICK"
CART_ADD = "CART_ADD"
CART_REMOVE = "CART_REMOVE"
CHECKOUT = "CHECKOUT_COMPLETED"
DELIVERY = "DELIVERY_UPDATE"

# --- fixed values: delivery statuses and their SLA buckets ---------------
ON_TIME_STATUSES = ("DELIVERED", "IN_TRANSIT", "DISPATCHED")
DELAYED_STATUS = "DELAYED"
FAILED_STATUS = "FAILED_ATTEMPT"
ALERT_STATUSES = ("DELAYED", "FAILED_ATTEMPT")
ALERT_DELAY_MINUTES = 60

# --- fixed values: defaults for absent fields ----------------------------
DEFAULT_DELAY_MINUTES = 0
DEFAULT_ORDER_ID = "N/A"
DEFAULT_REGION = "N/A"
DEFAULT_CARRIER = "Desconhecida"
DEFAULT_STREAM_CATEGORY = "Geral"
DEFAULT_FALLBACK_CATEGORY = "Outros"

# --- fixed values: alert payloads and keyed-table layout -----------------
LOGISTICS_ALERT_PREFIX = "LOGISTICS_ALERT"
LOGISTICS_ALERT_TYPE = "LOGISTICS_DELAY"
TRENDING_ALERT_PREFIX = "TRENDING_SURGE"
TRENDING_ALERT_TYPE = "TRENDING_PRODUCT_SURGE"
FINAL_METRIC_PREFIX = "FINAL"
REVERSE_TS_BASE = 9999999999999
ALERT_VERSIONS = 3
METRIC_VERSIONS = 5
ALERT_FAMILY = "info"
METRIC_FAMILY = "stats"

# --- fixed values: streaming defaults (the producer's seconds) -----------
HOT_PRODUCT_THRESHOLD = 5
MAX_ALLOWED_DELAY_MS = 15_000
WINDOW_SIZE_MS = 60_000
WINDOW_SLIDE_MS = 15_000

# --- fixed values: landing zone ------------------------------------------
SOURCE_STREAM_TAG = "ecommerce_stream"
LANDING_ROLL_SECONDS = 60
LANDING_ROLL_BYTES = 10_485_760
LANDING_IDLE_SECONDS = 30

# Written in a row key in place of a part that is NULL.
NULL_KEY_PART = "NULL"

# Records per landed file: the documented 10 MB roll at about 500 bytes a record.
LANDING_ROLL_RECORDS = 20_000
