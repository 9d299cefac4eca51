"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the data contract for results to match).
# ---------------------------------------------------------------------------
EVENT_TYPES = ["view", "search", "add_to_cart", "purchase", "refund"]
SCHEMA_VERSIONS = [1, 2]
RULE_SEVERITY = "FAIL"
TIME_ORDER_MAX_RATIO = 0.05
SILVER_ROWS_PER_FILE = 50000
ISO_MILLIS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_SECONDS_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Quality rules, in report order.
QUALITY_RULES = [
    "partition_not_empty",
    "event_id_unique",
    "event_type_allowed",
    "schema_version_allowed",
    "event_time_not_null",
    "ingest_time_not_null",
    "event_time_lte_ingest_time_ratio",
    "price_non_negative",
    "total_amount_non_negative",
    "refund_amount_non_negative",
    "purchase_requires_order_id",
    "search_requires_query",
    "refund_requires_amount",
]
# ---------------------------------------------------------------------------

_S, _I, _L, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()

SILVER_FIELDS = [
    ("event_id", _S, False),
    ("schema_version", _I, True),
    ("event_type", _S, True),
    ("event_time", _TS, True),
    ("ingest_time", _TS, True),
    ("user_id", _S, True),
    ("session_id", _S, True),
    ("device_os", _S, True),
    ("device_os_version", _S, True),
    ("device_app_version", _S, True),
    ("geo_country", _S, True),
    ("geo_region", _S, True),
    ("geo_city", _S, True),
    ("source_referrer", _S, True),
    ("source_utm_campaign", _S, True),
    ("source_utm_medium", _S, True),
    ("product_id", _S, True),
    ("category_id", _S, True),
    ("brand", _S, True),
    ("price", _L, True),
    ("quantity", _I, True),
    ("order_id", _S, True),
    ("total_amount", _L, True),
    ("payment_method", _S, True),
    ("coupon_id", _S, True),
    ("search_query", _S, True),
    ("results_count", _I, True),
    ("refund_amount", _L, True),
    ("reason_code", _S, True),
    ("payload_json", _S, True),
]

SILVER_SCHEMA = T.StructType([T.StructField(n, t, nullable) for n, t, nullable in SILVER_FIELDS])
SILVER_COLUMNS = [n for n, _, _ in SILVER_FIELDS]
# The table form adds the partition column.
SILVER_TABLE_SCHEMA = T.StructType(SILVER_SCHEMA.fields + [T.StructField("dt", _S, True)])
SILVER_TABLE_COLUMNS = SILVER_COLUMNS + ["dt"]

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", _S),
        T.StructField("category_id", _S),
        T.StructField("base_price", _L),
        T.StructField("brand", _S),
        T.StructField("shipping_class", _S),
        T.StructField("is_fragile", T.BooleanType()),
    ]
)

GOLD_EVENT_COLUMNS = [
    "dt",
    "total_events",
    "view_events",
    "search_events",
    "add_to_cart_events",
    "purchase_events",
    "refund_events",
]
GOLD_REVENUE_COLUMNS = ["dt", "gross_revenue", "refund_amount", "net_revenue"]
GOLD_CONVERSION_COLUMNS = [
    "dt",
    "view_events",
    "add_to_cart_events",
    "purchase_events",
    "view_to_cart_rate",
    "cart_to_purchase_rate",
    "view_to_purchase_rate",
]
