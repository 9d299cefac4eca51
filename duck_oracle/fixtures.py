"""FIXTURES.md re-derived in DuckDB SQL from the pre-registered `events` / `part` views."""

from __future__ import annotations


def _pick(values: list[str], idx: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[({idx}) % {len(values)} + 1]"


# ---------------------------------------------------------------------------
# Fixed fixture values (the same lists as tessera.sources.fixtures, chosen by
# `event_id % len(list)`; the oracle must derive identical rows).
# ---------------------------------------------------------------------------
OS = [f"os{i}" for i in range(4)]
REGIONS = [f"r{i}" for i in range(5)]
CITIES = [f"t{i}" for i in range(6)]
REFERRERS = [f"ref{i}" for i in range(3)]
CAMPAIGNS = [f"camp{i}" for i in range(4)]
MEDIUMS = [f"m{i}" for i in range(5)]
PAGES = [f"page{i}" for i in range(4)]
PAYMENTS = [f"pay{i}" for i in range(3)]
REASONS = [f"reason{i}" for i in range(4)]
SHIPPING = [f"ship{i}" for i in range(3)]
# ---------------------------------------------------------------------------

BASE = """
fx_b AS (
  SELECT event_id AS _id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS _k,
         CAST(round(value * 100) AS BIGINT) AS _cents,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'signup' THEN 'search' WHEN 'click' THEN 'add_to_cart'
              WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'refund' END AS _type,
         date_trunc('millisecond', ts) AS _event_time,
         hour(ts) AS _hour,
         strftime(ts, '%Y-%m-%d') AS dt,
         user_id AS _user
  FROM events
)"""


def payload_sql(raw: bool) -> str:
    """Payload text as json.dumps writes it (separators ", " and ": ")."""
    price = "CAST(_cents AS VARCHAR)"
    brand = "'\"B' || CAST(_k % 10 AS VARCHAR) || '\"'"
    if raw:
        price = (
            "CASE WHEN _r = 11 THEN '\" 1e3 \"' WHEN _id % 97 = 0 THEN '\"' || CAST(_cents AS VARCHAR) || '\"' "
            "ELSE CAST(_cents AS VARCHAR) END"
        )
        brand = (
            "CASE WHEN _r = 10 THEN '{\"name\": \"B' || CAST(_k % 10 AS VARCHAR) || '\"}' "
            "ELSE '\"B' || CAST(_k % 10 AS VARCHAR) || '\"' END"
        )
    product = (
        "'{\"product_id\": \"' || CASE WHEN _id % 67 = 0 THEN 'PX' ELSE 'P' END || CAST(_k AS VARCHAR) || '\"'"
        " || ', \"category_id\": \"C0' || CAST(_k % 8 + 1 AS VARCHAR) || '\"'"
        f" || ', \"brand\": ' || {brand}"
        f" || ', \"price\": ' || {price}"
    )
    qty = "CAST((_id % 3 + 1) * CASE WHEN _id % 89 = 0 THEN -1 ELSE 1 END AS VARCHAR)"
    coupon = "CASE WHEN _id % 4 = 0 THEN '\"CP10\"' WHEN _id % 4 = 1 THEN '\"FREESHIP\"' ELSE 'null' END"
    text = f"""CASE _type
      WHEN 'view' THEN {product} || ', "page": "' || {_pick(PAGES, '_id')} || '", "position": ' || CAST(_id % 39 + 1 AS VARCHAR) || '}}'
      WHEN 'add_to_cart' THEN {product} || ', "quantity": ' || {qty} || '}}'
      WHEN 'purchase' THEN {product} || ', "order_id": "O' || CAST(_id AS VARCHAR) || '", "quantity": ' || {qty}
           || ', "total_amount": ' || CAST(_cents * (_id % 3 + 1) AS VARCHAR)
           || ', "payment_method": "' || {_pick(PAYMENTS, '_id')} || '", "coupon_id": ' || {coupon} || '}}'
      WHEN 'search' THEN '{{"query": "q' || CAST(_k AS VARCHAR) || '", "results_count": ' || CAST(_k AS VARCHAR) || '}}'
      WHEN 'refund' THEN '{{"order_id": "O' || CAST(_id AS VARCHAR) || '", "refund_amount": ' || CAST(_cents AS VARCHAR)
           || ', "reason_code": "' || {_pick(REASONS, '_id')} || '"}}'
    END"""
    if raw:
        text = f"CASE WHEN _r = 7 THEN '{{}}' ELSE {text} END"
    return text


def _columns() -> str:
    hp = "_type IN ('view', 'add_to_cart', 'purchase')"
    hq = "_type IN ('add_to_cart', 'purchase')"
    return f"""
  'E' || CAST(_id AS VARCHAR) AS event_id,
  CAST(CASE WHEN _id % 5 = 0 THEN 2 ELSE 1 END AS INTEGER) AS schema_version,
  _type AS event_type,
  _event_time AS event_time,
  _event_time + to_microseconds((_id % 30) * 1000000
      + CASE WHEN _id % 20 = 0 THEN _id % 35 + 1 ELSE 0 END * 3600000000) AS ingest_time,
  CASE WHEN _id % 101 <> 0 THEN 'U' || CAST(_user AS VARCHAR) END AS user_id,
  CASE WHEN _id % 103 <> 0 THEN 'S' || CAST(_user AS VARCHAR) || '-' || CAST(_hour // 6 AS VARCHAR) END AS session_id,
  {_pick(OS, '_id')} AS device_os,
  CASE WHEN _id % 5 = 0 THEN CAST(_id % 6 + 10 AS VARCHAR) || '.' || CAST(_id % 9 AS VARCHAR) END AS device_os_version,
  CAST(_id % 4 + 1 AS VARCHAR) || '.' || CAST(_id % 20 AS VARCHAR) || '.' || CAST(_id % 50 AS VARCHAR) AS device_app_version,
  'KR' AS geo_country,
  {_pick(REGIONS, '_id')} AS geo_region,
  {_pick(CITIES, '_id')} AS geo_city,
  {_pick(REFERRERS, '_id')} AS source_referrer,
  {_pick(CAMPAIGNS, '_id')} AS source_utm_campaign,
  {_pick(MEDIUMS, '_id')} AS source_utm_medium,
  CASE WHEN {hp} THEN CASE WHEN _id % 67 = 0 THEN 'PX' ELSE 'P' END || CAST(_k AS VARCHAR) END AS product_id,
  CASE WHEN {hp} THEN 'C0' || CAST(_k % 8 + 1 AS VARCHAR) END AS category_id,
  CASE WHEN {hp} THEN 'B' || CAST(_k % 10 AS VARCHAR) END AS brand,
  CASE WHEN {hp} THEN _cents END AS price,
  CAST(CASE WHEN {hq} THEN (_id % 3 + 1) * CASE WHEN _id % 89 = 0 THEN -1 ELSE 1 END END AS INTEGER) AS quantity,
  CASE WHEN _type IN ('purchase', 'refund') THEN 'O' || CAST(_id AS VARCHAR) END AS order_id,
  CASE WHEN _type = 'purchase' THEN _cents * (_id % 3 + 1) END AS total_amount,
  CASE WHEN _type = 'purchase' THEN {_pick(PAYMENTS, '_id')} END AS payment_method,
  CASE WHEN _type = 'purchase' THEN CASE WHEN _id % 4 = 0 THEN 'CP10' WHEN _id % 4 = 1 THEN 'FREESHIP' END END AS coupon_id,
  CASE WHEN _type = 'search' THEN 'q' || CAST(_k AS VARCHAR) END AS search_query,
  CASE WHEN _type = 'search' THEN _k END AS results_count,
  CASE WHEN _type = 'refund' THEN _cents END AS refund_amount,
  CASE WHEN _type = 'refund' THEN {_pick(REASONS, '_id')} END AS reason_code,
  {payload_sql(False)} AS payload_json,
  dt"""


SILVER_COLS = (
    "event_id, schema_version, event_type, event_time, ingest_time, user_id, session_id, device_os, "
    "device_os_version, device_app_version, geo_country, geo_region, geo_city, source_referrer, "
    "source_utm_campaign, source_utm_medium, product_id, category_id, brand, price, quantity, order_id, "
    "total_amount, payment_method, coupon_id, search_query, results_count, refund_amount, reason_code, "
    "payload_json, dt"
)

# `silver` = FX-SILVER (with helper columns _id, _k, _cents, _type and the raw anomaly _r).
SILVER_CTES = f"""{BASE},
silver AS (
  SELECT {_columns()}, _id, _k, _cents, _type,
         CASE WHEN _id % 251 IN (7, 8, 9) AND CAST(substr(dt, 9, 2) AS INTEGER) % 3 <> 0 THEN -1 ELSE _id % 251 END AS _r
  FROM fx_b
)"""


def with_silver(body: str) -> str:
    return f"WITH {SILVER_CTES}\n{body}"


STG = """stg AS (
  SELECT event_id, schema_version, event_type, event_time AS event_ts, CAST(event_time AS DATE) AS event_date,
         ingest_time AS ingest_ts, user_id, session_id, device_os, device_os_version, device_app_version,
         geo_country, geo_region, geo_city, source_referrer, source_utm_campaign, source_utm_medium, product_id,
         category_id, brand, price, quantity, order_id, total_amount, payment_method, coupon_id, search_query,
         results_count, refund_amount, reason_code, payload_json, dt
  FROM silver
)"""

PRODUCTS = f"""products AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id,
         'C0' || CAST(p_partkey % 8 + 1 AS VARCHAR) AS category_id,
         CAST(round(p_retailprice * 100) AS BIGINT) AS base_price,
         p_brand AS brand,
         {_pick(SHIPPING, 'p_partkey')} AS shipping_class,
         p_partkey % 10 = 0 AS is_fragile
  FROM part WHERE p_partkey IS NOT NULL
)"""
