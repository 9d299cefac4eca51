"""Deterministic test inputs derived from the driver's read-only tables.

FX-SILVER, FX-RAW, FX-PRODUCTS, FX-SILVER-BAD and FX-VERSIONS (see FIXTURES.md)
are pure DataFrame transformations of `events` / `part`, so they grow with the
input and run fully distributed.  Integer arithmetic only, so an independent
SQL engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.time import format_iso_millis_utc
from tessera.schemas import SILVER_TABLE_COLUMNS

# ---------------------------------------------------------------------------
# Fixed fixture values (chosen by `event_id % len(list)`).
# ---------------------------------------------------------------------------
EVENT_TYPE_MAP = {
    "view": "view",
    "signup": "search",
    "click": "add_to_cart",
    "purchase": "purchase",
    "error": "refund",
}
DEVICE_OS = [f"os{i}" for i in range(4)]
GEO_REGIONS = [f"r{i}" for i in range(5)]
GEO_CITIES = [f"t{i}" for i in range(6)]
REFERRERS = [f"ref{i}" for i in range(3)]
UTM_CAMPAIGNS = [f"camp{i}" for i in range(4)]
UTM_MEDIUMS = [f"m{i}" for i in range(5)]
PAGES = [f"page{i}" for i in range(4)]
PAYMENT_METHODS = [f"pay{i}" for i in range(3)]
REASON_CODES = [f"reason{i}" for i in range(4)]
SHIPPING_CLASSES = [f"ship{i}" for i in range(3)]
# FX-RAW anomaly selectors: residue of event_id % RAW_ANOMALY_MOD.
RAW_ANOMALY_MOD = 251
RAW_EMPTY_PAYLOAD, RAW_NAIVE_TIME, RAW_BOOL_VERSION = 7, 8, 9
RAW_OBJECT_BRAND, RAW_SPACED_EXP_PRICE, RAW_DUP_KEY, RAW_NUMERIC_ID, RAW_LONG_USER = 10, 11, 12, 13, 14
# Those that break a rule of the gate occur only on days of the month divisible by
# this, so that days pass and days fail at every size.
RAW_BREAKING_DAYS = 3
# Per day: one line each that is no JSON, no object, blank, followed by text, two objects, no UTF-8 (0xFF).
RAW_JUNK_LINES = ["not json", "[1,2]", "", '{"event_id":"x"} garbage', '{"event_id":"x"}{"event_id":"y"}']
PRODUCTS_PER_FILE = 50_000
RAW_JUNK_BYTES = '{"event_id":"x'.encode() + bytes([0xFF]) + b'"}'
# FX-SILVER-BAD: rows with event_id % BAD_MOD = j carry violation j on days of the
# month divisible by 3; the day after such a day is clean, and on the next one every
# tenth row breaks the time order (over the rule's ratio).
BAD_MOD = 53
BAD_ORDER_MOD = 10
# ---------------------------------------------------------------------------


def _day_of_month() -> Column:
    return F.substring("dt", 9, 2).cast("int")


def _raw_residue() -> Column:
    """`event_id % RAW_ANOMALY_MOD`; -1 where it would break the gate on a day that passes."""
    r = F.col("_id") % RAW_ANOMALY_MOD
    breaking = r.isin(RAW_EMPTY_PAYLOAD, RAW_NAIVE_TIME, RAW_BOOL_VERSION)
    return F.when(breaking & (_day_of_month() % RAW_BREAKING_DAYS != 0), -1).otherwise(r)


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _q(c: Column) -> Column:
    """JSON string literal of a safe (quote-free) value."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _silver_base(events: DataFrame) -> DataFrame:
    """Typed FX-SILVER columns plus helper columns (`_id`, `_k`, `_cents`, `_has_product`)."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    etype = F.col("event_type")
    mapped = F.lit(None).cast("string")
    for src, dst in EVENT_TYPE_MAP.items():
        mapped = F.when(etype == src, F.lit(dst)).otherwise(mapped)
    ts = F.col("ts").cast("timestamp")
    return events.select(
        eid.alias("_id"),
        k.alias("_k"),
        F.round(F.col("value") * 100).cast("long").alias("_cents"),
        mapped.alias("_type"),
        F.date_trunc("millisecond", ts).alias("_event_time"),
        F.hour("ts").alias("_hour"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.col("user_id").alias("_user"),
    )


def fx_silver(events: DataFrame) -> DataFrame:
    """FX-SILVER: the Silver table (30 columns + `dt`) derived from `events`."""
    return _fx_columns(_silver_base(events)).select(*SILVER_TABLE_COLUMNS)


def _payload_text(raw: bool = False, py: bool = True) -> Column:
    """JSON text of the payload, keys in a fixed order per event type.

    `py=True` writes json.dumps' separators (`", "`, `": "`), as Silver stores
    it; `py=False` writes compact JSON, as the raw landing lines carry it.
    With `raw=True` the FX-RAW anomalies are applied (price as text, `" 1e3 "`,
    object-valued brand, empty payload)."""
    eid, k, cents, etype = F.col("_id"), F.col("_k"), F.col("_cents"), F.col("_type")
    comma, colon = (", ", ": ") if py else (",", ":")

    def kv(name: str, value: Column, first: bool = False) -> list[Column]:
        return [F.lit(("{" if first else comma) + f'"{name}"' + colon), value]

    r = _raw_residue()
    qty = (eid % 3 + 1) * F.when(eid % 89 == 0, -1).otherwise(1)
    product = F.when(eid % 67 == 0, F.concat(F.lit("PX"), _s(k))).otherwise(F.concat(F.lit("P"), _s(k)))
    category = F.concat(F.lit("C0"), _s(k % 8 + 1))
    brand = F.concat(F.lit("B"), _s(k % 10))
    price_text = _s(cents)
    brand_text = _q(brand)
    if raw:
        price_text = (
            F.when(r == RAW_SPACED_EXP_PRICE, F.lit('" 1e3 "'))
            .when(eid % 97 == 0, _q(_s(cents)))
            .otherwise(_s(cents))
        )
        brand_text = F.when(
            r == RAW_OBJECT_BRAND, F.concat(F.lit('{"name"' + colon), _q(brand), F.lit("}"))
        ).otherwise(_q(brand))
    product_part = [
        *kv("product_id", _q(product), first=True),
        *kv("category_id", _q(category)),
        *kv("brand", brand_text),
        *kv("price", price_text),
    ]
    coupon = F.when(eid % 4 == 0, F.lit('"CP10"')).when(eid % 4 == 1, F.lit('"FREESHIP"')).otherwise(F.lit("null"))
    end = F.lit("}")
    order = _q(F.concat(F.lit("O"), _s(eid)))
    text = (
        F.when(
            etype == "view",
            F.concat(*product_part, *kv("page", _q(_pick(PAGES, eid))), *kv("position", _s(eid % 39 + 1)), end),
        )
        .when(etype == "add_to_cart", F.concat(*product_part, *kv("quantity", _s(qty)), end))
        .when(
            etype == "purchase",
            F.concat(
                *product_part,
                *kv("order_id", order),
                *kv("quantity", _s(qty)),
                *kv("total_amount", _s(cents * (eid % 3 + 1))),
                *kv("payment_method", _q(_pick(PAYMENT_METHODS, eid))),
                *kv("coupon_id", coupon),
                end,
            ),
        )
        .when(
            etype == "search",
            F.concat(*kv("query", _q(F.concat(F.lit("q"), _s(k))), first=True), *kv("results_count", _s(k)), end),
        )
        .when(
            etype == "refund",
            F.concat(
                *kv("order_id", order, first=True),
                *kv("refund_amount", _s(cents)),
                *kv("reason_code", _q(_pick(REASON_CODES, eid))),
                end,
            ),
        )
    )
    if raw:
        text = F.when(r == RAW_EMPTY_PAYLOAD, F.lit("{}")).otherwise(text)
    return text


def _fx_columns(b: DataFrame) -> DataFrame:
    eid, k, cents, etype = F.col("_id"), F.col("_k"), F.col("_cents"), F.col("_type")
    has_product = etype.isin("view", "add_to_cart", "purchase")
    has_qty = etype.isin("add_to_cart", "purchase")
    v2 = eid % 5 == 0
    et = F.col("_event_time")
    late_hours = F.when(eid % 20 == 0, eid % 35 + 1).otherwise(0)
    ingest = F.timestamp_micros(F.unix_micros(et) + (eid % 30) * 1_000_000 + late_hours * 3_600_000_000)
    qty = ((eid % 3 + 1) * F.when(eid % 89 == 0, -1).otherwise(1)).cast("int")
    return b.select(
        F.concat(F.lit("E"), _s(eid)).alias("event_id"),
        F.when(v2, 2).otherwise(1).cast("int").alias("schema_version"),
        etype.alias("event_type"),
        et.alias("event_time"),
        ingest.alias("ingest_time"),
        F.when(eid % 101 != 0, F.concat(F.lit("U"), _s(F.col("_user")))).alias("user_id"),
        F.when(
            eid % 103 != 0,
            F.concat(F.lit("S"), _s(F.col("_user")), F.lit("-"), _s(F.floor(F.col("_hour") / 6))),
        ).alias("session_id"),
        _pick(DEVICE_OS, eid).alias("device_os"),
        F.when(v2, F.concat(_s(eid % 6 + 10), F.lit("."), _s(eid % 9))).alias("device_os_version"),
        F.concat(_s(eid % 4 + 1), F.lit("."), _s(eid % 20), F.lit("."), _s(eid % 50)).alias("device_app_version"),
        F.lit("KR").alias("geo_country"),
        _pick(GEO_REGIONS, eid).alias("geo_region"),
        _pick(GEO_CITIES, eid).alias("geo_city"),
        _pick(REFERRERS, eid).alias("source_referrer"),
        _pick(UTM_CAMPAIGNS, eid).alias("source_utm_campaign"),
        _pick(UTM_MEDIUMS, eid).alias("source_utm_medium"),
        F.when(
            has_product,
            F.when(eid % 67 == 0, F.concat(F.lit("PX"), _s(k))).otherwise(F.concat(F.lit("P"), _s(k))),
        ).alias("product_id"),
        F.when(has_product, F.concat(F.lit("C0"), _s(k % 8 + 1))).alias("category_id"),
        F.when(has_product, F.concat(F.lit("B"), _s(k % 10))).alias("brand"),
        F.when(has_product, cents).alias("price"),
        F.when(has_qty, qty).alias("quantity"),
        F.when(etype.isin("purchase", "refund"), F.concat(F.lit("O"), _s(eid))).alias("order_id"),
        F.when(etype == "purchase", cents * (eid % 3 + 1)).alias("total_amount"),
        F.when(etype == "purchase", _pick(PAYMENT_METHODS, eid)).alias("payment_method"),
        F.when(etype == "purchase", F.when(eid % 4 == 0, F.lit("CP10")).when(eid % 4 == 1, F.lit("FREESHIP")))
        .alias("coupon_id"),
        F.when(etype == "search", F.concat(F.lit("q"), _s(k))).alias("search_query"),
        F.when(etype == "search", k).alias("results_count"),
        F.when(etype == "refund", cents).alias("refund_amount"),
        F.when(etype == "refund", _pick(REASON_CODES, eid)).alias("reason_code"),
        _payload_text().alias("payload_json"),
        F.col("dt"),
        eid.alias("_id"),
        k.alias("_k"),
        cents.alias("_cents"),
        etype.alias("_type"),
        F.col("_hour"),
        F.col("_user"),
    )


def _dealt(events: DataFrame) -> DataFrame:
    """The events spread over more tasks than cores.

    An event is a few bytes in Parquet and much work as a line, so the scan's splits
    (whole row groups) would be too few tasks for it.  A given number, as AQE would make one of small rows.
    """
    return events.repartition(4 * events.sparkSession.sparkContext.defaultParallelism)


def fx_raw_lines(events: DataFrame) -> DataFrame:
    """FX-RAW as rows `(dt, batch, line)`: batch 0 is the first landing file of
    a day, batch 1 the later-sorting resend file (`event_id % 200 = 0`)."""
    rows = _fx_columns(_silver_base(_dealt(events)))
    eid = F.col("_id")
    r = _raw_residue()

    def opt(name: str, value: Column) -> Column:
        return F.concat(F.lit(f',"{name}":'), F.coalesce(_q(value), F.lit("null")))

    event_id_text = F.when(r == RAW_NUMERIC_ID, _s(eid)).otherwise(_q(F.col("event_id")))
    version_text = F.when(r == RAW_BOOL_VERSION, F.lit("true")).otherwise(_s(F.col("schema_version")))
    time_fmt = F.when(
        r == RAW_NAIVE_TIME, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    ).otherwise(format_iso_millis_utc(F.col("event_time")))
    device = F.concat(
        F.lit('{"os":'), _q(F.col("device_os")),
        F.lit(',"app_version":'), _q(F.col("device_app_version")),
        F.when(F.col("device_os_version").isNotNull(),
               F.concat(F.lit(',"os_version":'), _q(F.col("device_os_version")))).otherwise(F.lit("")),
        F.lit("}"),
    )
    geo = F.concat(
        F.lit('{"country":'), _q(F.col("geo_country")),
        F.lit(',"region":'), _q(F.col("geo_region")),
        F.lit(',"city":'), _q(F.col("geo_city")),
        F.lit("}"),
    )
    source = F.concat(
        F.lit('{"referrer":'), _q(F.col("source_referrer")),
        F.lit(',"utm_campaign":'), _q(F.col("source_utm_campaign")),
        F.lit(',"utm_medium":'), _q(F.col("source_utm_medium")),
        F.lit("}"),
    )

    def line(ingest_text: Column) -> Column:
        return F.concat(
            F.lit("{"),
            F.when(r == RAW_DUP_KEY, F.lit('"event_type":"duplicate",')).otherwise(F.lit("")),
            F.lit('"event_id":'), event_id_text,
            F.lit(',"schema_version":'), version_text,
            F.lit(',"event_type":'), _q(F.col("event_type")),
            F.lit(',"event_time":'), _q(time_fmt),
            F.lit(',"ingest_time":'), _q(ingest_text),
            F.when((r == RAW_LONG_USER) & F.col("user_id").isNotNull(),
                   F.concat(F.lit(',"user_id":'), _s(eid), F.lit("0" * 40))).otherwise(opt("user_id", F.col("user_id"))),
            opt("session_id", F.col("session_id")),
            F.lit(',"device":'), device,
            F.lit(',"geo":'), geo,
            F.lit(',"source":'), source,
            F.lit(',"payload":'), _payload_text(raw=True, py=False),
            F.lit("}"),
        )

    first = rows.select("dt", F.lit(0).alias("batch"), line(format_iso_millis_utc(F.col("ingest_time"))).alias("line"))
    resend_ts = F.timestamp_micros(
        F.unix_micros(F.to_timestamp(F.col("dt"), "yyyy-MM-dd")) + (86_400 + eid % 3600) * 1_000_000
    )
    resend = rows.where(eid % 200 == 0).select(
        "dt", F.lit(1).alias("batch"), line(format_iso_millis_utc(resend_ts)).alias("line")
    )
    junk_lines = [*[F.lit(x) for x in RAW_JUNK_LINES], F.unhex(F.lit(RAW_JUNK_BYTES.hex())).cast("string")]
    junk = (
        _silver_base(events).select("dt").distinct()
        .select("dt", F.lit(0).alias("batch"), F.explode(F.array(*junk_lines)).alias("line"))
    )
    return first.unionByName(resend).unionByName(junk)


def write_fx_raw(events: DataFrame, root: str, batches: list[int] | None = None) -> str:
    """Land FX-RAW (or the named batches of it) as `root/dt=D/batch=N/part-*.txt` JSON-lines files."""
    lines = fx_raw_lines(events)
    (
        (lines if batches is None else lines.where(F.col("batch").isin(batches)))
        # Cluster by day directory; AQE splits a day that is too large, so a
        # hot day is written by several tasks (several files) instead of one.
        .hint("rebalance", "dt", "batch")
        .write.mode("overwrite")
        .partitionBy("dt", "batch")
        .text(root)
    )
    return root


def fx_products(part: DataFrame) -> DataFrame:
    """FX-PRODUCTS: the product dimension, all keys of `part`."""
    key = F.col("p_partkey")
    return part.where(key.isNotNull()).select(
        F.concat(F.lit("P"), _s(key)).alias("product_id"),
        F.concat(F.lit("C0"), _s(key % 8 + 1)).alias("category_id"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("base_price"),
        F.col("p_brand").alias("brand"),
        _pick(SHIPPING_CLASSES, key).alias("shipping_class"),
        (key % 10 == 0).alias("is_fragile"),
    )


def write_fx_products(part: DataFrame, path: str) -> str:
    """FX-PRODUCTS as JSON arrays, one file of at most `PRODUCTS_PER_FILE` products each."""
    products = fx_products(part).withColumn("chunk", F.floor(event_number("product_id") / PRODUCTS_PER_FILE))
    item = F.struct(*[c for c in products.columns if c != "chunk"])
    arrays = products.groupBy("chunk").agg(F.to_json(F.collect_list(item)).alias("value"))
    arrays.write.partitionBy("chunk").text(path)
    return path


def fx_silver_bad(events: DataFrame) -> DataFrame:
    """FX-SILVER-BAD: FX-SILVER where, on every third day, rows with `event_id % 53 = j` break rule j."""
    s = _fx_columns(_silver_base(events))
    day = _day_of_month() % 3
    # 6 breaks the time order
    j = F.when(day == 0, F.col("_id") % BAD_MOD).when((day == 2) & (F.col("_id") % BAD_ORDER_MOD == 0), 6).otherwise(-1)

    def brk(n: int, bad: Column, name: str) -> Column:
        return F.when(j == n, bad).otherwise(F.col(name)).alias(name)

    broken = {
        "event_id": F.when(j == 13, F.concat(F.lit("E"), _s(F.col("_id") - 13)))
        .when(j == 14, F.lit(None).cast("string"))
        .otherwise(F.col("event_id")).alias("event_id"),
        "event_type": F.when(j == 1, F.lit(None).cast("string")).when(j == 2, F.lit("unknown"))
        .otherwise(F.col("event_type")).alias("event_type"),
        "schema_version": brk(3, F.lit(3), "schema_version"),
        "event_time": F.when(j == 4, F.lit(None).cast("timestamp"))
        .when(j == 6, F.col("ingest_time") + F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.col("event_time")).alias("event_time"),
        "ingest_time": brk(5, F.lit(None).cast("timestamp"), "ingest_time"),
        "price": brk(7, -F.col("price"), "price"),
        "total_amount": brk(8, -F.col("total_amount"), "total_amount"),
        "refund_amount": F.when(j == 9, -F.col("refund_amount")).when(j == 12, F.lit(None).cast("long"))
        .otherwise(F.col("refund_amount")).alias("refund_amount"),
        "order_id": brk(10, F.lit(None).cast("string"), "order_id"),
        "search_query": brk(11, F.lit(None).cast("string"), "search_query"),
    }
    return s.select(*[broken.get(c, F.col(c)) for c in SILVER_TABLE_COLUMNS])


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


__all__ = [
    "fx_silver",
    "fx_raw_lines",
    "write_fx_raw",
    "fx_products",
    "write_fx_products",
    "fx_silver_bad",
    "load_table",
]


# FX-VERSIONS commit times (fixed literals, UTC).
VERSION_COMMIT_TIMES = ["2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"]
VERSION_REWRITES = [("2024-01-05", 10), ("2024-01-06", 7)]


def event_number(col: str = "event_id") -> Column:
    """The integer behind an FX `event_id` ('E123' → 123)."""
    return F.substring(F.col(col), 2, 64).cast("long")


def fx_versions(silver: DataFrame, root: str) -> list[int]:
    """FX-VERSIONS: snapshot 1 = all rows; then each rewrite `(dt, m)` overwrites
    day `dt` with its rows where `event_id % m <> 0`."""
    import datetime as _dt

    from tessera.sources.versioned import commit

    times = [_dt.datetime.fromisoformat(t).replace(tzinfo=_dt.timezone.utc) for t in VERSION_COMMIT_TIMES]
    ids = [commit(silver, root, "append", times[0])]
    for (day, m), when in zip(VERSION_REWRITES, times[1:]):
        keep = silver.where((F.col("dt") == day) & (event_number() % m != 0))
        ids.append(commit(keep, root, "overwrite", when, dates=[day]))
    return ids
