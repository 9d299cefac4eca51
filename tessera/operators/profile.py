"""Raw anomaly profile (O1-O7) and referential-integrity breaks.

All measures are per-`dt` aggregates; the only join is against the product
dimension (deduplicated keys), which the planner broadcasts only when its
size is under the broadcast threshold and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.metrics import count_when
from tessera.operators.silver import first_copies

LATE_AFTER_MS = 3_600_000  # O1: ingest at least one hour after the event


def unknown_products(silver: DataFrame, products: DataFrame) -> DataFrame:
    """Events whose `product_id` is not in the catalog, per day.

    Events are first reduced to `(dt, product_id) → count` (partial aggregation
    map-side), so the join sees one row per day and product — a product that
    holds a large share of the events cannot skew it."""
    keys = products.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    per_product = (
        silver.where(F.col("product_id").isNotNull()).groupBy("dt", "product_id").agg(F.count(F.lit(1)).alias("n"))
    )
    flagged = per_product.join(keys.withColumn("_known", F.lit(True)), "product_id", "left")
    return (
        flagged.groupBy("dt")
        .agg(
            F.sum("n").cast("long").alias("events_with_product"),
            F.sum(F.when(F.col("_known").isNull(), F.col("n")).otherwise(0)).cast("long").alias(
                "unknown_product_events"
            ),
        )
        .withColumn("unknown_ratio", F.col("unknown_product_events").cast("double") / F.col("events_with_product"))
    )


def unknown_product_rows(silver: DataFrame, products: DataFrame) -> DataFrame:
    """C3 rows: the events themselves (anti-join on the catalog keys)."""
    keys = products.select("product_id").where(F.col("product_id").isNotNull())
    return silver.where(F.col("product_id").isNotNull()).join(keys, "product_id", "left_anti")


#: Silver columns that the profile looks at.
PROFILED = ["event_type", "event_time", "ingest_time", "user_id", "session_id", "product_id", "quantity"]


def _silver_measures() -> list[Column]:
    """What is counted over a day's Silver rows."""
    et, it = F.col("event_time"), F.col("ingest_time")
    both = et.isNotNull() & it.isNotNull()
    delay = F.unix_millis(it) - F.unix_millis(et)
    needs_product = F.col("event_type").isin("view", "add_to_cart", "purchase")
    return [
        F.count(F.lit(1)).alias("rows"),
        count_when(both).alias("timed_rows"),
        count_when(both & (delay >= LATE_AFTER_MS)).alias("late_rows"),
        F.max(F.when(both, delay)).alias("max_delay_ms"),
        count_when(F.col("user_id").isNull()).alias("null_user_id"),
        count_when(F.col("session_id").isNull()).alias("null_session_id"),
        count_when(needs_product).alias("product_events"),
        count_when(needs_product & F.col("product_id").isNull()).alias("null_product_id"),
        count_when(F.col("quantity") < 0).alias("negative_quantity"),
    ]


def silver_profile(silver: DataFrame) -> DataFrame:
    """O1, O3, O5 per day from Silver."""
    return silver.groupBy("dt").agg(*_silver_measures())


def _rates(days: DataFrame) -> DataFrame:
    """O1-O5 out of a day's measures and raw counters."""

    def ratio(num: str, den: str):
        return F.when(F.col(den) > 0, F.col(num).cast("double") / F.col(den))

    return days.select(
        "dt",
        "rows",
        ratio("late_rows", "timed_rows").alias("late_rate"),
        "max_delay_ms",
        ratio("dedup_skipped", "valid_rows").alias("duplicate_rate"),
        ratio("null_user_id", "rows").alias("null_user_rate"),
        ratio("null_session_id", "rows").alias("null_session_rate"),
        ratio("null_product_id", "product_events").alias("null_product_rate"),
        ratio("price_as_text", "valid_rows").alias("price_type_drift_rate"),
        "negative_quantity",
    )


def anomaly_profile(silver: DataFrame, stats: DataFrame) -> DataFrame:
    """O1-O5 per day: Silver measures joined with the raw ingest counters."""
    return _rates(silver_profile(silver).join(stats.select("dt", "valid_rows", "dedup_skipped", "price_as_text"), "dt", "left"))


def raw_anomaly_profile(parsed: DataFrame) -> DataFrame:
    """O1-O5 per day from the raw lines, read and parsed once.

    The first-seen copy of each id carries the number of its copies and of those whose
    price is text, so the Silver measures and the raw counters come from the same rows.
    """
    days = first_copies(parsed, PROFILED).groupBy("dt").agg(
        *_silver_measures(),
        F.sum("copies").alias("valid_rows"),
        F.sum(F.col("copies") - 1).alias("dedup_skipped"),
        F.sum("price_texts").alias("price_as_text"),
    )
    return _rates(days)


def schema_version_mix(silver: DataFrame) -> DataFrame:
    """Events per (dt, schema_version), share of the day, rows carrying `os_version`."""
    per = silver.groupBy("dt", "schema_version").agg(
        F.count(F.lit(1)).alias("events"),
        count_when(F.col("device_os_version").isNotNull()).alias("with_os_version"),
    )
    day = Window.partitionBy("dt")
    return per.withColumn("share", F.col("events").cast("double") / F.sum("events").over(day))


def event_type_mix(silver: DataFrame) -> DataFrame:
    """Events per (dt, event_type) and share of the day."""
    per = silver.groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("events"))
    day = Window.partitionBy("dt")
    return per.withColumn("share", F.col("events").cast("double") / F.sum("events").over(day))
