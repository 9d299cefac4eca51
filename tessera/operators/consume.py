"""Parametrised consumption queries (K1-K5) and their sorts/limits."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def validate_date(value: str | _dt.date) -> str:
    """Accept `YYYY-MM-DD` (or a date) and return the canonical string."""
    if isinstance(value, _dt.date):
        return value.isoformat()
    if not isinstance(value, str) or not _DATE.match(value):
        raise ValueError(f"expected a YYYY-MM-DD date, got {value!r}")
    return _dt.date.fromisoformat(value).isoformat()


def _for_date(df: DataFrame, dt: str | None, col: str = "dt") -> DataFrame:
    return df if dt is None else df.where(F.col(col) == F.lit(validate_date(dt)))


def available_dates(event_metrics: DataFrame) -> DataFrame:
    """The reported days, newest first, NULLs dropped."""
    return event_metrics.select(F.col("dt").cast("string").alias("dt")).where(F.col("dt").isNotNull()).orderBy(
        F.col("dt").desc()
    )


def daily_business_overview(event_metrics: DataFrame, revenue_metrics: DataFrame, dt: str | None = None) -> DataFrame:
    """Daily events ⋈ revenue on `dt`, ordered by day."""
    e = _for_date(event_metrics, dt).select("dt", "total_events", "purchase_events", "refund_events")
    r = _for_date(revenue_metrics, dt).select("dt", "gross_revenue", "refund_amount", "net_revenue")
    return e.join(r, "dt", "inner").orderBy("dt")


def metrics_overview(event_metrics: DataFrame, revenue_metrics: DataFrame, date: str) -> DataFrame:
    """The endpoint projection for one day."""
    day = validate_date(date)
    e = _for_date(event_metrics, day).select("dt", "total_events", "purchase_events")
    r = _for_date(revenue_metrics, day).select("dt", "net_revenue")
    return e.join(r, "dt", "inner").select("dt", "total_events", "purchase_events", "net_revenue")


def conversion_funnel(conversion_metrics: DataFrame, dt: str | None = None) -> DataFrame:
    """K3: the Gold conversion table, ordered by day."""
    return _for_date(conversion_metrics, dt).select(
        "dt",
        "view_events",
        "add_to_cart_events",
        "purchase_events",
        "view_to_cart_rate",
        "cart_to_purchase_rate",
        "view_to_purchase_rate",
    ).orderBy("dt")


def top_products(silver: DataFrame, dt: str | None = None, n: int = 10) -> DataFrame:
    """Best-selling products by purchase revenue.

    Ties on revenue are broken by `product_id` so the top-n is deterministic.
    Planned as partial aggregation + a bounded top-n (`TakeOrderedAndProject`).
    """
    pid = F.col("product_id")
    purchases = _for_date(silver, dt).where(
        (F.col("event_type") == "purchase") & pid.isNotNull() & (F.trim(pid) != "")
    )
    return (
        purchases.groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("purchase_count"), F.sum("total_amount").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("product_id").asc())
        .limit(int(n))
    )
