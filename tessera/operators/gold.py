"""Gold daily metrics.

One `groupBy("dt")` aggregate over Silver computes every base metric in a single
scan (partial aggregation map-side, one row per day shuffled).  The three Gold
tables are projections of that one small result, so no second scan is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import count_when, null_guarded_ratio, sum_when
from tessera.session import checkpoint_dir
from tessera.schemas import GOLD_CONVERSION_COLUMNS, GOLD_EVENT_COLUMNS, GOLD_REVENUE_COLUMNS


class EmptyPartitionError(RuntimeError):
    """A requested `dt` has no Silver rows; nothing may be written."""


def _type_is(name: str):
    return F.col("event_type") == name


def _event_count_aggs() -> list:
    return [
        F.count(F.lit(1)).alias("total_events"),
        count_when(_type_is("view")).alias("view_events"),
        count_when(_type_is("search")).alias("search_events"),
        count_when(_type_is("add_to_cart")).alias("add_to_cart_events"),
        count_when(_type_is("purchase")).alias("purchase_events"),
        count_when(_type_is("refund")).alias("refund_events"),
    ]


def _revenue_aggs() -> list:
    return [
        sum_when(_type_is("purchase"), F.col("total_amount")).cast("long").alias("gross_revenue"),
        sum_when(_type_is("refund"), F.col("refund_amount")).cast("long").alias("refund_amount"),
    ]


def base_metrics(silver: DataFrame) -> DataFrame:
    """All base metrics per `dt` in one aggregate (any number of days)."""
    return silver.groupBy("dt").agg(*_event_count_aggs(), *_revenue_aggs())


def event_metrics(base: DataFrame) -> DataFrame:
    """D2 `daily_event_metrics`."""
    return base.select(*GOLD_EVENT_COLUMNS)


def revenue_metrics(base: DataFrame) -> DataFrame:
    """D3 `daily_revenue_metrics` (net = gross - refund)."""
    return base.withColumn("net_revenue", F.col("gross_revenue") - F.col("refund_amount")).select(
        *GOLD_REVENUE_COLUMNS
    )


def conversion_metrics(base: DataFrame) -> DataFrame:
    """D4 `daily_conversion_metrics`: event-count rates, NULL when the denominator is 0."""
    v, c, p = F.col("view_events"), F.col("add_to_cart_events"), F.col("purchase_events")
    return (
        base.withColumn("view_to_cart_rate", null_guarded_ratio(c, v))
        .withColumn("cart_to_purchase_rate", null_guarded_ratio(p, c))
        .withColumn("view_to_purchase_rate", null_guarded_ratio(p, v))
        .select(*GOLD_CONVERSION_COLUMNS)
    )


def single_pass(silver: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three Gold tables from one aggregate."""
    base = base_metrics(silver)
    return event_metrics(base), revenue_metrics(base), conversion_metrics(base)


def multi_pass(silver: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The comparison strategy — three independent aggregates over Silver."""
    ev = silver.groupBy("dt").agg(*_event_count_aggs())
    rev = silver.groupBy("dt").agg(*_revenue_aggs())
    conv_base = silver.groupBy("dt").agg(
        count_when(_type_is("view")).alias("view_events"),
        count_when(_type_is("add_to_cart")).alias("add_to_cart_events"),
        count_when(_type_is("purchase")).alias("purchase_events"),
    )
    return event_metrics(ev), revenue_metrics(rev), conversion_metrics(conv_base)


def mode_parity(silver: DataFrame) -> DataFrame:
    """D5 parity: rows per Gold table and the rows that differ between the
    single-pass and multi-pass strategies (`exceptAll` both ways).

    The single-pass per-day result is checkpointed first (eager, tiny), so the
    check costs one Silver scan for single-pass plus the three that define
    multi-pass, instead of a scan per compared table."""
    names = ["daily_event_metrics", "daily_revenue_metrics", "daily_conversion_metrics"]
    checkpoint_dir(silver.sparkSession)
    base = base_metrics(silver).checkpoint(eager=True)
    single = (event_metrics(base), revenue_metrics(base), conversion_metrics(base))
    parts = []
    for name, a, b in zip(names, single, multi_pass(silver)):
        diff = a.exceptAll(b).unionByName(b.exceptAll(a))
        tagged = a.select(F.lit(1).alias("_row"), F.lit(0).alias("_diff")).unionByName(
            diff.select(F.lit(0).alias("_row"), F.lit(1).alias("_diff"))
        )
        parts.append(
            tagged.agg(
                F.lit(name).alias("metric_table"),
                F.coalesce(F.sum("_row"), F.lit(0)).cast("long").alias("rows"),
                F.coalesce(F.sum("_diff"), F.lit(0)).cast("long").alias("diff_rows"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
