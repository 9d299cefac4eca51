"""Staging view and daily marts.

Every mart is a sum or an exact distinct count over `mart_state`: one row per
Silver partition, event day, user and session, with its counts and sums.
Rows of an event are never expanded for a distinct count; only state rows are,
which are far fewer.  The state is mergeable: partitions written apart give the marts of
their union, so a rerun of one day rewrites that day's state (see `plans.mart_build`).

Marts group by `event_date` (the UTC day of `event_time`), not by the `dt`
partition; conversion here is distinct-session based and 0.0 on no views —
deliberately a different definition from the Gold event-count rates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import count_when, sum_when, zero_guarded_ratio
from tessera.functions.time import utc_date
from tessera.schemas import SILVER_TABLE_COLUMNS

_RENAMED = {"event_time": "event_ts", "ingest_time": "ingest_ts"}


def stg_silver_events(silver: DataFrame) -> DataFrame:
    """Rename the two times, add `event_date`, pass every other column."""
    cols = []
    for name in SILVER_TABLE_COLUMNS:
        if name == "event_time":
            cols.append(F.col("event_time").alias("event_ts"))
            cols.append(utc_date(F.col("event_time")).alias("event_date"))
        elif name in _RENAMED:
            cols.append(F.col(name).alias(_RENAMED[name]))
        else:
            cols.append(F.col(name))
    return silver.select(*cols)


STATE_KEYS = ["event_date", "user_id", "session_id"]


def mart_state(stg: DataFrame, partition: list[str] | None = None) -> DataFrame:
    """What the marts need of the staged events, per event day, user and session (and `partition`)."""
    is_purchase = F.col("event_type") == "purchase"
    return stg.groupBy(*(partition or []), *STATE_KEYS).agg(
        F.count(F.lit(1)).alias("events"),
        count_when(F.col("event_type") == "view").alias("views"),
        count_when(is_purchase).alias("purchases"),
        F.coalesce(sum_when(is_purchase, F.col("total_amount")), F.lit(0)).cast("long").alias("gross"),
        F.coalesce(sum_when(F.col("event_type") == "refund", F.col("refund_amount")), F.lit(0)).cast("long").alias("refunds"),
    )


def daily_events(state: DataFrame) -> DataFrame:
    """Events, distinct users and distinct sessions per day."""
    return state.groupBy("event_date").agg(
        F.sum("events").alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )


def daily_revenue(state: DataFrame) -> DataFrame:
    """Purchase events, paying users and coalesced revenue sums per day."""
    return state.groupBy("event_date").agg(
        F.sum("purchases").alias("order_events"),
        F.count_distinct(F.when(F.col("purchases") > 0, F.col("user_id"))).alias("paying_users"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("refunds").alias("refund_amount"),
        (F.sum("gross") - F.sum("refunds")).alias("net_revenue"),
    )


def daily_conversion(state: DataFrame) -> DataFrame:
    """Distinct view / purchase sessions and their ratio (0.0 without views)."""
    among = {"view_sessions": "views", "purchase_sessions": "purchases"}
    return (
        state.groupBy("event_date")
        .agg(*[F.count_distinct(F.when(F.col(c) > 0, F.col("session_id"))).alias(n) for n, c in among.items()])
        .withColumn("conversion_rate", zero_guarded_ratio(F.col("purchase_sessions"), F.col("view_sessions")))
    )


def fct_daily_events(stg: DataFrame) -> DataFrame:
    return daily_events(mart_state(stg))


def fct_daily_revenue(stg: DataFrame) -> DataFrame:
    return daily_revenue(mart_state(stg))


def fct_daily_conversion(stg: DataFrame) -> DataFrame:
    return daily_conversion(mart_state(stg))


#: Mart tables by name.
MARTS = {"fct_daily_events": daily_events, "fct_daily_revenue": daily_revenue, "fct_daily_conversion": daily_conversion}
