"""Incremental daily marts (D10-D12): a rerun of some days touches these days only.

`mart_state` holds, by Silver partition `dt`, one row per event day, user and
session.  A build replaces the state of the requested partitions, and then
the mart rows of the event days that these partitions hold now or held before.
An event day may draw on several partitions (late events), so its mart row is
computed from the whole state of that day; partitions outside of it are skipped
by the state's own statistics, as its rows are sorted by event day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.marts import MARTS, mart_state, stg_silver_events
from tessera.session import ensure_conf
from tessera.sources.tables import clear_partitions, ensure_namespace, write_partitions

STATE = "mart_state"


def _event_days(state: DataFrame, dates: list[str]) -> set[_dt.date | None]:
    """The event days in the state of some partitions; one value a day reaches the driver."""
    return {r["event_date"] for r in state.where(F.col("dt").isin(dates)).select("event_date").distinct().collect()}


def _among(column: str, days: set[_dt.date | None]) -> Column:
    """`column` is one of `days`, NULL being a day of its own."""
    named = F.coalesce(F.col(column).isin([d for d in days if d is not None]), F.lit(False))
    return named | F.col(column).isNull() if None in days else named


def build_marts(spark: SparkSession, silver: DataFrame, namespace: str, dates: list[str]) -> list[_dt.date | None]:
    """Bring the marts up to date with the Silver partitions `dates`; the event days that were rewritten, NULL last."""
    ensure_conf(spark)
    ensure_namespace(spark, namespace)
    table = f"{namespace}.{STATE}"
    days = _event_days(spark.table(table), dates) if spark.catalog.tableExists(table) else set()
    wanted = stg_silver_events(silver.where(F.col("dt").isin(list(dates))))
    seen = Observation("state_days")
    write_partitions(mart_state(wanted, ["dt"]), table, seen=seen, sort_by=["event_date"])
    written = set(seen.get.get("days") or [])
    clear_partitions(spark, table, [d for d in dates if d not in written])
    state = spark.table(table)
    days |= _event_days(state, dates)
    if not days:
        return []
    affected = state.where(_among("event_date", days))
    for name, mart in MARTS.items():
        done = Observation(name)
        write_partitions(mart(affected), f"{namespace}.{name}", partition_col="event_date", seen=done)
        left = set(done.get.get("days") or [])
        # A day whose last event went: Spark collects no NULL, so that day is looked up.
        gone = [d for d in days if d is not None and d not in left]
        if None in days and affected.where("event_date IS NULL").isEmpty():
            gone.append(None)
        clear_partitions(spark, f"{namespace}.{name}", gone, "event_date")
    return sorted(days, key=lambda d: (d is None, d or _dt.date.min))
