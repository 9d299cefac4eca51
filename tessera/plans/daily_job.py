"""Daily medallion job (L1, L2): raw → Silver table → quality gate → Gold → report.

A plain function over DataFrames.  Days are gated individually: Gold is built
only for the days whose quality gate passes (the reference stops the whole run
on a failed gate; with one day per run that is the same thing).  Rerunning
the same days replaces exactly those partitions (idempotent backfill).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators import consume, quality
from tessera.operators.silver import raw_to_silver
from tessera.plans.gold_build import GoldRun, build_gold
from tessera.session import ensure_conf
from tessera.sources.raw import landed_days
from tessera.sources.tables import clear_partitions, ensure_namespace, write_partitions


@dataclass
class DailyRunResult:
    silver_table: str
    gold_namespace: str
    passed_dates: list[str]
    failed_dates: list[str]
    gate: DataFrame  # per day of the run: row count and verdict, checkpointed
    gold_run: GoldRun | None = None
    notes: list[str] = field(default_factory=list)


def run_daily(
    spark: SparkSession,
    raw_root: str,
    namespace: str,
    dates: list[str] | None = None,
    glob: str = "*.jsonl",
    report_path: str | None = None,
    rows_per_file: int | None = None,
) -> DailyRunResult:
    """Run the job for `dates` (every landed day when None).

    A day whose raw files hold no valid row any more is emptied in the Silver
    table, so that its gate fails instead of passing on the rows of an earlier run.
    """
    ensure_conf(spark)
    ensure_namespace(spark, namespace)
    silver_table = f"{namespace}.silver_events"
    days = list(dict.fromkeys(dates)) if dates is not None else landed_days(spark, raw_root, None, glob)
    # raw → Silver table (one job: scan, parse, dedup, partition overwrite); the
    # days that it writes are observed on the way.
    seen = Observation("days_written")
    write_partitions(raw_to_silver(spark, raw_root, dates, glob), silver_table, rows_per_file=rows_per_file, seen=seen)
    written = set(seen.get.get("days") or [])
    clear_partitions(spark, silver_table, [d for d in days if d not in written])
    # quality gate per day: one aggregate over the days of this run, kept for
    # the report, the verdicts and the summary (one row per day)
    metrics = quality.quality_metrics(spark.table(silver_table), days).checkpoint()
    if report_path:
        quality.write_quality_report(quality.quality_report(metrics, silver_table), report_path)
    gate = quality.quality_gate(metrics)
    verdicts = gate.select("dt", "all_passed").collect()
    passed = sorted(r["dt"] for r in verdicts if r["all_passed"])
    failed = sorted(r["dt"] for r in verdicts if not r["all_passed"])
    result = DailyRunResult(silver_table, namespace, passed, failed, gate)
    if passed:
        result.gold_run = build_gold(spark, spark.table(silver_table), namespace, passed)
    return result


def daily_summary(spark: SparkSession, result: DailyRunResult) -> DataFrame:
    """Per day of the run: Silver rows, gate verdict and the Gold overview of a day that passed.

    A failed day shows no Gold, even where an earlier run left some.
    """
    gate = result.gate.select("dt", "row_count", "all_passed")
    if result.gold_run is None:
        none = F.lit(None).cast("long")
        return gate.select("*", none.alias("total_events"), none.alias("net_revenue"))
    ev = spark.table(f"{result.gold_namespace}.daily_event_metrics")
    rev = spark.table(f"{result.gold_namespace}.daily_revenue_metrics")
    overview = consume.daily_business_overview(ev, rev).select(F.col("dt").alias("_day"), "total_events", "net_revenue")
    shown = F.col("all_passed") & (F.col("dt") == F.col("_day"))
    return gate.join(overview, shown, "left").drop("_day")
