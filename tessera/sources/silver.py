"""Silver Parquet files (A3, A4).

A3 is rerun-safe: the requested days are replaced in one job (dynamic
partition overwrite), and a requested day that now has no rows is emptied
explicitly, so stale rows never survive a rerun.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.schemas import SILVER_COLUMNS, SILVER_ROWS_PER_FILE, SILVER_SCHEMA, SILVER_TABLE_COLUMNS, SILVER_TABLE_SCHEMA
from tessera.session import ensure_conf, path_missing


def write_silver_files(
    silver: DataFrame, root: str, dates: list[str] | None = None, rows_per_file: int = SILVER_ROWS_PER_FILE
) -> dict:
    """A3: `root/dt=D/part-*.parquet` (snappy, ≤ `rows_per_file` rows per file).

    Returns `{"days": [...], "rows": n}` observed during the write itself."""
    spark = silver.sparkSession
    ensure_conf(spark)
    root = root.rstrip("/")
    out = silver.select(*SILVER_TABLE_COLUMNS)
    if dates is not None:
        out = out.where(F.col("dt").isin(list(dates)))
    # The days this job writes, observed during the write itself (no extra pass).
    seen = Observation("silver_days_written")
    # Observed above the shuffle: an empty shuffle's own plan is dropped, and its metrics with it.
    out = out.hint("rebalance", "dt").observe(seen, F.collect_set("dt").alias("days"), F.count(F.lit(1)).alias("rows"))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", int(rows_per_file))
        .option("compression", "snappy")
        .partitionBy("dt")
        .parquet(root)
    )
    if dates:
        written = set(seen.get.get("days") or [])
        for day in [d for d in dict.fromkeys(dates) if d not in written]:
            # The reference deletes a day's stale parts before writing; a day
            # with no rows now must therefore end up empty.
            spark.createDataFrame([], SILVER_SCHEMA).write.mode("overwrite").parquet(f"{root}/dt={day}")
    got = seen.get
    return {"days": sorted(got.get("days") or []), "rows": int(got.get("rows") or 0)}


def read_silver_files(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """A4: Silver files with the fixed schema and the STRING `dt` from the path."""
    ensure_conf(spark)
    df = spark.read.schema(SILVER_TABLE_SCHEMA).parquet(root.rstrip("/"))
    if dates is not None:
        df = df.where(F.col("dt").isin(list(dates)))
    return df.select(*SILVER_COLUMNS, "dt")


def day_parts(spark: SparkSession, root: str, dates: list[str]) -> dict[str, int]:
    """Parquet files now in `root/dt=D` per requested day (file metadata listed
    on the driver, one listing per requested day)."""
    root = root.rstrip("/")
    parts = {}
    for day in dict.fromkeys(dates):
        try:
            files = [f for f in spark.read.parquet(f"{root}/dt={day}").inputFiles() if f.endswith(".parquet")]
        except AnalysisException as exc:
            if not (path_missing(exc) or exc.getCondition() == "UNABLE_TO_INFER_SCHEMA"):
                raise
            files = []  # no such day, or one without files
        parts[day] = len(files)
    return parts


def silver_write_summary(spark: SparkSession, root: str, stats: DataFrame, dates: list[str]) -> DataFrame:
    """A2 run summary per day: `parts` (Parquet files now in `root/dt=D`), `rows`,
    `raw_lines`, `dedup_skipped`, `json_parse_errors` (counters from `stats`)."""
    listed = spark.createDataFrame(list(day_parts(spark, root, dates).items()), "dt string, parts int")
    return listed.join(stats, "dt", "left").select(
        "dt",
        "parts",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("raw_lines", F.lit(0)).alias("raw_lines"),
        F.coalesce("dedup_skipped", F.lit(0)).alias("dedup_skipped"),
        F.coalesce("json_parse_errors", F.lit(0)).alias("json_parse_errors"),
    )
