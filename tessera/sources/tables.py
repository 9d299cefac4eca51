"""Partitioned catalog tables.

Tables are partitioned by the STRING `dt`.  Writing creates the table when it
is missing, otherwise aligns the input to the table schema and overwrites only
the partitions present in the input (dynamic partition overwrite), so a rerun
of the same day replaces that day and leaves the others untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_conf


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """`CREATE NAMESPACE IF NOT EXISTS` (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{loc}")


def with_partition(df: DataFrame, dt: str, column: str = "dt") -> DataFrame:
    """Add the literal partition column."""
    return df.withColumn(column, F.lit(dt).cast("string"))


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Add missing target columns as typed NULL, convert present ones with
    `try_cast` (NULL when a value does not fit), order as the target, drop extras."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def iceberg_available(spark: SparkSession, catalog: str) -> bool:
    """Capability check for an Iceberg catalog (not present in this image)."""
    impl = spark.conf.get(f"spark.sql.catalog.{catalog}", None) or ""
    return "iceberg" in impl.lower()


def write_partitions(
    df: DataFrame, table: str, partition_col: str = "dt", rows_per_file: int | None = None,
    seen: Observation | None = None, sort_by: list[str] | None = None,
) -> bool:
    """Create-if-missing, else align and overwrite the partitions present.

    Rows are gathered by partition before the write (one that is too large is
    split among tasks), so a day does not get a file from every task.
    `rows_per_file` caps file size (A3's bounded chunks); `seen` is filled with
    the partitions written (`days`); `sort_by` sorts each file.  Returns True when the table was created by this call.
    """
    spark = df.sparkSession
    ensure_conf(spark)

    def gathered(rows: DataFrame) -> DataFrame:
        rows = rows.hint("rebalance", partition_col)
        rows = rows.sortWithinPartitions(partition_col, *sort_by) if sort_by else rows
        # Observed above the shuffle: an empty shuffle's own plan is dropped, and its metrics with it.
        return rows if seen is None else rows.observe(seen, F.collect_set(partition_col).alias("days"))

    catalog = table.split(".")[0] if table.count(".") >= 2 else None
    if catalog and iceberg_available(spark, catalog):  # pragma: no cover - needs the Iceberg runtime
        if not spark.catalog.tableExists(table):
            df.writeTo(table).using("iceberg").tableProperty("format-version", "2").partitionedBy(
                F.col(partition_col)
            ).create()
            return True
        align_to_schema(df, spark.table(table).schema).writeTo(table).overwritePartitions()
        return False
    opts = {"maxRecordsPerFile": str(int(rows_per_file))} if rows_per_file else {}
    if not spark.catalog.tableExists(table):
        gathered(df).write.options(**opts).format("parquet").partitionBy(partition_col).saveAsTable(table)
        return True
    target = spark.table(table).schema
    # insertInto is positional: align first so evolved / reordered tables stay writable.
    gathered(align_to_schema(df, target)).write.options(**opts).insertInto(table, overwrite=True)
    return False


def clear_partitions(spark: SparkSession, table: str, days: list, partition_col: str = "dt") -> None:
    """Empty the named partitions (None is the NULL one) in one statement: dynamic overwrite leaves a day alone for which the input has no rows."""
    days = list(dict.fromkeys(days))
    if not days:
        return
    catalog = table.split(".")[0] if table.count(".") >= 2 else None
    values = ["NULL" if d is None else "'" + str(d).replace("\\", "\\\\").replace("'", "\\'") + "'" for d in days]
    if catalog and iceberg_available(spark, catalog):  # pragma: no cover - needs the Iceberg runtime
        among = " OR ".join(f"{partition_col} <=> {v}" for v in values)
        spark.sql(f"DELETE FROM {table} WHERE {among}")
    else:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({partition_col} = {v})" for v in values))


def read_partition(spark: SparkSession, table: str, dt: str) -> DataFrame:
    """A table scan restricted to one partition (pruned at planning time)."""
    return spark.table(table).where(F.col("dt") == F.lit(dt))


def partition_counts(spark: SparkSession, table: str, dates: list[str] | None = None) -> DataFrame:
    """Rows per partition (post-write verification)."""
    df = spark.table(table)
    if dates is not None:
        df = df.where(F.col("dt").isin(list(dates)))
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


def add_column_if_missing(spark: SparkSession, table: str, column: str, sql_type: str = "STRING") -> bool:
    """Add a nullable column once (idempotent); True when it was added."""
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({column} {sql_type})")
    if column not in spark.table(table).columns:
        raise RuntimeError(f"column add did not take effect: {table}.{column}")
    return True


def null_coverage(df: DataFrame, column: str) -> DataFrame:
    """Per `dt`, rows, NULLs in `column` and their share — one aggregate."""
    return (
        df.groupBy("dt")
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            F.sum(F.when(F.col(column).isNull(), 1).otherwise(0)).cast("long").alias("null_count"),
        )
        .withColumn("null_ratio", F.col("null_count").cast("double") / F.col("total_count"))
    )
