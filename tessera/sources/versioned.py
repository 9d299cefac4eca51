"""Versioned partitioned table: append-only data plus a snapshot log.

Every commit appends the rows of the partitions it (re)writes under
`data/snapshot_id=N/attempt=A/dt=D/`, then appends one log row per partition
`(snapshot_id, parent_id, committed_at, operation, dt, added_records, attempt,
columns)`, where `columns` is the commit's schema.
The log row is the commit point, so readers never see half-written data.
Commits assume one writer per table at a time (as the daily jobs run): the
next snapshot id is read from the log before writing.
A commit builds on the latest snapshot, or on an older one (a rollback): then
those in between stay in the log but are no ancestors of the table's content.
Its log row names its own chain as ranges of ids (`line`), one more a rollback, so
a read finds its ancestors by a filter on the log instead of a walk through it.
Reading "as of N" takes, per `dt`, the latest ancestor of N that wrote it, and
reads the directories of those commits only, filtered on `(attempt, dt)` — both
partition columns, so the scan is pruned to the chosen partitions.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tessera.session import path_missing

LOG_SCHEMA = (
    "snapshot_id long, parent_id long, committed_at timestamp, operation string, dt string, added_records long, "
    "replaced_records long, parent_records long, line array<struct<first: long, last: long>>, attempt string, columns string"
)


class NoSnapshots(RuntimeError):
    """J4 code 2: the table has no snapshot."""


class SingleSnapshot(RuntimeError):
    """J4 code 3: only one snapshot exists; nothing to compare with."""


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/log"


def _data_path(root: str) -> str:
    return f"{root.rstrip('/')}/data"


def _attempt_path(root: str, snapshot_id: int, attempt: str) -> str:
    return f"{_data_path(root)}/snapshot_id={snapshot_id}/attempt={attempt}"


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The log; empty while nothing was committed.  Any other read error is raised."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(_log_path(root))
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def _line(log: DataFrame, snapshot_id: int | None) -> list[tuple[int, int]]:
    """Ranges of ids of a snapshot (the latest when None) and of all that it builds on."""
    upto = log if snapshot_id is None else log.where(F.col("snapshot_id") <= F.lit(int(snapshot_id)))
    return [tuple(r) for r in upto.agg(F.max_by("line", "snapshot_id")).first()[0] or []]


def _on(line: list[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, [F.col("snapshot_id").between(a, b) for a, b in line], F.lit(False))


def _latest(log: DataFrame) -> int | None:
    return log.agg(F.max("snapshot_id")).first()[0]


def commit(
    df: DataFrame,
    root: str,
    operation: str,
    committed_at: _dt.datetime | None = None,
    dates: list[str] | None = None,
    onto: int | None = None,
) -> int:
    """Write the partitions present in `df` (plus requested `dates`, which may
    be emptied) as a new snapshot on top of the latest, or of `onto` (a rollback to it); returns its id."""
    spark = df.sparkSession
    log = read_log(spark, root)
    latest = _latest(log)
    sid = 1 if latest is None else int(latest) + 1
    parent = latest if onto is None else int(onto)
    line = [] if parent is None else _line(log, parent)
    line = [*line[:-1], (line[-1][0], sid)] if line and parent == latest else [*line, (sid, sid)]
    when = committed_at or _dt.datetime.now(_dt.timezone.utc)
    when = when.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    # Each attempt writes under its own directory; only the attempt named by a
    # log row is ever read, so files of a crashed attempt (data written, log row
    # not) are never picked up, even though the next commit reuses the id.
    attempt = uuid.uuid4().hex
    path = _attempt_path(root, sid, attempt)
    df.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(path)
    # The log counts what was written; the input is evaluated once.
    counts = spark.read.schema(df.schema).parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("added_records"))
    if dates:
        req = spark.createDataFrame([(d,) for d in dict.fromkeys(dates)], "dt string")
        counts = req.join(counts, "dt", "full").fillna(0, ["added_records"])
    before = partitions_as_of(log, parent).select(F.col("dt").alias("_dt"), F.col("rows").alias("replaced_records"))
    parent_records = before.agg(F.sum("replaced_records")).first()[0] or 0
    counts = counts.join(before, F.col("dt").eqNullSafe(F.col("_dt")), "left").fillna(0, ["replaced_records"])
    log_rows = counts.select(
        F.lit(sid).cast("long").alias("snapshot_id"),
        F.lit(parent).cast("long").alias("parent_id"),
        F.lit(when).cast("timestamp").alias("committed_at"),
        F.lit(operation).alias("operation"),
        "dt",
        F.col("added_records").cast("long"),
        F.col("replaced_records").cast("long"),
        F.lit(parent_records).cast("long").alias("parent_records"),
        F.array(*[F.struct(F.lit(a).cast("long").alias("first"), F.lit(b).cast("long").alias("last")) for a, b in line]).alias("line"),
        F.lit(attempt).alias("attempt"),
        F.lit(df.drop("dt").schema.json()).alias("columns"),
    )
    log_rows.coalesce(1).write.mode("append").parquet(_log_path(root))
    return sid


def _log_as_of(log: DataFrame, snapshot_id: int | None) -> DataFrame:
    """The log rows of a snapshot's own chain."""
    return log.where(_on(_line(log, snapshot_id)))


def partitions_as_of(log: DataFrame, snapshot_id: int | None = None) -> DataFrame:
    """`(dt, snapshot_id, attempt, rows)`: the commit whose rows are current for each day."""
    latest = _log_as_of(log, snapshot_id).groupBy("dt").agg(F.max(F.struct("snapshot_id", "attempt", "added_records")).alias("c"))
    return latest.select("dt", "c.snapshot_id", "c.attempt", F.col("c.added_records").alias("rows"))


def _columns_as_of(log: DataFrame, snapshot_id: int | None) -> T.StructType:
    """Every column that a commit up to the snapshot had, as its latest commit types it (and `dt`)."""
    fields: dict[str, T.StructField] = {}
    for r in _log_as_of(log, snapshot_id).select("snapshot_id", "columns").distinct().orderBy("snapshot_id").collect():
        for f in T.StructType.fromJson(json.loads(r["columns"])):
            fields[f.name] = T.StructField(f.name, f.dataType)
    return T.StructType([*fields.values(), T.StructField("dt", T.StringType())])


def read_as_of(spark: SparkSession, root: str, snapshot_id: int | None = None) -> DataFrame:
    """Table content as of a snapshot (latest when None).

    A column that a later commit added is NULL in the rows of earlier ones; a
    read as of an earlier snapshot does not have it.  Only directories of
    commits that are still current for some day are listed.
    """
    log = read_log(spark, root)
    schema = _columns_as_of(log, snapshot_id)
    chosen = partitions_as_of(log, snapshot_id)
    live: dict[tuple[int, str], list[str | None]] = {}
    for r in chosen.where(F.col("rows") > 0).orderBy("snapshot_id", "dt").collect():  # one row per day
        live.setdefault((r["snapshot_id"], r["attempt"]), []).append(r["dt"])
    if not live:
        return spark.createDataFrame([], schema)
    own = T.StructType([*schema, T.StructField("snapshot_id", T.LongType()), T.StructField("attempt", T.StringType())])
    data = spark.read.schema(own).option("basePath", _data_path(root)).parquet(*[_attempt_path(root, *k) for k in live])
    current = F.lit(False)
    for (_, attempt), days in live.items():
        among = F.col("dt").isin([d for d in days if d is not None])
        if None in days:
            among = among | F.col("dt").isNull()
        current = current | ((F.col("attempt") == attempt) & among)
    return data.where(current).select(*schema.names)


def snapshots(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """One row per snapshot with a summary, latest first (optionally the latest `limit`)."""
    per = read_log(spark, root).groupBy("snapshot_id").agg(
        F.first("parent_id").alias("parent_id"),
        F.first("committed_at").alias("committed_at"),
        F.first("operation").alias("operation"),
        F.sum("added_records").cast("long").alias("added_records"),
        F.sum("replaced_records").cast("long").alias("deleted_records"),
        F.count(F.lit(1)).alias("changed_partitions"),
        (F.first("parent_records") + F.sum("added_records") - F.sum("replaced_records")).cast("long").alias("total_records"),
    )
    return _latest_first(per, "committed_at", limit)


def _latest_first(df: DataFrame, time: str, limit: int | None) -> DataFrame:
    out = df.orderBy(F.col(time).desc(), F.col("snapshot_id").desc())
    return out if limit is None else out.limit(int(limit))


def history(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """`(made_current_at, snapshot_id, parent_id, is_current_ancestor)`, latest first.

    A snapshot that a rollback left out is no ancestor of the table's current content.
    """
    log = read_log(spark, root)
    per = log.groupBy("snapshot_id").agg(F.first("committed_at").alias("made_current_at"), F.first("parent_id").alias("parent_id"))
    told = per.select("made_current_at", "snapshot_id", "parent_id", _on(_line(log, None)).alias("is_current_ancestor"))
    return _latest_first(told, "made_current_at", limit)


def latest_two(spark: SparkSession, root: str) -> tuple[int, int]:
    """ids of the two latest snapshots (codes 2/3 as exceptions)."""
    rows = (
        read_log(spark, root).select("snapshot_id", "committed_at").distinct()
        .orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc()).limit(2).collect()
    )
    if not rows:
        raise NoSnapshots(f"{root} has no snapshot yet")
    if len(rows) < 2:
        raise SingleSnapshot(f"{root} has a single snapshot; nothing to compare with")
    return int(rows[0]["snapshot_id"]), int(rows[1]["snapshot_id"])


def compare_with_previous(spark: SparkSession, root: str, dates: list[str] | None = None, check: bool = False) -> DataFrame:
    """Per `dt`, rows now vs as of the previous snapshot (full outer on `dt`).

    The log holds the rows of every commit by day, so no data is read; `check` counts the data instead.
    """
    latest, prev = latest_two(spark, root)
    log = read_log(spark, root)

    def counts(sid: int, name: str) -> DataFrame:
        if check:
            df = read_as_of(spark, root, sid).groupBy("dt").agg(F.count(F.lit(1)).alias(name))
        else:
            df = partitions_as_of(log, sid).where("rows > 0").select("dt", F.col("rows").alias(name))
        return df if dates is None else df.where(F.col("dt").isin(list(dates)))

    return (
        counts(latest, "current_count")
        .join(counts(prev, "previous_count"), "dt", "full")
        .fillna(0, ["current_count", "previous_count"])
        .withColumn("previous_snapshot_id", F.lit(prev).cast("long"))
    )
