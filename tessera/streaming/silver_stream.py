"""Incremental raw → Silver with Structured Streaming (M1), deduplicated exactly and without a horizon.

`readStream.text` over the landing zone → `foreachBatch`: the same Silver
projection and first-seen rule as the batch path, an anti-join against the
sink's rows of the micro-batch's own days, an append partitioned by `dt`.
With `availableNow` the query drains what has landed and stops.

- **Exact.**  The sink itself is the memory: a copy that comes days or months
  after the first is recognised, and nothing is kept in a state store.  Only the
  `(dt, event_id)` columns of the days at hand are read, and the micro-batch is
  already partitioned by these keys, so the join moves the sink's keys alone.
- **Survivor.**  Copies inside a micro-batch are ordered by file path below `dt=…/`,
  split and line, as in the batch path; an earlier micro-batch comes before a
  later one.  So the sink equals the batch path's result wherever files arrive
  in the order of their names.
- **Idempotent.**  A micro-batch that is done again (after a crash before its
  commit was logged) picks the same rows, and those its earlier attempt wrote are
  found in the sink; it appends what is missing and nothing else.  No id is ever
  twice in the sink, whole or partial as the earlier attempt may be.

One query at a time may write to a sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from tessera.operators.dedup import first_seen
from tessera.operators.silver import extract_silver, finish_silver
from tessera.session import ensure_conf, path_missing
from tessera.sources.raw import parse_raw_lines, positioned_lines

KEY = ["dt", "event_id"]


def raw_line_stream(spark: SparkSession, raw_root: str, glob: str = "*.jsonl", max_files: int | None = None) -> DataFrame:
    """The landing zone's lines as a stream, with the place they come from."""
    reader = spark.readStream.format("text").schema("value string, dt string").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    lines = reader.load(raw_root.rstrip("/"))
    return lines.select("dt", "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))


def seen_keys(spark: SparkSession, sink_root: str, days: list[str]) -> DataFrame | None:
    """The (dt, event_id) that the sink holds of `days`; None when it holds none of these days."""
    try:
        reader = spark.read.schema("event_id string, dt string").option("basePath", sink_root)
        # A pattern, so that days the sink doesn't have are no error.
        return reader.parquet(f"{sink_root}/dt={{{','.join(days)}}}").select(*KEY)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return None


def append_unseen(lines: DataFrame, sink_root: str) -> None:
    """One micro-batch of raw lines: its first-seen rows whose key the sink doesn't hold are appended to the sink."""
    spark = lines.sparkSession
    # One value a day; the lines are read for it, not parsed.
    days = sorted(r["dt"] for r in lines.select("dt").distinct().collect() if r["dt"] is not None)
    if not days:
        return
    rows = first_seen(extract_silver(parse_raw_lines(positioned_lines(lines))), KEY, ["_file", "_block", "_pos"])
    seen = seen_keys(spark, sink_root, days)
    fresh = rows if seen is None else rows.join(seen, KEY, "left_anti")
    finish_silver(fresh).hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(sink_root)


def start_silver_stream(
    spark: SparkSession,
    raw_root: str,
    sink_root: str,
    checkpoint: str,
    glob: str = "*.jsonl",
    available_now: bool = True,
    max_files: int | None = None,
    interval: str = "1 minute",
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the stream into Parquet files partitioned by `dt`.

    `after` is called with the batch id when a micro-batch's rows are written, before its commit is logged.
    """
    ensure_conf(spark)
    sink_root = sink_root.rstrip("/")

    def run(lines: DataFrame, batch_id: int) -> None:
        append_unseen(lines, sink_root)
        if after is not None:
            after(batch_id)

    writer = raw_line_stream(spark, raw_root, glob, max_files).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
