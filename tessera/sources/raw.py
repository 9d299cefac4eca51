"""Raw JSON-lines landing zone.

Layout: `<root>/dt=YYYY-MM-DD/<files>.jsonl` (deeper `key=value/` levels are
allowed).  Each line keeps its physical position — `(file path, split start,
position within the split)` — which defines "first seen" for deduplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.functions.json_values import both_values, parse_json_line, whole_value
from tessera.session import path_missing


class RawPartitionMissing(FileNotFoundError):
    """A1: no raw file for a requested partition (the reference's exit code 3)."""


def landed_files(spark: SparkSession, root: str, dates: list[str] | None = None, glob: str = "*.jsonl") -> DataFrame:
    """`(dt, files)`: raw files of the requested days (all when None).

    The files are listed by tasks, and none is read.
    """
    root = root.rstrip("/")
    paths = [root] if dates is None else [f"{root}/dt={d}" for d in dict.fromkeys(dates)]
    reader = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", glob)
    try:
        files = reader.load(paths)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        raise RawPartitionMissing(f"no raw partition under {paths}: {exc}") from exc
    day = F.col("dt").cast("string") if "dt" in files.columns else F.lit(None).cast("string")
    return files.select(day.alias("dt")).where("dt IS NOT NULL").groupBy("dt").agg(F.count(F.lit(1)).alias("files"))


def landed_days(spark: SparkSession, root: str, dates: list[str] | None = None, glob: str = "*.jsonl") -> list[str]:
    """The requested days (all when None) that hold a raw file, in order; one row per day reaches the driver."""
    return sorted(r["dt"] for r in landed_files(spark, root, dates, glob).select("dt").collect())


def read_raw_lines(
    spark: SparkSession, root: str, dates: list[str] | None = None, glob: str = "*.jsonl"
) -> DataFrame:
    """A1: lines of the requested `dt` partitions (all partitions when `dates` is None).

    Columns: `dt`, `line`, `_file` (path below the day directory), `_block`,
    `_pos`, `_v` (the line parsed as VARIANT, NULL when not JSON).  Only files
    matching `glob` are read; partition values stay strings.  Every requested
    day must hold such a file.
    """
    root = root.rstrip("/")
    paths = [root] if dates is None else [f"{root}/dt={d}" for d in dict.fromkeys(dates)]
    reader = spark.read.option("basePath", root).option("pathGlobFilter", glob)
    try:
        df = reader.text(paths)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        raise RawPartitionMissing(f"no raw partition under {paths}: {exc}") from exc
    if dates is not None:
        missing = sorted(set(dates) - set(landed_days(spark, root, dates, glob)))
        if missing:
            raise RawPartitionMissing(f"no raw files matching {glob!r} for dt={','.join(missing)} under {root}")
    return positioned_lines(
        df.select(F.col("dt").cast("string").alias("dt"), "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    )


def positioned_lines(lines: DataFrame) -> DataFrame:
    """Scanned lines (`dt`, `value`, `_path`, `_block`) with their physical position and parsed value, as `read_raw_lines` gives them."""
    path = F.col("_path")
    # The path comes URI-encoded; names sort by their own characters.
    path = F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    placed = lines.select(
        "dt",
        F.col("value").alias("line"),
        # Order among a day's files = order of their paths below `dt=D/` (same
        # prefix), which is a much shorter sort key to carry through the shuffle.
        F.regexp_extract(path, r"/dt=[^/]*/(.*)$", 1).alias("_file"),
        "_block",
        # Increasing within a split, in line order; with (_file, _block) it is
        # a total order of the physical input.  Computed at the scan.
        F.monotonically_increasing_id().alias("_pos"),
        # Parsed here, next to the nondeterministic `_pos`: the optimizer cannot
        # push later row filters below this projection, so each line is parsed
        # exactly once instead of once per filter term.
        both_values(F.col("value")).alias("_both"),
    )
    return placed.select("dt", "line", "_file", "_block", "_pos", whole_value(F.col("line"), F.col("_both")).alias("_v"))


def parse_raw_lines(lines: DataFrame) -> DataFrame:
    """A2: classify each parsed line.

    `_blank`  — empty line (skipped, not counted);
    `_bad`    — non-blank line that is not one valid JSON value (`json_parse_errors`);
    `_object` — a JSON object (counted in `raw_lines`); other JSON values are
                skipped silently.
    """
    v = F.col("_v") if "_v" in lines.columns else parse_json_line(F.col("line"))
    return lines.select(
        *[c for c in lines.columns if c != "_v"],
        v.alias("_v"),
        (F.col("line") == "").alias("_blank"),
        ((F.col("line") != "") & v.isNull()).alias("_bad"),
        # After a successful parse, a leading `{` means the value is an object.
        (v.isNotNull() & F.col("line").rlike(r"^[ \t\r\n]*\{")).alias("_object"),
    )


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """One JSON object per line (non-ASCII kept)."""
    cols = [c for c in df.columns if c not in (partition_by or [])]
    out = df.select(*(partition_by or []), F.to_json(F.struct(*cols)).alias("value"))
    # All of `path` is replaced, whatever overwrite mode the session has.
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)


def landed_line_counts(spark: SparkSession, source: str, landed: str) -> DataFrame:
    """Line counts of a source and its landed copy, and whether they match."""
    a = spark.read.text(source).agg(F.count(F.lit(1)).alias("source_lines"))
    b = spark.read.text(landed).agg(F.count(F.lit(1)).alias("landed_lines"))
    both = a.select("source_lines", F.lit(None).cast("long").alias("landed_lines")).unionByName(
        b.select(F.lit(None).cast("long").alias("source_lines"), "landed_lines")
    )
    return both.agg(
        F.max("source_lines").alias("source_lines"), F.max("landed_lines").alias("landed_lines")
    ).withColumn("matches", F.col("source_lines") == F.col("landed_lines"))
