"""Registered queries: `(spark, sf_dir) -> DataFrame`, one per operator family.

Each builds its input from the driver tables (FX-* fixtures are Spark
transformations of `events` / `part` / `lineitem`), so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import column_tests as ct
from tessera.operators import consume, gold, marts, quality
from tessera.session import ensure_conf
from tessera.sources.fixtures import fx_silver, fx_silver_bad, load_table

REPORT_DATE = "2024-01-05"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return fx_silver(load_table(spark, sf_dir, "events"))


def _gold(spark: SparkSession, sf_dir: str):
    return gold.single_pass(_silver(spark, sf_dir))


def _silver_day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """FX-SILVER of one day.  `dt` is derived from `ts`, so the day is also
    expressed as a `ts` range that reaches the Parquet scan (row-group skipping)."""
    import datetime as _dt

    ensure_conf(spark)
    start = _dt.datetime.fromisoformat(day)
    end = start + _dt.timedelta(days=1)
    events = load_table(spark, sf_dir, "events")
    events = events.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
    return fx_silver(events).where(F.col("dt") == day)


@register("gold_daily_event_metrics")
def gold_daily_event_metrics(spark, sf_dir):
    return _gold(spark, sf_dir)[0]


@register("gold_daily_revenue_metrics")
def gold_daily_revenue_metrics(spark, sf_dir):
    return _gold(spark, sf_dir)[1]


@register("gold_daily_conversion_metrics")
def gold_daily_conversion_metrics(spark, sf_dir):
    return _gold(spark, sf_dir)[2]


@register("gold_mode_parity")
def gold_mode_parity(spark, sf_dir):
    return gold.mode_parity(_silver(spark, sf_dir))


@register("stg_silver_events")
def stg_silver_events(spark, sf_dir):
    return marts.stg_silver_events(_silver(spark, sf_dir))


@register("fct_daily_events")
def fct_daily_events(spark, sf_dir):
    return marts.fct_daily_events(marts.stg_silver_events(_silver(spark, sf_dir)))


@register("fct_daily_revenue")
def fct_daily_revenue(spark, sf_dir):
    return marts.fct_daily_revenue(marts.stg_silver_events(_silver(spark, sf_dir)))


@register("fct_daily_conversion")
def fct_daily_conversion(spark, sf_dir):
    return marts.fct_daily_conversion(marts.stg_silver_events(_silver(spark, sf_dir)))


@register("marts_incremental")
def marts_incremental(spark, sf_dir):
    """Marts of all days; then one day's Silver is rewritten and another's emptied, and only these are built anew."""
    from tessera.operators.marts import MARTS
    from tessera.plans.mart_build import build_marts
    from tessera.sources.fixtures import event_number

    silver, ns = _silver(spark, sf_dir), _fresh_namespace(spark)
    build_marts(spark, silver, ns, [r["dt"] for r in silver.select("dt").distinct().collect()])
    rerun = silver.where((F.col("dt") == "2024-01-05") & (event_number() % 10 != 0))
    build_marts(spark, rerun, ns, ["2024-01-05", "2024-01-06"])
    events, *others = [spark.table(f"{ns}.{m}") for m in MARTS]
    for other in others:
        events = events.join(other, "event_date", "full")
    return events


def _gold_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run the Gold job (one Silver scan, per-day result checkpointed, three
    table writes) into a fresh namespace; the reports then read the tables,
    as the reference's consumption queries do."""
    from tessera.plans.gold_build import GOLD_TABLES, build_gold

    ns = _fresh_namespace(spark)
    build_gold(spark, _silver(spark, sf_dir), ns, None)
    return tuple(spark.table(f"{ns}.{t}") for t in GOLD_TABLES)


@register("daily_business_overview")
def daily_business_overview(spark, sf_dir):
    ev, rev, _ = _gold_tables(spark, sf_dir)
    return consume.daily_business_overview(ev, rev)


@register("metrics_overview")
def metrics_overview(spark, sf_dir):
    ev, rev, _ = _gold_tables(spark, sf_dir)
    return consume.metrics_overview(ev, rev, REPORT_DATE)


@register("conversion_funnel")
def conversion_funnel(spark, sf_dir):
    return consume.conversion_funnel(_gold_tables(spark, sf_dir)[2])


@register("available_dates")
def available_dates(spark, sf_dir):
    return consume.available_dates(_gold_tables(spark, sf_dir)[0])


@register("top_products")
def top_products(spark, sf_dir):
    return consume.top_products(_silver(spark, sf_dir))


@register("top_products_for_date")
def top_products_for_date(spark, sf_dir):
    return consume.top_products(_silver_day(spark, sf_dir, REPORT_DATE), dt=REPORT_DATE)


def _bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return fx_silver_bad(load_table(spark, sf_dir, "events"))


@register("quality_metrics")
def quality_metrics(spark, sf_dir):
    return quality.quality_metrics(_bad(spark, sf_dir))


@register("quality_rules")
def quality_rules(spark, sf_dir):
    return quality.quality_rules(quality.quality_metrics(_bad(spark, sf_dir)))


@register("quality_gate")
def quality_gate(spark, sf_dir):
    return quality.quality_gate(quality.quality_metrics(_bad(spark, sf_dir)))


@register("mart_row_counts")
def mart_row_counts(spark, sf_dir):
    """Row counts of the staging view and the three marts."""
    stg = marts.stg_silver_events(_silver(spark, sf_dir))
    return ct.row_counts(
        {
            "stg_silver_events": stg,
            "fct_daily_events": marts.fct_daily_events(stg),
            "fct_daily_revenue": marts.fct_daily_revenue(stg),
            "fct_daily_conversion": marts.fct_daily_conversion(stg),
        }
    )


@register("column_tests")
def column_tests(spark, sf_dir):
    bad = _bad(spark, sf_dir)
    stg = marts.stg_silver_events(bad)
    # The marts are one row per day: checkpoint each once (reliable folder)
    # instead of recomputing it from Silver for every test group.
    models = {
        "silver_events": bad,
        "stg_silver_events": stg,
        "fct_daily_events": marts.fct_daily_events(stg).checkpoint(),
        "fct_daily_revenue": marts.fct_daily_revenue(stg).checkpoint(),
        "fct_daily_conversion": marts.fct_daily_conversion(stg).checkpoint(),
    }
    return ct.declared_column_tests(models)


# --- raw → Silver -----------------------------------------------------------


def _landed_raw(spark: SparkSession, sf_dir: str) -> str:
    """Land FX-RAW (derived from `events`) in a fresh folder of the shared checkpoint dir."""
    from tessera.session import scratch_path
    from tessera.sources.fixtures import write_fx_raw

    ensure_conf(spark)
    root = scratch_path(spark, "fx-raw")
    write_fx_raw(load_table(spark, sf_dir, "events"), root)
    return root


RAW_GLOB = "*.txt"  # FX-RAW is written by Spark's text writer


@register("raw_to_silver")
def raw_to_silver(spark, sf_dir):
    from tessera.operators.silver import raw_to_silver as r2s

    return r2s(spark, _landed_raw(spark, sf_dir), glob=RAW_GLOB)


@register("raw_ingest_stats")
def raw_ingest_stats(spark, sf_dir):
    from tessera.operators.silver import ingest_stats

    return ingest_stats(spark, _landed_raw(spark, sf_dir), glob=RAW_GLOB)


@register("dedup_first_seen_lineitem")
def dedup_first_seen_lineitem(spark, sf_dir):
    from tessera.operators.dedup import first_seen, parquet_position

    ensure_conf(spark)
    li = load_table(spark, sf_dir, "lineitem")
    cols = li.columns
    return first_seen(parquet_position(li), ["l_orderkey", "l_linenumber"], ["_file", "_row"]).select(*cols)


# --- anomaly profile and referential integrity -----------------------------


@register("unknown_products")
def unknown_products(spark, sf_dir):
    from tessera.operators.profile import unknown_products as up
    from tessera.session import scratch_path
    from tessera.sources.fixtures import write_fx_products
    from tessera.sources.products import read_products

    ensure_conf(spark)
    landed = write_fx_products(load_table(spark, sf_dir, "part"), scratch_path(spark, "fx-products"))
    return up(_silver(spark, sf_dir), read_products(spark, landed))


@register("raw_anomaly_profile")
def raw_anomaly_profile(spark, sf_dir):
    from tessera.operators.profile import raw_anomaly_profile as profile
    from tessera.sources.raw import parse_raw_lines, read_raw_lines

    return profile(parse_raw_lines(read_raw_lines(spark, _landed_raw(spark, sf_dir), glob=RAW_GLOB)))


@register("schema_version_mix")
def schema_version_mix(spark, sf_dir):
    from tessera.operators.profile import schema_version_mix as svm

    return svm(_silver(spark, sf_dir))


@register("event_type_mix")
def event_type_mix(spark, sf_dir):
    from tessera.operators.profile import event_type_mix as etm

    return etm(_silver(spark, sf_dir))


# --- tables: overwrite, alignment, evolution, versions ---------------------


def _fresh_namespace(spark: SparkSession) -> str:
    import uuid

    from tessera.session import scratch_path
    from tessera.sources.tables import ensure_namespace

    ns = f"tessera_{uuid.uuid4().hex[:10]}"
    ensure_namespace(spark, ns, location=scratch_path(spark, ns))
    return ns


def _silver_table(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    from tessera.sources.tables import write_partitions

    silver = _silver(spark, sf_dir)
    table = f"{_fresh_namespace(spark)}.silver_events"
    write_partitions(silver, table)
    return table, silver


@register("partition_overwrite_rerun")
def partition_overwrite_rerun(spark, sf_dir):
    """A5 + L2: overwrite one day twice (idempotent); the other days stay as written."""
    from tessera.sources.fixtures import event_number
    from tessera.sources.tables import write_partitions

    table, silver = _silver_table(spark, sf_dir)
    rerun = silver.where((F.col("dt") == "2024-01-05") & (event_number() % 10 != 0))
    write_partitions(rerun, table)
    write_partitions(rerun, table)
    return spark.table(table)


@register("schema_align")
def schema_align(spark, sf_dir):
    """B11 + J5 + J6: evolve the table, then rerun a day from a differently shaped input."""
    from tessera.sources.tables import add_column_if_missing, write_partitions

    table, silver = _silver_table(spark, sf_dir)
    add_column_if_missing(spark, table, "ingest_source")
    add_column_if_missing(spark, table, "ingest_source")  # idempotent
    rerun = (
        silver.where(F.col("dt") == "2024-01-06")
        .drop("device_os_version")
        .withColumn("schema_version", F.col("schema_version").cast("string"))
        .withColumn("ingest_source", F.lit("rerun"))
        .withColumn("extra_col", F.lit(1))
    )
    write_partitions(rerun, table)
    return spark.table(table)


@register("schema_evolution_nulls")
def schema_evolution_nulls(spark, sf_dir):
    """After adding a column, existing rows read NULL in it."""
    from tessera.sources.tables import add_column_if_missing, null_coverage

    table, _ = _silver_table(spark, sf_dir)
    add_column_if_missing(spark, table, "ingest_source")
    return null_coverage(spark.table(table), "ingest_source")


@register("null_coverage")
def null_coverage(spark, sf_dir):
    """NULL share of `user_id` per day, one aggregate."""
    from tessera.sources.tables import null_coverage as nc

    return nc(_silver(spark, sf_dir), "user_id")


def _versions(spark: SparkSession, sf_dir: str) -> str:
    from tessera.session import scratch_path
    from tessera.sources.fixtures import fx_versions

    root = scratch_path(spark, "fx-versions")
    fx_versions(_silver(spark, sf_dir), root)
    return root


@register("snapshot_log")
def snapshot_log(spark, sf_dir):
    from tessera.sources.versioned import snapshots

    return snapshots(spark, _versions(spark, sf_dir))


def _branched(spark: SparkSession, sf_dir: str) -> str:
    """FX-VERSIONS, then two commits that leave its last snapshot out: a rollback to snapshot 2 with a part of 2024-01-07, and 2024-01-08 emptied."""
    import datetime as _dt

    from tessera.sources.fixtures import event_number
    from tessera.sources.versioned import commit

    root, silver = _versions(spark, sf_dir), _silver(spark, sf_dir)
    day = silver.where((F.col("dt") == "2024-01-07") & (event_number() % 3 != 0))
    commit(day, root, "overwrite", _dt.datetime(2024, 2, 4, tzinfo=_dt.timezone.utc), ["2024-01-07"], onto=2)
    commit(silver.where("false"), root, "delete", _dt.datetime(2024, 2, 5, tzinfo=_dt.timezone.utc), ["2024-01-08"])
    return root


@register("snapshot_history")
def snapshot_history(spark, sf_dir):
    """The history of a table that was rolled back once, with the rows that each snapshot holds."""
    from tessera.sources.versioned import history, snapshots

    root = _branched(spark, sf_dir)
    return history(spark, root).join(snapshots(spark, root).select("snapshot_id", "deleted_records", "total_records"), "snapshot_id")


@register("time_travel_branch")
def time_travel_branch(spark, sf_dir):
    """The content after the rollback: nothing of the snapshot that it left out."""
    from tessera.sources.versioned import read_as_of

    return read_as_of(spark, _branched(spark, sf_dir))


@register("time_travel_as_of")
def time_travel_as_of(spark, sf_dir):
    from tessera.sources.versioned import read_as_of

    return read_as_of(spark, _versions(spark, sf_dir), 2)


@register("time_travel_compare")
def time_travel_compare(spark, sf_dir):
    from tessera.sources.versioned import compare_with_previous

    return compare_with_previous(spark, _versions(spark, sf_dir))


# --- streaming ----------------------------------------------------------------


@register("silver_stream_available_now")
def silver_stream_available_now(spark, sf_dir):
    """M1: FX-RAW's batches land and are drained one after the other; the resends of the second are found in the sink."""
    from tessera.session import scratch_path
    from tessera.sources.fixtures import write_fx_raw
    from tessera.streaming.silver_stream import start_silver_stream

    ensure_conf(spark)
    raw, sink, ckpt = (scratch_path(spark, n) for n in ("fx-raw", "silver-stream", "silver-stream-ckpt"))
    for batch in (0, 1):
        write_fx_raw(load_table(spark, sf_dir, "events"), raw, [batch])
        q = start_silver_stream(spark, raw, sink, ckpt, glob=RAW_GLOB)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink)


# --- end-to-end -----------------------------------------------------------------


@register("e2e_daily_medallion")
def e2e_daily_medallion(spark, sf_dir):
    """L1: FX-RAW → Silver table → per-day gate → Gold for passing days → overview."""
    from tessera.plans.daily_job import daily_summary, run_daily

    raw = _landed_raw(spark, sf_dir)
    ns = _fresh_namespace(spark)
    result = run_daily(spark, raw, ns, glob=RAW_GLOB)
    return daily_summary(spark, result)


@register("daily_rerun_emptied_day")
def daily_rerun_emptied_day(spark, sf_dir):
    """L2: a day's raw files are replaced by lines without a valid row; its rerun empties the day and fails its gate."""
    from tessera.plans.daily_job import daily_summary, run_daily

    raw = _landed_raw(spark, sf_dir)
    ns = _fresh_namespace(spark)
    run_daily(spark, raw, ns, glob=RAW_GLOB)
    for batch in (0, 1):
        spark.range(1).select(F.lit("not json").alias("value")).write.mode("overwrite").text(f"{raw}/dt=2024-01-04/batch={batch}")
    return daily_summary(spark, run_daily(spark, raw, ns, ["2024-01-04", "2024-01-05"], glob=RAW_GLOB))


# --- files, loads, reports and runs --------------------------------------------


@register("silver_files_rerun")
def silver_files_rerun(spark, sf_dir):
    """A3 + A4: Silver files of all days; a rerun of two days empties one and replaces the other."""
    from tessera.session import scratch_path
    from tessera.sources.fixtures import event_number
    from tessera.sources.silver import read_silver_files, write_silver_files

    silver, root = _silver(spark, sf_dir), scratch_path(spark, "silver-files")
    write_silver_files(silver, root)
    rerun = silver.where((F.col("dt") == "2024-01-06") & (event_number() % 10 != 0))
    write_silver_files(rerun, root, ["2024-01-05", "2024-01-06"])
    return read_silver_files(spark, root)


@register("partition_counts")
def partition_counts(spark, sf_dir):
    """A9 + B10: rows per day after one day was loaded anew under a literal `dt`."""
    from tessera.sources.fixtures import event_number
    from tessera.sources.tables import partition_counts as counts, with_partition, write_partitions

    table, silver = _silver_table(spark, sf_dir)
    day = silver.where((F.col("dt") == "2024-01-06") & (event_number() % 10 != 0)).drop("dt")
    write_partitions(with_partition(day, "2024-01-06"), table)
    return counts(spark, table)


@register("silver_duplicate_ids")
def silver_duplicate_ids(spark, sf_dir):
    """G1: event ids that occur more than once."""
    from tessera.operators.dedup import duplicate_keys

    return duplicate_keys(_bad(spark, sf_dir), ["event_id"])


@register("quality_requested_days")
def quality_requested_days(spark, sf_dir):
    """The rules of a broken, a clean, a late and an absent day."""
    days = ["2024-01-03", "2024-01-04", "2024-01-05", "2023-12-31"]
    return quality.quality_rules(quality.quality_metrics(_bad(spark, sf_dir), days))


@register("quality_report_documents")
def quality_report_documents(spark, sf_dir):
    """The report documents, written as JSON text and read back."""
    import datetime as _dt

    from tessera.session import scratch_path

    path = scratch_path(spark, "quality-report")
    when = _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc)
    quality.write_quality_report(quality.quality_report(quality.quality_metrics(_bad(spark, sf_dir)), "silver_events", when), path)
    rules = "rules array<struct<rule: string, passed: boolean, actual: double, expected: string, severity: string>>"
    doc = spark.read.schema(f"table string, date string, checked_at string, row_count long, all_passed boolean, {rules}").json(path)
    failed = F.transform(F.filter("rules", lambda r: ~r["passed"]), lambda r: r["rule"])
    return doc.select(
        "table", "date", "checked_at", "row_count", "all_passed", F.size("rules").alias("rules"),
        F.array_join(F.array_sort(failed), ",").alias("failed"),
    )


@register("gold_empty_day")
def gold_empty_day(spark, sf_dir):
    """A build that includes a day without rows raises and writes nothing."""
    from tessera.plans.gold_build import build_gold

    silver, ns = _silver(spark, sf_dir), _fresh_namespace(spark)
    build_gold(spark, silver, ns, ["2024-01-05"])
    try:
        build_gold(spark, silver, ns, ["2024-01-06", "2030-01-01"])
    except gold.EmptyPartitionError:
        return spark.table(f"{ns}.daily_event_metrics")
    raise AssertionError("a day without rows was built")


@register("gold_mode_runs")
def gold_mode_runs(spark, sf_dir):
    """The run table of the three strategies, without the elapsed time."""
    from tessera.plans.gold_build import compare_modes

    ns = _fresh_namespace(spark)
    compare_modes(spark, _silver(spark, sf_dir), ns, ["2024-01-05", "2024-01-06"], f"{ns}.gold_runs")
    return spark.table(f"{ns}.gold_runs").select("mode", "date", "total_count")


@register("landed_line_counts")
def landed_line_counts(spark, sf_dir):
    """A13 + A14: lines of a source and of its landed copy by day."""
    from tessera.session import scratch_path
    from tessera.sources.raw import landed_line_counts as counts, write_jsonl

    silver = _silver(spark, sf_dir)
    source, landed = scratch_path(spark, "source"), scratch_path(spark, "landed")
    write_jsonl(silver, source)
    write_jsonl(silver, landed, ["dt"])
    return counts(spark, source, landed)


@register("snapshot_log_latest")
def snapshot_log_latest(spark, sf_dir):
    """the two latest snapshots."""
    from tessera.sources.versioned import snapshots

    return snapshots(spark, _versions(spark, sf_dir), limit=2)


@register("time_travel_evolved")
def time_travel_evolved(spark, sf_dir):
    """A later commit adds a column; it is NULL in the rows of earlier ones."""
    import datetime as _dt

    from tessera.sources.versioned import commit, read_as_of

    root = _versions(spark, sf_dir)
    day = _silver(spark, sf_dir).where(F.col("dt") == "2024-01-07").withColumn("ingest_source", F.lit("rerun"))
    commit(day, root, "overwrite", _dt.datetime(2024, 2, 4, tzinfo=_dt.timezone.utc))
    return read_as_of(spark, root)
