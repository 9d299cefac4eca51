"""Command-line jobs with the reference's arguments and exit codes.

    python -m tessera.cli raw-to-silver   --raw-root R --silver-root S --date D
    python -m tessera.cli silver-to-table --silver-root S --table T --date D
    python -m tessera.cli quality         --table T --date D [--report-out P]
    python -m tessera.cli gold            --table T --gold-namespace G --date D [--mode single-pass]
    python -m tessera.cli gold-modes      --table T --date D [--metrics-table M]
    python -m tessera.cli daily           --raw-root R --namespace N --date D [--date D2 ...]
    python -m tessera.cli inspect         --root V [--limit 10]
    python -m tessera.cli time-travel     --root V --date D
    python -m tessera.cli schema-evolution --table T --date D [--new-column ingest_source]

Exit codes: 0 ok; 2 failed quality gate / empty partition / no snapshot /
column add failed; 3 no raw input / only one snapshot / no rows to verify.
Every job is a thin argument layer over the DataFrame functions; the session
comes from `build_session` (an existing session is reused).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from tessera.operators import gold as gold_ops
from tessera.operators import quality
from tessera.operators.consume import validate_date
from tessera.operators.silver import raw_to_silver_observed
from tessera.session import build_session, checkpoint_dir
from tessera.sources import versioned
from tessera.sources.raw import RawPartitionMissing
from tessera.sources.silver import day_parts, read_silver_files, write_silver_files
from tessera.sources.tables import (
    add_column_if_missing,
    ensure_namespace,
    partition_counts,
    read_partition,
    with_partition,
    write_partitions,
)

OK, FAILED, MISSING = 0, 2, 3


def _namespace(table: str) -> str:
    return table.rsplit(".", 1)[0]


def cmd_raw_to_silver(spark, a) -> int:
    """One pass over the raw files: counters are observed while Silver is written."""
    try:
        silver, counters = raw_to_silver_observed(spark, a.raw_root, [a.date], a.glob)
    except RawPartitionMissing as exc:
        print(f"missing input: {exc}")
        return MISSING
    written = write_silver_files(silver, a.silver_root, [a.date], a.rows_per_file)
    c = counters.get
    parts = day_parts(spark, a.silver_root, [a.date])[a.date]
    print(
        f"silver [{a.date}] -> {a.silver_root}: {written['rows']} rows in {parts} files; "
        f"{c['raw_lines']} raw objects, {c['valid_rows'] - written['rows']} duplicates skipped, "
        f"{c['json_parse_errors']} unparseable lines"
    )
    return OK


def cmd_silver_to_table(spark, a) -> int:
    ensure_namespace(spark, _namespace(a.table))
    df = with_partition(read_silver_files(spark, a.silver_root, [a.date]).drop("dt"), a.date)
    created = write_partitions(df, a.table)
    if created:
        print(f"created {a.table}")
    rows = partition_counts(spark, a.table, [a.date]).collect()
    print(f"{a.table} [{a.date}]: {rows[0]['rows'] if rows else 0} rows")
    return OK


def cmd_quality(spark, a) -> int:
    checkpoint_dir(spark)
    m = quality.quality_metrics(spark.table(a.table), [a.date]).checkpoint()
    report = quality.quality_report(m, a.table)
    print(json.dumps(json.loads(report.first()["report"]), ensure_ascii=False, indent=2))
    if a.report_out:
        quality.write_quality_report(report, a.report_out)
    if a.results_table:
        quality.record_quality_results(m, a.results_table, source_table=a.table)
    return OK if quality.gate_passed(m) else FAILED


def cmd_gold(spark, a) -> int:
    from tessera.plans.gold_build import build_gold, record_run

    try:
        run = build_gold(spark, spark.table(a.table), a.gold_namespace, [a.date], a.mode)
    except gold_ops.EmptyPartitionError as exc:
        print(f"failed: {exc}")
        return FAILED
    print(f"gold [{a.date}] {run.mode}: {run.elapsed_sec:.2f} s, {run.total_count} silver rows")
    if a.metrics_table:
        record_run(spark, run, a.metrics_table)
    return OK


def cmd_gold_modes(spark, a) -> int:
    """L3: build one day's Gold with every strategy, record elapsed time and rows."""
    from tessera.plans.gold_build import compare_modes

    try:
        runs = compare_modes(spark, spark.table(a.table), a.namespace_prefix, [a.date], a.metrics_table)
    except gold_ops.EmptyPartitionError as exc:
        print(f"failed: {exc}")
        return FAILED
    for run in runs:
        print(f"{run.mode:12s} {run.elapsed_sec:7.2f} s  {run.total_count} rows")
    return OK


def cmd_daily(spark, a) -> int:
    from tessera.plans.daily_job import run_daily

    try:
        res = run_daily(spark, a.raw_root, a.namespace, a.date, a.glob, a.report_out)
    except RawPartitionMissing as exc:
        print(f"missing input: {exc}")
        return MISSING
    print(f"gold built: {res.passed_dates or '-'}; gate failed: {res.failed_dates or '-'}")
    return OK if not res.failed_dates else FAILED


def cmd_inspect(spark, a) -> int:
    print("-- snapshots, newest first")
    versioned.snapshots(spark, a.root, a.limit).show(a.limit, truncate=False)
    print("-- history, newest first")
    versioned.history(spark, a.root, a.limit).show(a.limit, truncate=False)
    return OK


def cmd_time_travel(spark, a) -> int:
    try:
        cmp = versioned.compare_with_previous(spark, a.root, [a.date]).first()
    except versioned.NoSnapshots as exc:
        print(f"failed: {exc}")
        return FAILED
    except versioned.SingleSnapshot as exc:
        print(f"failed: {exc}")
        return MISSING
    cur, prev = (cmp["current_count"], cmp["previous_count"]) if cmp else (0, 0)
    print(f"{a.date}: {cur} rows now, {prev} rows one snapshot earlier")
    return OK


def cmd_schema_evolution(spark, a) -> int:
    try:
        added = add_column_if_missing(spark, a.table, a.new_column)
    except RuntimeError as exc:
        print(f"failed: {exc}")
        return FAILED
    print(f"{a.new_column}: {'added' if added else 'present'}")
    row = read_partition(spark, a.table, a.date).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col(a.new_column).isNull(), 1).otherwise(0)).alias("nulls"),
    ).first()
    if not row["total"]:
        print(f"{a.date}: partition is empty, nothing to verify")
        return MISSING
    print(f"{a.date}: {row['nulls']} of {row['total']} rows have NULL {a.new_column}")
    return OK


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name, fn, *args):
        sp = sub.add_parser(name)
        for flag, kw in args:
            sp.add_argument(flag, **kw)
        sp.set_defaults(fn=fn)
        return sp

    date = ("--date", {"required": True, "type": validate_date, "help": "YYYY-MM-DD"})
    dates = ("--date", {"required": True, "type": validate_date, "action": "append", "help": "YYYY-MM-DD (repeatable)"})
    glob = ("--glob", {"default": "*.jsonl"})
    add("raw-to-silver", cmd_raw_to_silver, ("--raw-root", {"required": True}), ("--silver-root", {"required": True}),
        date, glob, ("--rows-per-file", {"type": int, "default": 50000}))
    add("silver-to-table", cmd_silver_to_table, ("--silver-root", {"required": True}),
        ("--table", {"default": "lakehouse.silver_events"}), date)
    add("quality", cmd_quality, ("--table", {"default": "lakehouse.silver_events"}), date,
        ("--report-out", {"default": None}), ("--results-table", {"default": None}))
    add("gold", cmd_gold, ("--table", {"default": "lakehouse.silver_events"}), ("--gold-namespace", {"default": "gold"}),
        date, ("--mode", {"default": "single-pass", "choices": ["single-pass", "with-cache", "multi-pass"]}),
        ("--metrics-table", {"default": None}))
    add("gold-modes", cmd_gold_modes, ("--table", {"default": "lakehouse.silver_events"}), date,
        ("--namespace-prefix", {"default": "gold_exp"}), ("--metrics-table", {"default": None}))
    add("daily", cmd_daily, ("--raw-root", {"required": True}), ("--namespace", {"default": "lakehouse"}), dates, glob,
        ("--report-out", {"default": None}))
    add("inspect", cmd_inspect, ("--root", {"required": True}), ("--limit", {"type": int, "default": 10}))
    add("time-travel", cmd_time_travel, ("--root", {"required": True}), date)
    add("schema-evolution", cmd_schema_evolution, ("--table", {"default": "lakehouse.silver_events"}), date,
        ("--new-column", {"default": "ingest_source"}))
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(app_name=f"tessera-{args.command}")
    return int(args.fn(spark, args))


if __name__ == "__main__":
    sys.exit(main())
