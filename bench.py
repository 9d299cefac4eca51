"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The headline value mirrors the published baseline's measurement: elapsed from
before session creation to after the three Gold table writes (single-pass),
here over every day of the Silver table rather than one day.  Other timings
are per job, each forced to completion with a `noop` write or a table write.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    t_start = time.time()

    from tessera.session import build_session

    spark = build_session(
        f"local[{cpus}]",
        app_name="tessera-bench",
        shuffle_partitions=int(cpus) * 2,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tessera-bench-wh-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    session_sec = time.time() - t_start

    from tessera.operators import consume, marts, quality
    from tessera.operators.dedup import first_seen, parquet_position
    from tessera.operators.silver import ingest_stats, raw_to_silver
    from tessera.plans.gold_build import build_gold
    from tessera.session import scratch_path
    from tessera.sources.fixtures import fx_silver, load_table, write_fx_raw
    from tessera.sources.tables import ensure_namespace, write_partitions
    from tessera.streaming.silver_stream import start_silver_stream

    timings: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        timings[name] = round(time.time() - t, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # --- setup (untimed): Silver table from FX-SILVER, FX-RAW landing zone ---
    t_setup = time.time()
    events = load_table(spark, sf_dir, "events")
    ensure_namespace(spark, "lakehouse")
    write_partitions(fx_silver(events), "lakehouse.silver_events")
    silver = spark.table("lakehouse.silver_events")
    days = sorted(r["dt"] for r in silver.select("dt").distinct().collect())
    n_rows = silver.count()
    raw_root = scratch_path(spark, "bench-raw")
    write_fx_raw(events, raw_root)
    setup_sec = time.time() - t_setup

    # --- headline: Gold build (3 table writes), single-pass ---
    timed("gold_single_pass", lambda: build_gold(spark, silver, "gold", days, "single-pass"))
    timed("gold_with_cache", lambda: build_gold(spark, silver, "gold_cache", days, "with-cache"))
    timed("gold_multi_pass", lambda: build_gold(spark, silver, "gold_multi", days, "multi-pass"))

    # --- raw → Silver (parse, type, dedup, partition overwrite) and counters ---
    ensure_namespace(spark, "lake2")
    timed("raw_to_silver_table",
          lambda: write_partitions(raw_to_silver(spark, raw_root, glob="*.txt"), "lake2.silver_events"))
    timed("raw_ingest_stats",
          lambda: run(ingest_stats(spark, raw_root, glob="*.txt", silver=spark.table("lake2.silver_events"))))
    timed("silver_stream_available_now", lambda: start_silver_stream(
        spark, raw_root, scratch_path(spark, "bench-sink"), scratch_path(spark, "bench-ckpt"), glob="*.txt"
    ).awaitTermination())

    # --- quality gate, marts, consumption ---
    timed("quality_gate", lambda: run(quality.quality_gate(quality.quality_metrics(silver, days))))
    stg = marts.stg_silver_events(silver)
    timed("marts", lambda: [run(marts.fct_daily_events(stg)), run(marts.fct_daily_revenue(stg)),
                            run(marts.fct_daily_conversion(stg))])
    timed("top_products", lambda: consume.top_products(silver).collect())
    ev, rev = spark.table("gold.daily_event_metrics"), spark.table("gold.daily_revenue_metrics")
    timed("daily_business_overview", lambda: consume.daily_business_overview(ev, rev).collect())

    # --- first-seen dedup over lineitem's natural duplicates ---
    li = load_table(spark, sf_dir, "lineitem")
    timed("dedup_first_seen_lineitem", lambda: run(
        first_seen(parquet_position(li), ["l_orderkey", "l_linenumber"], ["_file", "_row"])))

    headline = round(session_sec + timings["gold_single_pass"], 3)
    print(
        json.dumps(
            {
                "metric": "gold_build_single_pass_elapsed_incl_session",
                "value": headline,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "silver_rows": n_rows,
                "days": len(days),
                "rows_per_sec_gold": round(n_rows / max(timings["gold_single_pass"], 1e-9), 1),
                "session_sec": round(session_sec, 3),
                "setup_sec": round(setup_sec, 3),
                "cpus": int(cpus),
                # Gold build incl. session start, 4 000 Silver rows of one day.
                "baseline_sec": 18.32,
                "baseline_rows": 4000,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
