"""Tables (A5, A6, A9, A11, B11, J5, J6, L2), versions (J1-J4) and streaming (M1)."""

import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tessera.sources import versioned
from tessera.sources.fixtures import event_number, fx_versions
from tessera.sources.tables import (
    add_column_if_missing,
    align_to_schema,
    partition_counts,
    read_partition,
    write_partitions,
)


def test_ddl_dml_round_trip(spark):
    """Namespace, drop-if-exists, create, insert, ordered select."""
    spark.sql("CREATE NAMESPACE IF NOT EXISTS smoke")
    spark.sql("DROP TABLE IF EXISTS smoke.catalog_smoke")
    spark.sql("CREATE TABLE smoke.catalog_smoke (id INT, name STRING) USING parquet")
    spark.sql("INSERT INTO smoke.catalog_smoke VALUES (1, 'spark'), (2, 'iceberg')")
    rows = spark.sql("SELECT * FROM smoke.catalog_smoke ORDER BY id").collect()
    assert [(r.id, r.name) for r in rows] == [(1, "spark"), (2, "iceberg")]
    assert spark.sql("SELECT count(*) AS c FROM smoke.catalog_smoke").first()["c"] == 2


def test_partition_overwrite_is_idempotent(spark, silver):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_overwrite")
    table = "t_overwrite.silver_events"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    assert write_partitions(silver, table) is True
    before = {r["dt"]: r["rows"] for r in partition_counts(spark, table).collect()}
    day = silver.where(F.col("dt") == "2024-01-05")
    for _ in range(2):
        assert write_partitions(day.where(event_number() % 2 == 0), table) is False
    after = {r["dt"]: r["rows"] for r in partition_counts(spark, table).collect()}
    assert after["2024-01-05"] == day.where(event_number() % 2 == 0).count()
    assert {k: v for k, v in after.items() if k != "2024-01-05"} == {
        k: v for k, v in before.items() if k != "2024-01-05"}
    plan = read_partition(spark, table, "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_align_and_evolve(spark, silver):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_evolve")
    table = "t_evolve.silver_events"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    write_partitions(silver, table)
    assert add_column_if_missing(spark, table, "ingest_source") is True
    assert add_column_if_missing(spark, table, "ingest_source") is False
    assert spark.table(table).where(F.col("ingest_source").isNotNull()).count() == 0
    src = silver.where(F.col("dt") == "2024-01-06").drop("brand").withColumn("zzz", F.lit(1)) \
        .withColumn("price", F.col("price").cast("string"))
    aligned = align_to_schema(src, spark.table(table).schema)
    assert aligned.columns == spark.table(table).columns
    write_partitions(src, table)
    got = spark.table(table).where(F.col("dt") == "2024-01-06")
    assert got.where(F.col("brand").isNotNull()).count() == 0
    assert got.count() == silver.where(F.col("dt") == "2024-01-06").count()


def test_versions(spark, silver, tmp_path):
    root = str(tmp_path / "versioned")
    with pytest.raises(versioned.NoSnapshots):
        versioned.latest_two(spark, root)
    versioned.commit(silver, root, "append", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    with pytest.raises(versioned.SingleSnapshot):
        versioned.compare_with_previous(spark, root)
    versioned.commit(silver.where(F.lit(False)), root, "overwrite",
                     dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc), dates=["2024-01-07"])
    assert versioned.read_as_of(spark, root).where(F.col("dt") == "2024-01-07").count() == 0
    assert versioned.read_as_of(spark, root, 1).count() == silver.count()
    snaps = versioned.snapshots(spark, root).collect()
    assert [r["snapshot_id"] for r in snaps] == [2, 1]
    assert snaps[0]["total_records"] == silver.count() - silver.where(F.col("dt") == "2024-01-07").count()
    hist = versioned.history(spark, root).collect()
    assert [(r["snapshot_id"], r["parent_id"]) for r in hist] == [(2, 1), (1, None)]


def test_fx_versions_prunes_scan(spark, silver, tmp_path):
    root = str(tmp_path / "fxv")
    assert fx_versions(silver, root) == [1, 2, 3]
    plan = versioned.read_as_of(spark, root, 2)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*attempt#", plan)


def test_stream_matches_batch(spark, events, tmp_path):
    from tessera.operators.silver import raw_to_silver
    from tessera.sources.fixtures import write_fx_raw
    from tessera.streaming.silver_stream import start_silver_stream

    raw = str(tmp_path / "raw")
    write_fx_raw(events, raw)
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    q = start_silver_stream(spark, raw, sink, ckpt, glob="*.txt", max_files=7)
    q.awaitTermination()
    assert q.exception() is None
    streamed = spark.read.parquet(sink).drop("ingest_time")
    batch = raw_to_silver(spark, raw, glob="*.txt").drop("ingest_time")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_read_products_json_array(spark, tmp_path):
    import json as _json

    from tessera.sources.products import read_products

    items = [
        {"product_id": "P1", "category_id": "C01", "base_price": 1200, "brand": "B1", "shipping_class": "standard",
         "is_fragile": False},
        {"product_id": "P2", "category_id": "C02", "base_price": 990, "brand": "B2", "shipping_class": "bulky",
         "is_fragile": True},
    ]
    p = tmp_path / "products.json"
    p.write_text(_json.dumps(items, ensure_ascii=False, indent=2))
    rows = read_products(spark, str(p)).orderBy("product_id").collect()
    assert [r.asDict() for r in rows] == items


def test_landed_line_counts(spark, tmp_path):
    from tessera.sources.raw import landed_line_counts, write_jsonl

    src = tmp_path / "src.jsonl"
    src.write_text("\n".join(['{"a":%d}' % i for i in range(5)]) + "\n")
    landed = str(tmp_path / "landed")
    write_jsonl(spark.read.json(str(src)), landed)
    r = landed_line_counts(spark, str(src), landed).first()
    assert (r["source_lines"], r["landed_lines"], r["matches"]) == (5, 5, True)


def test_daily_job_rerun_is_idempotent(spark, events, tmp_path):
    from tessera.plans.daily_job import daily_summary, run_daily
    from tessera.sources.fixtures import write_fx_raw

    raw = str(tmp_path / "raw")
    write_fx_raw(events, raw)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS daily_t LOCATION '{tmp_path / 'wh'}'")
    days = ["2024-01-02", "2024-01-03"]
    first = run_daily(spark, raw, "daily_t", days, glob="*.txt")
    snap1 = sorted(tuple(r) for r in spark.table(first.silver_table).collect())
    s1 = sorted(tuple(r) for r in daily_summary(spark, first).collect())
    second = run_daily(spark, raw, "daily_t", days, glob="*.txt")
    assert sorted(tuple(r) for r in spark.table(second.silver_table).collect()) == snap1
    assert sorted(tuple(r) for r in daily_summary(spark, second).collect()) == s1
    assert set(first.passed_dates) | set(first.failed_dates) == set(days)


def test_snapshot_listing_limit(spark, silver, tmp_path):
    root = str(tmp_path / "v")
    fx_versions(silver, root)
    assert [r["snapshot_id"] for r in versioned.snapshots(spark, root, limit=2).collect()] == [3, 2]
    assert [r["snapshot_id"] for r in versioned.history(spark, root, limit=1).collect()] == [3]


def test_stream_keeps_late_events_and_dedups_untimed(spark, tmp_path):
    import json as _json
    import os
    import time as _time

    from tessera.streaming.silver_stream import start_silver_stream

    def line(eid, t):
        return _json.dumps({"event_id": eid, "event_type": "view", "event_time": t,
                            "ingest_time": "2024-03-10T00:00:00Z", "payload": {"price": 1}})

    day = tmp_path / "raw" / "dt=2024-03-10"
    day.mkdir(parents=True)
    (day / "a.jsonl").write_text("\n".join([
        line("e1", "2024-03-10T00:00:00Z"),
        line("late", "2024-02-01T00:00:00Z"),      # 38 days behind: must not be dropped
        line("naive", "2024-03-10T00:00:00"),       # no offset: NULL event_time, still deduped
    ]) + "\n")
    (day / "b.jsonl").write_text("\n".join([line("naive", "2024-03-10T00:00:00"), line("e1", "2024-03-10T00:00:00Z")]) + "\n")
    now = _time.time()
    os.utime(day / "a.jsonl", (now - 60, now - 60))
    os.utime(day / "b.jsonl", (now, now))
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    q = start_silver_stream(spark, str(tmp_path / "raw"), sink, ckpt, max_files=1)
    q.awaitTermination()
    assert q.exception() is None
    ids = sorted(r["event_id"] for r in spark.read.parquet(sink).collect())
    assert ids == ["e1", "late", "naive"]


def test_rerun_keeps_other_days_even_if_session_was_static(spark, silver):
    """`insertInto` ignores a per-write overwrite mode, so write_partitions must
    (re)apply the session setting itself; a STATIC session must not wipe days."""
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_static")
    spark.sql("DROP TABLE IF EXISTS t_static.silver_events")
    write_partitions(silver, "t_static.silver_events")
    days = silver.select("dt").distinct().count()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        write_partitions(silver.where(F.col("dt") == "2024-01-05"), "t_static.silver_events")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert spark.table("t_static.silver_events").select("dt").distinct().count() == days


def test_stream_continuous_mode(spark, events, tmp_path):
    """Processing-time trigger: drain what has landed, stop, same rows as the batch job."""
    from tessera.operators.silver import raw_to_silver
    from tessera.sources.fixtures import write_fx_raw
    from tessera.streaming.silver_stream import start_silver_stream

    raw = str(tmp_path / "raw")
    write_fx_raw(events.where(F.col("ts") < F.lit("2024-01-04")), raw)
    sink = str(tmp_path / "sink")
    q = start_silver_stream(spark, raw, sink, str(tmp_path / "ckpt"), glob="*.txt", available_now=False,
                            interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.read.parquet(sink).drop("ingest_time")
    batch = raw_to_silver(spark, raw, glob="*.txt").drop("ingest_time").select(*streamed.columns)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_crashed_commit_leaves_no_visible_rows(spark, silver, tmp_path):
    """Data written by an attempt whose log row never landed is never read,
    even though the next commit reuses its snapshot id."""
    import datetime as _dt

    root = str(tmp_path / "v")
    versioned.commit(silver, root, "append", _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc))
    # Simulate a crash: snapshot 2's data lands, its log row does not.
    (silver.where(F.col("dt") == "2024-01-05").withColumn("snapshot_id", F.lit(2).cast("long"))
     .withColumn("attempt", F.lit("crashed")).write.mode("append")
     .partitionBy("snapshot_id", "attempt", "dt").parquet(f"{root}/data"))
    assert versioned.read_as_of(spark, root).count() == silver.count()
    keep = silver.where((F.col("dt") == "2024-01-05") & (event_number() % 2 == 0))
    assert versioned.commit(keep, root, "overwrite", dates=["2024-01-05"]) == 2
    now = versioned.read_as_of(spark, root).where(F.col("dt") == "2024-01-05").count()
    assert now == keep.count()


def _raw_day(root, day, lines, name="a.jsonl"):
    os.makedirs(f"{root}/dt={day}", exist_ok=True)
    with open(f"{root}/dt={day}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def _event(eid, day, **more):
    doc = {"event_id": eid, "schema_version": 1, "event_type": "view", "event_time": f"{day}T10:00:00Z",
           "ingest_time": f"{day}T10:00:01Z", "payload": {"product_id": "P1"}}
    return json.dumps({**doc, **more})


def test_rerun_of_an_emptied_day(spark, tmp_path):
    from tessera.plans.daily_job import daily_summary, run_daily

    raw, d1, d2 = str(tmp_path / "raw"), "2024-03-01", "2024-03-02"
    _raw_day(raw, d1, [_event("a", d1)])
    _raw_day(raw, d2, [_event("b", d2)])
    assert run_daily(spark, raw, "emptied_t").passed_dates == [d1, d2]
    _raw_day(raw, d2, ["not json"])
    for dates in ([d1, d2], None):
        again = run_daily(spark, raw, "emptied_t", dates)
        assert (again.passed_dates, again.failed_dates) == ([d1], [d2])
        assert spark.table("emptied_t.silver_events").where(F.col("dt") == d2).count() == 0
        got = {r["dt"]: (r["row_count"], r["all_passed"], r["total_events"]) for r in daily_summary(spark, again).collect()}
        assert got == {d1: (1, True, 1), d2: (0, False, None)}
    _raw_day(raw, d1, ["not json"])  # no row at all
    assert run_daily(spark, raw, "emptied_t").failed_dates == [d1, d2]
    assert spark.table("emptied_t.silver_events").count() == 0


def test_no_gold_is_shown_for_a_day_that_fails_now(spark, tmp_path):
    from tessera.plans.daily_job import daily_summary, run_daily

    raw, d1, d2 = str(tmp_path / "raw"), "2024-03-01", "2024-03-02"
    for d in (d1, d2):
        _raw_day(raw, d, [_event(f"{d}-{i}", d) for i in range(2)])
    run_daily(spark, raw, "stale_t")
    _raw_day(raw, d2, [_event("x", d2, event_type="unknown")])
    got = {r["dt"]: (r["all_passed"], r["total_events"]) for r in daily_summary(spark, run_daily(spark, raw, "stale_t")).collect()}
    assert got == {d1: (True, 2), d2: (False, None)}


def test_versioned_columns_and_read_errors(spark, tmp_path):
    root = str(tmp_path / "v")
    base = spark.createDataFrame([("a", "2024-03-01"), ("b", "2024-03-02")], "event_id string, dt string")
    versioned.commit(base, root, "append", dt.datetime(2024, 3, 3, tzinfo=dt.timezone.utc))
    more = spark.createDataFrame([("c", "new", "2024-03-02")], "event_id string, ingest_source string, dt string")
    versioned.commit(more, root, "overwrite", dt.datetime(2024, 3, 4, tzinfo=dt.timezone.utc))
    now = versioned.read_as_of(spark, root)
    assert sorted(map(tuple, now.select("event_id", "ingest_source", "dt").collect()), key=str) == [
        ("a", None, "2024-03-01"), ("c", "new", "2024-03-02")]
    assert versioned.read_as_of(spark, root, 1).columns == ["event_id", "dt"]
    log = root + "/log"
    for name in os.listdir(log):
        if name.endswith(".parquet"):
            with open(f"{log}/{name}", "wb") as f:
                f.write(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet|footer|file"):
        versioned.commit(base, root, "append")


def test_a_write_makes_one_file_a_day(spark, silver):
    from tessera.sources.tables import ensure_namespace, write_partitions

    ensure_namespace(spark, "clustered_t")
    spark.sql("DROP TABLE IF EXISTS clustered_t.silver")
    write_partitions(silver.repartition(8), "clustered_t.silver")
    table = spark.table("clustered_t.silver")
    assert len(table.inputFiles()) <= table.select("dt").distinct().count() + 1


def test_stream_keeps_rows_of_files_with_an_old_time(spark, tmp_path):
    from tessera.streaming.silver_stream import start_silver_stream

    raw, sink, ckpt = (str(tmp_path / n) for n in ("raw", "sink", "ckpt"))

    def drain():
        q = start_silver_stream(spark, raw, sink, ckpt)
        q.awaitTermination()
        assert q.exception() is None

    _raw_day(raw, "2024-03-01", [_event("a", "2024-03-01")])
    drain()
    _raw_day(raw, "2024-03-02", [_event("b", "2024-03-02"), _event("b", "2024-03-02")])
    old = time.time() - 3 * 86400
    os.utime(f"{raw}/dt=2024-03-02/a.jsonl", (old, old))
    drain()
    _raw_day(raw, "2024-03-03", [_event("c", "2024-03-03")])
    drain()
    assert sorted(r["event_id"] for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def _drain(spark, raw, sink, ckpt, **more):
    from tessera.streaming.silver_stream import start_silver_stream

    q = start_silver_stream(spark, raw, sink, ckpt, **more)
    q.awaitTermination()
    assert q.exception() is None


def test_stream_drops_duplicates_of_any_age(spark, tmp_path):
    """A copy in a later run, 72 hours or a month after the first, is dropped; ids of other days stay apart."""
    raw, sink, ckpt = (str(tmp_path / n) for n in ("raw", "sink", "ckpt"))
    _raw_day(raw, "2024-03-01", [_event("a", "2024-03-01", user_id="first"), _event("b", "2024-03-01")])
    _drain(spark, raw, sink, ckpt)
    _raw_day(raw, "2024-03-01", [_event("a", "2024-03-04", user_id="late"), _event("c", "2024-03-04"), _event("c", "2024-03-31", user_id="later")], name="b.jsonl")
    _raw_day(raw, "2024-03-04", [_event("a", "2024-03-04", user_id="other day")])
    _drain(spark, raw, sink, ckpt)
    _drain(spark, raw, sink, ckpt)  # nothing new: nothing happens
    got = sorted((r["dt"], r["event_id"], r["user_id"]) for r in spark.read.parquet(sink).collect())
    assert got == [("2024-03-01", "a", "first"), ("2024-03-01", "b", None), ("2024-03-01", "c", None), ("2024-03-04", "a", "other day")]


def test_stream_replayed_batch_changes_nothing(spark, tmp_path):
    """A micro-batch whose rows were written, in whole or in part, before its commit was logged."""
    import pathlib

    import pyarrow.parquet as pq

    raw, sink, ckpt = (str(tmp_path / n) for n in ("raw", "sink", "ckpt"))
    _raw_day(raw, "2024-03-01", [_event(f"e{i}", "2024-03-01", user_id=str(i)) for i in range(20)] + [_event("e3", "2024-03-02")])
    _raw_day(raw, "2024-03-02", [_event(f"f{i}", "2024-03-02") for i in range(5)])

    def crash(batch_id):
        raise RuntimeError(f"lost after batch {batch_id} was written")

    from tessera.streaming.silver_stream import start_silver_stream

    q = start_silver_stream(spark, raw, sink, ckpt, after=crash)
    with pytest.raises(Exception, match="lost after batch 0"):
        q.awaitTermination()
    rows = sorted(spark.read.parquet(sink).collect())
    assert len(rows) == 25
    _drain(spark, raw, sink, ckpt)  # the same batch once more
    assert sorted(spark.read.parquet(sink).collect()) == rows
    # An attempt that wrote some of its rows only: one day, and half of the other.
    part, ckpt2 = str(tmp_path / "part"), str(tmp_path / "ckpt2")
    half = spark.read.parquet(sink).where("dt = '2024-03-01' AND user_id < 5")
    half.write.partitionBy("dt").parquet(part)
    _drain(spark, raw, part, ckpt2)
    assert sorted(spark.read.parquet(part).select(*spark.read.parquet(sink).columns).collect()) == rows
    assert sum(pq.read_metadata(f).num_rows for f in pathlib.Path(part).rglob("*.parquet")) == 25


def test_stream_first_seen_copy_as_in_batch(spark, events, tmp_path):
    """Originals, then resends, drained in runs of their own: all columns equal the batch path's, `ingest_time` too."""
    from tessera.operators.silver import raw_to_silver
    from tessera.sources.fixtures import write_fx_raw

    raw, sink, ckpt = (str(tmp_path / n) for n in ("raw", "sink", "ckpt"))
    for batch in (0, 1):
        write_fx_raw(events, raw, [batch])
        _drain(spark, raw, sink, ckpt, glob="*.txt")
    streamed, batch = spark.read.parquet(sink), raw_to_silver(spark, raw, glob="*.txt")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_stream_reads_only_the_days_of_the_batch(spark, tmp_path):
    from tessera.streaming.silver_stream import seen_keys

    sink = str(tmp_path / "sink")
    spark.createDataFrame([("a", 1, "2024-03-01"), ("b", 2, "2024-03-02"), ("c", 3, "2024-03-03")], "event_id string, x int, dt string").write.partitionBy("dt").parquet(sink)
    seen = seen_keys(spark, sink, ["2024-03-02", "2024-04-01"])
    assert [tuple(r) for r in seen.collect()] == [("2024-03-02", "b")]
    assert all("dt=2024-03-02" in f for f in seen.inputFiles())
    assert seen_keys(spark, sink, ["2024-05-01"]) is None


def test_history_after_rollbacks(spark, tmp_path):
    """The log branches twice; each snapshot is read along its own chain, and the comparison equals the data."""
    root = str(tmp_path / "v")

    def commit(n, rows, onto=None, dates=None):
        df = spark.createDataFrame(rows, "x int, dt string")
        return versioned.commit(df, root, "overwrite", dt.datetime(2024, 2, n, tzinfo=dt.timezone.utc), dates, onto)

    a, b = "2024-01-01", "2024-01-02"
    commit(1, [(1, a), (2, a), (3, b)])
    commit(2, [(4, a)])
    commit(3, [(5, b), (6, b)])
    commit(4, [(7, b)], onto=2)  # 3 is left out
    commit(5, [(8, a), (9, a), (10, a)])
    commit(6, [], onto=1, dates=[b])  # 2, 4 and 5 are left out
    commit(7, [(11, None)])
    want = {1: {1, 2, 3}, 2: {4, 3}, 3: {4, 5, 6}, 4: {4, 7}, 5: {8, 9, 10, 7}, 6: {1, 2}, 7: {1, 2, 11}}
    for sid, xs in want.items():
        assert {r["x"] for r in versioned.read_as_of(spark, root, sid).collect()} == xs
    hist = {r["snapshot_id"]: (r["parent_id"], r["is_current_ancestor"]) for r in versioned.history(spark, root).collect()}
    assert hist == {1: (None, True), 2: (1, False), 3: (2, False), 4: (2, False), 5: (4, False), 6: (1, True), 7: (6, True)}
    told = {r["snapshot_id"]: (r["deleted_records"], r["total_records"]) for r in versioned.snapshots(spark, root).collect()}
    assert {k: t for k, (_, t) in told.items()} == {k: len(v) for k, v in want.items()}
    assert {k: d for k, (d, _) in told.items()} == {1: 0, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 0}
    from_log = versioned.compare_with_previous(spark, root)
    assert sorted(map(str, from_log.collect())) == sorted(map(str, versioned.compare_with_previous(spark, root, check=True).collect()))
    assert "data/" not in from_log._jdf.queryExecution().executedPlan().toString()
    assert not any("/data/" in f for f in from_log.inputFiles())


def test_days_are_cleared_at_once(spark, silver):
    from tessera.sources.tables import clear_partitions

    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_clear")
    spark.sql("DROP TABLE IF EXISTS t_clear.t")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "it's \\ a day"), (3, "2024-01-03"), (4, None)], "x int, dt string")
    write_partitions(rows, "t_clear.t")
    clear_partitions(spark, "t_clear.t", ["2024-01-01", "it's \\ a day", "2030-01-01", None])
    assert [r["x"] for r in spark.table("t_clear.t").collect()] == [3]
    write_partitions(rows.where("x = 1"), "t_clear.t")
    assert sorted(r["x"] for r in spark.table("t_clear.t").collect()) == [1, 3]
