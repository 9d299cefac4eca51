"""Quality gate (D7-D9, I1-I17) and Gold build."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import column_tests as ct
from tessera.operators import gold, marts, quality
from tessera.plans.gold_build import build_gold, compare_modes, record_run
from tessera.schemas import QUALITY_RULES
from tessera.sources.fixtures import fx_silver_bad


def test_clean_fixture_passes(silver):
    m = quality.quality_metrics(silver)
    assert quality.gate_passed(m)
    rules = quality.quality_rules(m)
    assert rules.select("rule").distinct().count() == len(QUALITY_RULES)


def test_bad_fixture_and_empty_day(spark, events):
    bad = fx_silver_bad(events)
    days = ["2024-01-02", "2024-02-15"]  # second day has no rows
    m = quality.quality_metrics(bad, days)
    rules = {(r["dt"], r["rule"]): r for r in quality.quality_rules(m).collect()}
    empty = {k[1]: v for k, v in rules.items() if k[0] == "2024-02-15"}
    assert not empty["partition_not_empty"]["passed"]
    assert empty["event_time_lte_ingest_time_ratio"]["actual"] == 1.0
    gate = {r["dt"]: r for r in quality.quality_gate(m).collect()}
    assert gate["2024-02-15"]["row_count"] == 0 and not gate["2024-02-15"]["all_passed"]
    assert not quality.gate_passed(m)


def test_report_document(silver):
    m = quality.quality_metrics(silver, ["2024-01-03"])
    doc = json.loads(quality.quality_report(m, "local.lakehouse.silver_events").first()["report"])
    assert doc["date"] == "2024-01-03" and doc["all_passed"] is True
    assert [r["rule"] for r in doc["rules"]] == QUALITY_RULES
    assert doc["checked_at"].endswith("Z") and len(doc["checked_at"]) == 20


def test_null_counts_as_one_distinct(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01"), ("a", "2024-01-01"), (None, "2024-01-01"), (None, "2024-01-01")],
        "event_id string, dt string",
    )
    for c in ["event_type", "schema_version", "event_time", "ingest_time", "price", "total_amount",
              "refund_amount", "order_id", "search_query"]:
        df = df.withColumn(c, F.lit(None).cast("string" if c in ("event_type", "order_id", "search_query") else
                                               "timestamp" if "time" in c else "long"))
    m = quality.quality_metrics(df).first()
    assert m["event_id_unique"] == 4 - 2


def test_a_rule_is_one_line(spark):
    """A table of other rules, over another table: measures, verdicts and empty days follow from it."""
    rules = [
        quality.Rule("some", "filled"),
        quality.Rule("k_unique", "unique", "k"),
        quality.Rule("v_short", "none", "length(v) > 3"),
        quality.Rule("v_given", "share", "v IS NULL", 0.25),
    ]
    df = spark.createDataFrame([("d1", 1, "ab"), ("d1", 1, "long text"), ("d1", None, None), ("d1", None, "x"), ("d2", 5, None)], "dt string, k int, v string")
    m = quality.quality_metrics(df, ["d1", "d2", "d3"], rules)
    assert {r["dt"]: tuple(r[c.name] for c in rules) for r in m.collect()} == {"d1": (4, 2, 1, 0.25), "d2": (1, 0, 0, 1.0), "d3": (0, 0, 0, 1.0)}
    got = {(r["dt"], r["rule"]): (r["passed"], r["expected"]) for r in quality.quality_rules(m, rules).collect()}
    assert [got["d1", r.name][0] for r in rules] == [True, False, False, True]
    assert [got["d3", r.name][0] for r in rules] == [False, True, True, False]
    assert got["d1", "v_given"][1] == "<= 0.25" and got["d1", "some"][1] == "> 0"
    assert {r["dt"]: r["rules_passed"] for r in quality.quality_gate(m, rules).collect()} == {"d1": 2, "d2": 3, "d3": 2}


def test_column_tests(spark, silver):
    stg = marts.stg_silver_events(silver)
    res = ct.declared_column_tests(
        {"silver_events": silver, "stg_silver_events": stg, "fct_daily_events": marts.fct_daily_events(stg),
         "fct_daily_revenue": marts.fct_daily_revenue(stg), "fct_daily_conversion": marts.fct_daily_conversion(stg)}
    ).collect()
    assert len(res) == len(ct.DECLARED_TESTS) == 29
    assert all(r["failures"] == 0 for r in res)
    df = spark.createDataFrame([("x",), ("x",), (None,), ("view",)], "event_type string")
    got = {(r["test"]): r["failures"] for r in ct.run_tests(
        df, "m", [("event_type", "not_null"), ("event_type", "unique"), ("event_type", "accepted_values")]).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1}


def test_single_and_multi_pass_agree(silver):
    assert all(r["diff_rows"] == 0 for r in gold.mode_parity(silver).collect())


def test_build_gold_writes_and_reruns(spark, silver):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS gold_t")
    run = build_gold(spark, silver, "gold_t", ["2024-01-03", "2024-01-04"])
    assert run.total_count == silver.where(F.col("dt").isin("2024-01-03", "2024-01-04")).count()
    build_gold(spark, silver, "gold_t", ["2024-01-04"], mode="multi-pass")  # rerun one day
    ev = spark.table("gold_t.daily_event_metrics")
    assert sorted(r["dt"] for r in ev.collect()) == ["2024-01-03", "2024-01-04"]
    with pytest.raises(gold.EmptyPartitionError):
        build_gold(spark, silver, "gold_t", ["2031-01-01"])
    record_run(spark, run, "gold_t.run_metrics")
    assert spark.table("gold_t.run_metrics").count() == 1


def test_compare_modes(spark, silver):
    runs = compare_modes(spark, silver, "gold_cmp", ["2024-01-05"])
    assert [r.mode for r in runs] == ["single-pass", "with-cache", "multi-pass"]
    assert len({r.total_count for r in runs}) == 1
    a = spark.table("gold_cmp_single_pass.daily_conversion_metrics")
    b = spark.table("gold_cmp_multi_pass.daily_conversion_metrics")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_silver_ids_unique_and_non_empty(silver, events):
    """G1: Silver `event_id` is distinct within each day and the table has rows."""
    from tessera.operators.dedup import duplicate_keys
    from tessera.sources.fixtures import fx_silver_bad

    assert silver.limit(1).count() == 1
    assert duplicate_keys(silver, ["dt", "event_id"]).count() == 0
    assert duplicate_keys(fx_silver_bad(events), ["dt", "event_id"]).count() > 0


def test_unknown_product_rows(spark, silver):
    """C3 rows: the events themselves, via the anti-join on catalog keys."""
    from pyspark.sql import functions as F

    from tessera.operators.profile import unknown_product_rows
    from tessera.sources.fixtures import fx_products, load_table

    products = fx_products(load_table(spark, "/root/testdata/sf0.001", "part"))
    rows = unknown_product_rows(silver, products)
    assert rows.count() == silver.where(F.col("product_id").startswith("PX")).count()


def test_column_tests_on_empty_model_report_zero(spark):
    df = spark.createDataFrame([], "event_id string, event_type string")
    got = {(r["column"], r["test"]): r["failures"] for r in ct.run_tests(
        df, "empty", [("event_id", "not_null"), ("event_id", "unique"), ("event_type", "accepted_values")]).collect()}
    assert got == {("event_id", "not_null"): 0, ("event_id", "unique"): 0, ("event_type", "accepted_values"): 0}


def _marts(spark, ns):
    from tessera.operators.marts import MARTS

    return {m: {tuple(r) for r in spark.table(f"{ns}.{m}").select("event_date", *[c for c in spark.table(f"{ns}.{m}").columns if c != "event_date"]).collect()} for m in MARTS}


def _full(silver):
    stg = marts.stg_silver_events(silver)
    return {n: {tuple(r) for r in f(stg).collect()} for n, f in
            (("fct_daily_events", marts.fct_daily_events), ("fct_daily_revenue", marts.fct_daily_revenue), ("fct_daily_conversion", marts.fct_daily_conversion))}


def test_incremental_marts_equal_full_ones(spark, silver):
    """Days built one after the other, rewritten, moved to another event day and emptied; a late event makes two partitions share a day."""
    from tessera.plans.mart_build import build_marts

    ns = "marts_t"
    spark.sql(f"DROP NAMESPACE IF EXISTS {ns} CASCADE")
    days = ["2024-01-03", "2024-01-04", "2024-01-05"]
    base = silver.where(F.col("dt").isin(days))
    late = base.where("dt = '2024-01-04'").withColumn("dt", F.lit("2024-01-05"))  # event day before its partition
    untimed = base.where("dt = '2024-01-03'").limit(3).withColumn("event_time", F.lit(None).cast("timestamp"))
    now = base.unionByName(late).unionByName(untimed)
    for day in days:
        build_marts(spark, now, ns, [day])
    assert _marts(spark, ns) == _full(now)
    # 2024-01-05 loses the late events, 2024-01-03 the untimed ones: the NULL day goes.
    done = build_marts(spark, base, ns, ["2024-01-05", "2024-01-03"])
    assert [str(d) for d in done] == ["2024-01-03", "2024-01-04", "2024-01-05", "None"]
    assert _marts(spark, ns) == _full(base)
    # A partition is emptied; the others stay as they are.
    rest = base.where("dt <> '2024-01-04'")
    assert [str(d) for d in build_marts(spark, rest, ns, ["2024-01-04"])] == ["2024-01-04"]
    assert _marts(spark, ns) == _full(rest)


def test_marts_expand_state_rows_only(spark, silver):
    """Distinct counts run over rows per user and session: no expand below the first aggregate."""
    plan = marts.fct_daily_events(marts.stg_silver_events(silver))._jdf.queryExecution().sparkPlan().toString()
    assert "Expand" in plan and "HashAggregate" in plan[plan.index("Expand"):]
