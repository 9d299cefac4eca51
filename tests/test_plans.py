"""Plan-shape checks: the physical plans keep the properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se

from conftest import SF_SMALL

# Registered queries that write state first (cheap at sf0.001, still exercised).
ALL = sorted(se.queries())


@pytest.fixture(autouse=True)
def no_cached_relations(spark):
    """Plans must be inspected as the optimizer builds them from the files, not
    with another test's cached DataFrame substituted into them."""
    spark.catalog.clearCache()
    yield


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ALL)
def test_no_cartesian_or_nested_loop(spark, name):
    df = se.queries()[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_gold_prunes_columns_and_aggregates_partially(spark):
    df = se.queries()["gold_daily_event_metrics"](spark, SF_SMALL)
    plan = plan_text(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan or (
        "props" not in plan.split("ReadSchema")[1].split("\n")[0]
    )
    assert "partial_count" in plan or "partial_sum" in plan


def test_first_seen_limits_before_shuffle(spark):
    df = se.queries()["dedup_first_seen_lineitem"](spark, SF_SMALL)
    plan = plan_text(df)
    exch = plan.index("Exchange hashpartitioning")
    below = plan[exch:]
    assert "WindowGroupLimit" in below and "Partial" in below, "a partial top-1 must run before the shuffle"


def test_day_query_pushes_time_range(spark):
    df = se.queries()["top_products_for_date"](spark, SF_SMALL)
    plan = plan_text(df)
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    assert "TakeOrderedAndProject" in plan


def test_table_day_filter_is_partition_pruned(spark, silver):
    from tessera.sources.tables import read_partition, write_partitions

    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_plan")
    spark.sql("DROP TABLE IF EXISTS t_plan.silver_events")
    write_partitions(silver, "t_plan.silver_events")
    plan = plan_text(read_partition(spark, "t_plan.silver_events", "2024-01-05"))
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-05" in plan


def test_time_travel_prunes_partitions(spark, silver, tmp_path):
    from tessera.sources import versioned
    from tessera.sources.fixtures import fx_versions

    root = str(tmp_path / "v")
    fx_versions(silver, root)
    df = versioned.read_as_of(spark, root, 2)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:") :].split("PushedFilters")[0]
    assert "attempt#" in filters and "dt#" in filters


def test_anomaly_profile_reads_the_raw_lines_once(spark):
    plan = plan_text(se.queries()["raw_anomaly_profile"](spark, SF_SMALL))
    assert plan.count("FileScan text") == 1
    assert "Expand" not in plan and "Join" not in plan


def test_ingest_counters_expand_nothing(spark):
    """One text scan; the distinct ids are counted as rows of the first level, and no path is shuffled."""
    plan = plan_text(se.queries()["raw_ingest_stats"](spark, SF_SMALL))
    assert plan.count("FileScan text") == 1
    assert "Expand" not in plan
    shuffled = [x for x in plan.splitlines() if "Exchange " in x or "HashAggregate" in x]
    assert shuffled and not any("_file" in x or "_path" in x for x in shuffled)


def test_unknown_products_preaggregates_before_join(spark):
    df = se.queries()["unknown_products"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    join_at = plan.index("Join")
    assert "HashAggregate" in plan[join_at:], "events must be aggregated below the join"
