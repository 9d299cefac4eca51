"""Correctness with a hot key: one event id carries a third of all rows."""

from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.operators.dedup import first_seen
from tessera.operators.profile import unknown_products
from tessera.sources.fixtures import event_number, fx_products, load_table

from conftest import SF_SMALL


def hot(silver):
    n = event_number()
    return silver.withColumn("_n", n).withColumn(
        "event_id", F.when(n % 3 == 0, F.lit("HOT")).otherwise(F.col("event_id"))
    )


def test_first_seen_with_hot_key(spark, silver):
    df = hot(silver).repartition(8)  # hot rows spread over every map partition
    out = first_seen(df, ["dt", "event_id"], ["_n"])
    per_day_hot = {r["dt"]: r["_n"] for r in out.where("event_id = 'HOT'").collect()}
    expected = {r["dt"]: r["m"] for r in df.where("event_id = 'HOT'").groupBy("dt").agg(F.min("_n").alias("m")).collect()}
    assert per_day_hot == expected
    assert out.count() == df.select("dt", "event_id").distinct().count()


def test_quality_duplicates_with_hot_key(spark, silver):
    df = hot(silver)
    m = {r["dt"]: r["duplicate_event_id_count"] for r in quality.quality_metrics(df).collect()}
    exp = {
        r["dt"]: r["n"] - 1
        for r in df.where("event_id = 'HOT'").groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert {k: v for k, v in m.items() if k in exp} == exp


def test_unknown_products_with_hot_product(spark, silver):
    skewed = silver.withColumn(
        "product_id", F.when(event_number() % 3 == 0, F.lit("PX999")).otherwise(F.col("product_id"))
    )
    res = unknown_products(skewed, fx_products(load_table(spark, SF_SMALL, "part")))
    got = res.agg(F.sum("unknown_product_events")).first()[0]
    known = {f"P{k}" for k in range(100)}
    rows = skewed.where(F.col("product_id").isNotNull()).select("product_id").collect()
    assert got == sum(1 for r in rows if r["product_id"] not in known)
