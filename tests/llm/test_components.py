"""Connected components against a plain version, and the size of their rounds' plans (the driver pays for each exchange)."""

import random

from tessera.llm import components


def plain(edges):
    at = {}
    for a, b in edges:
        for x in (a, b):
            at.setdefault(x, x)

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in edges:
        one, two = sorted((root(a), root(b)))
        at[two] = one
    return {x: root(x) for x in at}


def test_components_of_repeated_and_self_links(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7), (500, 501), (500, 501), (501, 500)]
    edges += [(600, 700 + i) for i in range(50)] + [(700 + i, 900) for i in range(50)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint").coalesce(3)).collect()
    want = {x: c for x, c in plain(edges).items() if any(x in e and e[0] != e[1] for e in edges)}
    assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_roots_of_a_forest(spark):
    rng = random.Random(6)
    links = [(rng.randrange(max(1, i // 2)), i) for i in range(1, 150)] + [(1000 + i, 1001 + i) for i in range(70)]
    links += links[:20] + [(2000, 2000 + i) for i in range(1, 40)]
    got = components.roots(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    want = plain(links)
    assert len(got) == len({b for _, b in links}) and all(want[r.node] == r.component for r in got)
    assert components.roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rounds_have_small_plans(spark, tmp_path):
    spark.createDataFrame([(1, 2), (2, 3)], "a bigint, b bigint").write.parquet(path := str(tmp_path / "edges"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = components._star(components._star(spark.read.parquet(path), True), False)
        plan = both._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # A large star reads its edges twice, and the small star reads the large one twice.
    assert plan.count("Scan parquet") == 4 and plan.count("HashAggregate") == 8
