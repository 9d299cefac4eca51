"""Operator 12 against a plain version, and its edge cases."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import negatives

SF = "/root/testdata/sf0.001"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, rank string"


def plain(rows, every=50):
    """Rows (vec_id, embedding, label) → the contract's rows."""
    table = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        e = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        table[i] = min(table.get(i, e), e)
    out = []
    for i, (label, v) in table.items():
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, other) for j, (other, w) in table.items() if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            fit = [(-s, n) for s, n, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(i, j, k + 1, n, -p, s) for k, (s, n) in enumerate(fit[:3])]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def run(spark, rows):
    v = spark.createDataFrame([(i, e, label, "x", "y") for i, e, label in rows], SCHEMA).repartition(3)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return got(negatives.mined(negatives.quantised(v, label=moved), v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("id"))))


def test_query_equals_plain_version_and_oracle(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    found = got(negatives.query(spark, SF))
    assert found == plain(rows)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
        assert found == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({negatives.ORACLE})").fetchall())


@pytest.mark.parametrize("first,cell", [(64, 16), (8, 4)])
def test_many_rounds_and_cells(spark, monkeypatch, first, cell):
    """Few rows a round and many cells: windows are certified early or late, and results stay."""
    for name, value in (("FIRST", first), ("CELL", cell), ("BLOCK", 5), ("GROUP", 3)):
        monkeypatch.setattr(negatives, name, value)
    rnd = random.Random(first)
    middles = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(1500):
        m = rnd.choice(middles)
        rows.append((i, [x + rnd.gauss(0, 0.05) for x in m], rnd.randrange(3)))
    assert run(spark, rows) == plain([(i, [float(F32(x)) for x in v], c) for i, v, c in rows])


def F32(x):
    import numpy as np

    return np.float32(x)


def test_edge_rows(spark):
    rnd = random.Random(3)
    unit = [0.5, 0.25, -0.75, 1.0]
    rows = [(i, list(unit), i % 2) for i in range(0, 400)]  # one vector, two labels
    rows += [(1000 + i, [rnd.choice((-1.0, 0.0, 0.5)) for _ in range(4)], i % 4) for i in range(300)]  # many ties
    rows += [(2000, None, 1), (2050, [0.5, None, 1.0, 0.0], 1), (2100, [float("nan"), 0.0, 0.0, 1.0], 1), (2150, [float("inf"), 0.0, 0.0, 1.0], 1)]
    rows += [(None, list(unit), 1), (2200, list(unit), None), (2250, [0.0] * 4, 1), (2300, [], 1), (2350, [0.5], 1), (2400, [1.0], 1), (2401, [0.25], 2), (-50, list(unit), 3)]
    rows += [(5, list(unit), 1), (5, list(unit), 1), (50, [9.0, 9.0, 9.0, 9.0], 0)]  # repeated ids
    assert run(spark, rows) == plain(rows)


def test_large_components_stay_exact(spark):
    rnd = random.Random(4)
    rows = [(i, [float(rnd.randrange(-(1 << 20), 1 << 20)) for _ in range(3)], i % 3) for i in range(200)]
    assert run(spark, rows) == plain(rows)


def test_empty_and_single(spark):
    assert run(spark, [(0, [0.5, 0.5], 1)]) == []
    v = spark.createDataFrame([], SCHEMA)
    assert negatives.mined(negatives.quantised(v), v.select(F.col("vec_id").alias("id"))).collect() == []
