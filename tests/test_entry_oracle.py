"""Driver contract: entry smoke, and every registered query against its DuckDB oracle (sf0.001)."""

import datetime as dtm
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as se

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dtm.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dtm.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = se.entry(spark)
    assert df.columns == ["dt", "total_events", "purchase_events", "refund_events", "gross_revenue",
                          "refund_amount", "net_revenue"]
    assert df.count() > 0


def test_every_query_of_the_catalog_has_an_oracle():
    from tessera.plans.catalog import QUERIES

    assert set(QUERIES) <= set(se.oracle_sql()) <= set(se.queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {se.oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types
