"""Operator 13 against a plain version, and its edge cases."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest

from tessera.llm import mixing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, size bigint, number int, rid string, target string"


def plain(rows, weights=(5, 2, 1), share=1.5, cap=2):
    """Rows (doc_id, text, source) → Counter of (doc_id, size, source_size, target, taken), step by step."""
    docs = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    names = sorted({s for *_, s in docs if s is not None}) + [None] * any(s is None for *_, s in docs)
    size = {n: sum(z for _, z, s in docs if s == n) for n in names}
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    budget, capped, unit = share * sum(size.values()), set(), 0.0
    while True:
        open_ = [n for n in names if n not in capped]
        if not open_:
            break
        unit = (budget - sum(cap * size[n] for n in capped)) / sum(weight[n] for n in open_)
        more = {n for n in open_ if cap * size[n] < unit * weight[n]}
        if not more:
            break
        capped |= more
    target = {n: min(float(cap * size[n]), unit * weight[n]) for n in names}
    queue = []
    for k, n in enumerate(names):
        done = 0
        order = sorted(
            (p, int(hashlib.md5(f"0:{p}:{'null' if i is None else i}".encode()).hexdigest()[:15], 16), -1 if i is None else i, z, x)
            for p in range(cap) for x, (i, z, s) in enumerate(docs) if s == n
        )
        for p, key, i, z, x in order:
            done += z
            queue.append((done / target[n] if target[n] else 0.0, k, p, key, i, z, x))
    taken, used = Counter(), 0
    for *_, z, x in sorted(queue):
        taken[x] += max(0, min(z, int(budget) - used))
        used += z
    return Counter((i, z, size[s], target[s], taken[x]) for x, (i, z, s) in enumerate(docs))


def result(df):
    return Counter((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in df.collect())


def test_query_equals_plain_version(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    got = mixing.query(spark, SF)
    assert result(got) == plain(rows)
    assert result(mixing.query(spark, SF)) == result(got)


def test_oracle_on_given_documents(spark):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        want = Counter(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.ORACLE})").fetchall())
    assert result(mixing.query(spark, SF)) == want


@pytest.mark.parametrize("share,cap", [(1.5, 2), (0.4, 1), (5.0, 3)])
def test_edge_rows(spark, share, cap):
    rows = [
        (1, "a b c d e f", "é"), (2, None, "b"), (3, "", "b"), (4, " \t\n", "only blank"), (5, "x " * 3000, "big"), (6, "one", None), (None, "two words", None),
        (7, "q r s", "b"), (7, "q r s", "b"), (7, "q r", "b"), (8, "a b c", "\U0001f600"), (9, "w " * 40, "￮"), (-3, "neg id", "big"),
    ]
    docs = spark.createDataFrame([(i, t, s, 99, 1, "x", "y") for i, t, s in rows], SCHEMA)
    assert result(mixing.mixed(docs, share=share, cap=cap)) == plain(rows, share=share, cap=cap)


def test_empty_table_and_empty_texts(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id int, text string, source string")
    assert result(mixing.mixed(blank)) == Counter([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])


def test_hot_source_comes_near_its_target(spark):
    rows = [(i, "w " * (1 + i % 37), "hot" if i % 3 else f"s{i % 9}") for i in range(3000)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sum(taken.values()) == int(1.5 * sum(r["size"] for r in got))
    assert all(abs(taken[s] - t) <= 2 * 37 for s, t in target.items())
