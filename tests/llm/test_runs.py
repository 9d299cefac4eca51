"""Operator 11 against a plain version, and its edge cases."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=12):
    """All runs of a list, by comparing it with itself at each distance."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain(doc_id, text):
    """The contract's row of a document."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in row)


def check(df, rows):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=key)
    assert got == sorted((plain(i, t) for i, t in rows), key=key)


def test_query_equals_plain_version(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' WHERE len(text) < 9000").fetchall()
    short = {i for i, _ in rows}
    got = runs.query(spark, SF)
    assert got.columns == list(COLUMNS)
    assert got.count() == duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    check(got.where(got.doc_id.isin(list(short))), rows)


def squares(rnd):
    """A sequence with many runs inside and across each other."""
    w = [rnd.randrange(3) for _ in range(rnd.randrange(1, 30))]
    for _ in range(rnd.randrange(6)):
        i = rnd.randrange(len(w))
        j = rnd.randrange(i, len(w)) + 1
        w = w[:j] + (w[i:j] * rnd.randrange(1, 5))[: rnd.randrange(1, 90)] + w[rnd.randrange(j, len(w) + 1) :]
    return w


@pytest.mark.parametrize("least", [2, 5, 12])
def test_random_batches(least):
    rnd = random.Random(least)
    for _ in range(400):
        batch = [squares(rnd) if rnd.random() < 0.8 else [rnd.randrange(2) for _ in range(rnd.randrange(80))] for _ in range(rnd.randrange(1, 6))]
        at = np.r_[0, np.cumsum([len(w) for w in batch])].astype(np.int64)
        start, end, period = runs.find_runs(np.array([x for w in batch for x in w], np.int64), at, least)
        want = [(at[k] + s, m, p) for k, w in enumerate(batch) for s, m, p in plain_runs(w, least)]
        assert sorted(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True)) == sorted(want)


def test_extensions_in_the_grammar():
    rnd = random.Random(1)
    for _ in range(60):
        w = squares(rnd)
        seq = np.array([100, *w, 101], np.int64)
        fixed = np.zeros(len(seq), bool)
        fixed[[0, -1]] = True
        g = runs.Grammar(seq, fixed)
        assert len(g.symbols[-1]) == 3 or not w
        pairs = [(i, j) for i in range(1, len(w) + 1) for j in range(1, len(w) + 1) if i != j]
        if not pairs:
            continue
        a, b = np.array(pairs).T
        for step, forward in ((1, True), (-1, False)):
            for i, j, got in zip(a, b, g.extend(a, b, forward).tolist(), strict=True):
                k = 0
                while seq[i + step * k] == seq[j + step * k]:
                    k += 1
                assert got == k


def test_edge_rows(spark):
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a " * 11), (5, "a " * 12), (6, "a b " * 6), (7, "a b " * 5 + "a"), (8, "é ü\v" * 40 + "end"), (8, "é ü\v" * 40 + "end"),
        (8, "other text"), (None, "x y z " * 9), (None, None), (10, "Word word " * 20), (11, " ".join(str(i % 50) for i in range(220))), (-5, "n n\fn " * 30),
        (12, "a b c d e f a b c d e f"), (13, "a b c d e a b c d e"), (14, " ".join("ab"[bin(i).count("1") % 2] for i in range(300))),
    ]
    texts += [(k, " ".join(str(i % 97) for i in range(60 + k))) for k in range(100, 140)]
    docs = spark.createDataFrame([(i, t, 5, 1, "r") for i, t in texts], "doc_id bigint, text string, start int, period int, runs string")
    check(runs.digests(docs), texts)
    assert runs.digests(docs.limit(0)).collect() == []


def test_runs_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "start " + "again and " * 8 + "end"), (2, None)], "doc_id int, text string")
    one, two = sorted(runs.periodic_runs(docs).collect())
    assert [tuple(r) for r in one.runs] == [(1, 16, 2)] and one.collapsed == "start again and end"
    assert two.runs == [] and two.collapsed == ""


def test_long_texts(spark):
    rnd = random.Random(2)
    same = "word " * 300_000
    vocab = [f"w{k}" for k in range(500)]
    period = [rnd.choice(vocab) for _ in range(20_011)]
    long = " ".join(period * 9)
    docs = spark.createDataFrame([(2, same), (3, long)], "doc_id bigint, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.periodic_runs(docs).collect()}
    assert got[2] == [(0, 300_000, 1)]
    assert (0, 9 * 20_011, 20_011) in got[3]
