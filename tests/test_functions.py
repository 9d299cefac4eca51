"""Typed JSON conversions (B3-B6) against a brute-force Python model of the contract."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.json_values import variant_to_int, variant_to_str
from tessera.functions.time import parse_iso_utc


def model_int(v):
    """Contract: bool/None/object/array → None; int as-is; float truncated; text → float → truncated."""
    if v is None or isinstance(v, bool) or isinstance(v, (dict, list)):
        return None
    if isinstance(v, int):
        return v if -(2**63) <= v < 2**63 else None
    if isinstance(v, float):
        return int(v) if math.isfinite(v) and -(2**63) <= v < 2**63 else None
    s = v.strip()
    if not s:
        return None
    try:
        f = float(s)
    except ValueError:
        return None
    if not math.isfinite(f) or not (-(2**63) <= f < 2**63):
        return None
    return int(f)


def model_str(v):
    if v is None or isinstance(v, (dict, list)):
        return None
    return str(v)


VALUES = [
    1, -7, 0, 12.7, -2.7, 1e3, 1.5e-3, 1.5e-4, 1e-5, 12345678.9, 1e16, 1e23, -2.5e-7, 5.0, 0.0, 123456789012345.0, "42", " 17 ", "1e3", " 1e3 ", "12.9", "-3.5", "+8", ".5", "5.", "1_000",
    "", "   ", "abc", "12f", "0x10", "1.2.3", "nan", "inf", True, False, None, {"a": 1}, [1, 2], "9007199254740993",
    12345678901234567890,
]


@pytest.fixture(scope="module")
def conv(spark):
    rows = [(i, json.dumps({"x": v})) for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "i int, line string")
    x = F.try_variant_get(F.try_parse_json("line"), "$.x", "variant")
    out = df.select("i", variant_to_int(x).alias("as_int"), variant_to_str(x).alias("as_str")).collect()
    return {r["i"]: (r["as_int"], r["as_str"]) for r in out}


@pytest.mark.parametrize("i", range(len(VALUES)))
def test_to_int(conv, i):
    assert conv[i][0] == model_int(VALUES[i]), VALUES[i]


@pytest.mark.parametrize("i", range(len(VALUES)))
def test_to_str(conv, i):
    v = VALUES[i]
    assert conv[i][1] == model_str(v), v


def model_ts(s):
    if not isinstance(s, str) or not s:
        return None
    try:
        d = dt.datetime.fromisoformat(s[:-1] + "+00:00" if s.endswith("Z") else s)
    except ValueError:
        return None
    if d.tzinfo is None:
        return None
    d = d.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return d.replace(microsecond=d.microsecond // 1000 * 1000)


TIMES = [
    "2024-01-01T00:00:00Z",
    "2024-01-01T00:00:00.123456Z",
    "2024-01-01T09:30:00+09:00",
    "2024-01-01T09:30:00.5-05:30",
    "2024-01-01 10:00:00+00:00",
    "2024-01-01T00:00:00",
    "2024-01-01",
    "",
    "garbage",
    "2024-13-01T00:00:00Z",
]


def test_parse_iso_utc(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "i int, s string")
    got = {r["i"]: r["t"] for r in df.select("i", parse_iso_utc(F.col("s")).alias("t")).collect()}
    for i, t in enumerate(TIMES):
        assert got[i] == model_ts(t), t


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from tessera.functions.json_values import python_float_text  # noqa: E402

FINITE = st.floats(min_value=-1e17, max_value=1e17, exclude_min=True, exclude_max=True, allow_nan=False)


@settings(max_examples=6, deadline=None)
@given(st.lists(FINITE, min_size=100, max_size=300))
def test_python_float_text_matches_repr(spark, xs):
    """Property: Spark-side float text equals Python's repr (|x| < 1e17; above
    that Java's %e double rounding can move the last digit — documented)."""
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, d double")
    got = {r["i"]: r["s"] for r in df.select("i", python_float_text(F.col("d")).alias("s")).collect()}
    assert [got[i] for i in range(len(xs))] == [repr(float(x)) for x in xs]


def iso_corpus():
    dates = ["2024-03-05", "20240305", "2024-W10-2", "2024-02-30", "2021-W53-1", "2020-W53-7"]
    seps = ["T", " ", "t", "_"]
    times = ["10", "10:07", "10:07:08", "10:07:08.1", "10:07:08.123456", "10:07:08.1234567", "100708", "1007",
             "10:07:08,5", "24:00:00", "10:07:60"]
    offs = ["Z", "z", "+09:00", "+0900", "+09", "-05:30:15", "-05:30:15.5", "+24:00", "", " +09:00", "UTC"]
    return [d + s + t + o for d in dates for s in seps for t in times for o in offs]


def test_parse_iso_utc_matches_fromisoformat_on_corpus(spark):
    corpus = iso_corpus()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "i int, s string")
    got = {r["i"]: r["t"] for r in df.select("i", parse_iso_utc(F.col("s")).alias("t")).collect()}
    bad = [(t, model_ts(t), got[i]) for i, t in enumerate(corpus) if got[i] != model_ts(t)]
    assert not bad, bad[:10]


def test_payload_text_control_characters(spark):
    """Control characters escape as json.dumps does (lower-case hex)."""
    import json as _json

    from tessera.functions.json_values import python_json_text

    payloads = [{"k": "tab\there", "e": "\x1f\x0b\x01", "n": "line\nbreak"}, {"plain": "x", "v": [1, {"a": None}]}]
    df = spark.createDataFrame([(_json.dumps({"payload": p}),) for p in payloads], "line string")
    got = [r[0] for r in df.select(python_json_text(F.get_json_object("line", "$.payload"))).collect()]
    assert got == [_json.dumps(p, ensure_ascii=False) for p in payloads]
