"""Raw JSON lines → Silver: malformed-line policy, typing, first-seen dedup."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.silver import ingest_stats, raw_to_silver
from tessera.schemas import SILVER_TABLE_COLUMNS
from tessera.sources.raw import RawPartitionMissing
from tessera.sources.silver import read_silver_files, write_silver_files


def ev(eid, **kw):
    base = {
        "event_id": eid,
        "schema_version": 1,
        "event_type": "purchase",
        "event_time": "2024-03-01T10:00:00.123Z",
        "ingest_time": "2024-03-01T10:00:05Z",
        "user_id": "U1",
        "session_id": "S1",
        "device": {"os": "ios", "app_version": "1.2.3"},
        "geo": {"country": "KR", "region": "Seoul", "city": "Seoul"},
        "source": {"referrer": "ad", "utm_campaign": "none", "utm_medium": "cpc"},
        "payload": {"product_id": "P1", "price": 100, "quantity": 2, "order_id": "O1", "total_amount": 200},
    }
    base.update(kw)
    return json.dumps(base, ensure_ascii=False)


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    day = root / "dt=2024-03-01"
    day.mkdir()
    (day / "a.jsonl").write_text(
        "\n".join(
            [
                ev("e1"),
                "",
                "not json",
                "[1,2]",
                ev(5),  # numeric id: counted, dropped
                ev("e2", payload={}),
                ev("e3", event_time="2024-03-01T10:00:00"),  # no offset → NULL
                ev("e4", schema_version=True),
                ev("e5", payload={"brand": {"x": 1}, "price": " 1e3 ", "quantity": 2.9}),
                '{"event_id":"e6","event_type":"view","event_type":"search","payload":{"query":"q"}}',
                ev("e7", user_id=12, session_id=None, payload={"price": "12f", "brand": True}),
                ev("e8", event_time="2024-03-01T19:00:00+09:00", payload={"query": "한글"}),
                ev(""),
            ]
        )
        + "\n"
    )
    (day / "b.jsonl").write_text(ev("e1", ingest_time="2024-03-02T00:10:00Z", user_id="LATER") + "\n")
    (day / "ignored.txt").write_text(ev("zz") + "\n")
    empty = root / "dt=2024-03-02"
    empty.mkdir()
    (empty / "c.jsonl").write_text("\n")
    return str(root)


@pytest.fixture(scope="module")
def silver_rows(spark, raw_root):
    df = raw_to_silver(spark, raw_root, ["2024-03-01"])
    assert df.columns == SILVER_TABLE_COLUMNS
    return {r["event_id"]: r for r in df.collect()}


def test_row_set(silver_rows):
    assert sorted(silver_rows) == ["e1", "e2", "e3", "e4", "e5", "e6", "e7", "e8"]


def test_first_seen_wins(silver_rows):
    assert silver_rows["e1"]["user_id"] == "U1"  # a.jsonl sorts before b.jsonl


def test_payload_gate(silver_rows):
    r = silver_rows["e2"]
    assert r["product_id"] is None and r["price"] is None and r["payload_json"] is None


def test_type_policy(silver_rows):
    assert silver_rows["e3"]["event_time"] is None
    assert silver_rows["e4"]["schema_version"] is None
    assert silver_rows["e5"]["brand"] is None and silver_rows["e5"]["price"] == 1000
    assert silver_rows["e5"]["quantity"] == 2
    assert json.loads(silver_rows["e5"]["payload_json"])["brand"] == {"x": 1}
    assert silver_rows["e6"]["event_type"] == "search"  # duplicate key: last wins
    assert silver_rows["e6"]["search_query"] == "q"
    assert silver_rows["e7"]["user_id"] == "12" and silver_rows["e7"]["session_id"] is None
    assert silver_rows["e7"]["price"] is None and silver_rows["e7"]["brand"] == "True"
    assert str(silver_rows["e8"]["event_time"]) == "2024-03-01 10:00:00"
    assert silver_rows["e8"]["search_query"] == "한글"
    assert str(silver_rows["e1"]["event_time"]) == "2024-03-01 10:00:00.123000"


def test_stats(spark, raw_root):
    s = ingest_stats(spark, raw_root, ["2024-03-01", "2024-03-02"]).orderBy("dt").collect()
    a = s[0].asDict()
    assert a == {
        "dt": "2024-03-01", "files": 2, "raw_lines": 11, "json_parse_errors": 1, "invalid_event_id": 2,
        "valid_rows": 9, "rows": 8, "dedup_skipped": 1, "price_as_text": 2,
    }
    assert s[1]["raw_lines"] == 0 and s[1]["rows"] == 0


def test_missing_partition(spark, raw_root):
    with pytest.raises(RawPartitionMissing):
        raw_to_silver(spark, raw_root, ["2030-01-01"])


def test_silver_files_rerun_clears_day(spark, raw_root, tmp_path):
    out = str(tmp_path / "silver")
    df = raw_to_silver(spark, raw_root, ["2024-03-01"])
    write_silver_files(df, out, ["2024-03-01"], rows_per_file=3)
    files = [f for f in os.listdir(os.path.join(out, "dt=2024-03-01")) if f.endswith(".parquet")]
    assert len(files) >= 3  # ≤ 3 rows per file
    assert read_silver_files(spark, out).count() == 8
    write_silver_files(df, out, ["2024-03-01"])  # rerun: same content
    assert read_silver_files(spark, out).count() == 8
    from tessera.sources.silver import silver_write_summary

    summary = silver_write_summary(spark, out, ingest_stats(spark, raw_root, ["2024-03-01"]), ["2024-03-01"]).first()
    assert (summary["rows"], summary["raw_lines"], summary["dedup_skipped"], summary["json_parse_errors"]) == (
        8, 11, 1, 1)
    assert summary["parts"] >= 1
    write_silver_files(df.where(F.lit(False)), out, ["2024-03-01"])  # day now empty → stale rows gone
    assert read_silver_files(spark, out, ["2024-03-01"]).count() == 0


def test_payload_json_is_json_dumps_text(silver_rows):
    """payload_json is byte-equal to json.dumps(payload, ensure_ascii=False)."""
    assert silver_rows["e5"]["payload_json"] == json.dumps(
        {"brand": {"x": 1}, "price": " 1e3 ", "quantity": 2.9}, ensure_ascii=False
    )
    assert silver_rows["e8"]["payload_json"] == json.dumps({"query": "한글"}, ensure_ascii=False)
    assert silver_rows["e1"]["payload_json"] == json.dumps(
        {"product_id": "P1", "price": 100, "quantity": 2, "order_id": "O1", "total_amount": 200}
    )


def test_rare_shapes_through_the_full_path(spark, tmp_path):
    """Floats in text columns and non-canonical ISO times take the finishing
    step after dedup; values must equal Python's str()/fromisoformat()."""
    import datetime as _dt

    day = tmp_path / "raw" / "dt=2024-03-01"
    day.mkdir(parents=True)
    lines = [
        ev("f1", user_id=1.5e-05, session_id=12345678.9,
           payload={"brand": 1e23, "product_id": 0.1, "price": 5, "order_id": 1000.0, "coupon_id": 5,
                    "category_id": 123456789012345678901234567890, "payment_method": 2.50}),
        ev("f2", event_time="2024-03-01T10:07+09:00", ingest_time="20240301T100000Z"),
        ev("f3", event_time="2024-W09-5T10:00:00.5+09:00", ingest_time="2024-03-01 10:00:00,25-05:30"),
    ]
    (day / "a.jsonl").write_text("\n".join(lines) + "\n")
    rows = {r["event_id"]: r for r in raw_to_silver(spark, str(tmp_path / "raw")).collect()}
    f1 = rows["f1"]
    assert (f1["user_id"], f1["session_id"], f1["brand"], f1["product_id"]) == (
        str(1.5e-05), str(12345678.9), str(1e23), str(0.1))
    assert (f1["order_id"], f1["coupon_id"], f1["category_id"], f1["payment_method"]) == (
        "1000.0", "5", "123456789012345678901234567890", "2.5")
    assert rows["f2"]["event_time"] == _dt.datetime(2024, 3, 1, 1, 7)
    assert rows["f2"]["ingest_time"] == _dt.datetime(2024, 3, 1, 10, 0)
    assert rows["f3"]["event_time"] == _dt.datetime(2024, 3, 1, 1, 0, 0, 500000)
    assert rows["f3"]["ingest_time"] == _dt.datetime(2024, 3, 1, 15, 30, 0, 250000)


def test_space_after_short_fraction_is_rejected(spark):
    """Python rejects `.5 +09:00` (short fraction, then a space); so do we."""
    from tessera.functions.time import parse_iso_utc

    df = spark.createDataFrame([("2024-03-01T10:00:00.5 +09:00",), ("2024-03-01T10:00:00.500000 +09:00",)], "s string")
    got = [r[0] for r in df.select(parse_iso_utc(F.col("s"))).collect()]
    assert got[0] is None and str(got[1]) == "2024-03-01 01:00:00.500000"


def test_observed_single_pass_counters(spark, raw_root, tmp_path):
    """A2 counters observed during the Silver write equal the separate aggregate."""
    from tessera.operators.silver import raw_to_silver_observed

    silver, counters = raw_to_silver_observed(spark, raw_root, ["2024-03-01"])
    written = write_silver_files(silver, str(tmp_path / "s"), ["2024-03-01"])
    c = counters.get
    assert written == {"days": ["2024-03-01"], "rows": 8}
    assert (c["raw_lines"], c["json_parse_errors"], c["invalid_event_id"], c["valid_rows"]) == (11, 1, 2, 9)
    assert c["valid_rows"] - written["rows"] == 1  # dedup_skipped


def _land(root, day, lines, name="a.jsonl"):
    os.makedirs(os.path.join(root, f"dt={day}"), exist_ok=True)
    path = os.path.join(root, f"dt={day}", name)
    with open(path, "wb") as f:
        f.write(b"".join(x + b"\n" for x in lines))
    return path


def test_lines_that_are_not_one_json_value(spark, tmp_path):
    """Text after the value, two values, bytes that are no UTF-8 and brackets that would close a wrapper are all bad."""
    root = str(tmp_path / "raw")
    bad = [b'{"event_id":"x"} garbage', b'{"event_id":"x"}{"event_id":"y"}', b'{"event_id":"x"},{"event_id":"y"}',
           b'{"event_id":"x\xff"}', b'{"event_id":"x"}],[', b'{"event_id":"x"},1]', b"not json"]
    _land(root, "2024-03-01", [b'  {"event_id":"ok"} ', *bad])
    got = ingest_stats(spark, root, ["2024-03-01"]).first()
    assert (got["json_parse_errors"], got["raw_lines"], got["rows"]) == (len(bad), 1, 1)


def test_each_requested_day_needs_a_file(spark, tmp_path):
    root = str(tmp_path / "raw")
    _land(root, "2024-03-01", [b'{"event_id":"a"}'])
    _land(root, "2024-03-02", [b'{"event_id":"b"}'], name="b.csv")
    with pytest.raises(RawPartitionMissing, match="2024-03-02"):
        raw_to_silver(spark, root, ["2024-03-01", "2024-03-02"])
    assert raw_to_silver(spark, root, ["2024-03-01"]).count() == 1


def test_long_integers_keep_their_digits(spark, tmp_path):
    root = str(tmp_path / "raw")
    wide = {"a": "7" * 19, "b": "1234567890" * 4, "c": "-" + "9" * 45, "d": "1e20", "e": "100000000000000000000.0", "f": "12"}
    _land(root, "2024-03-01", [f'{{"event_id":"{k}","user_id":{v}}}'.encode() for k, v in wide.items()])
    got = {r["event_id"]: r["user_id"] for r in raw_to_silver(spark, root).collect()}
    assert got == {k: str(json.loads(v)) for k, v in wide.items()}


def test_file_names_sort_as_written(spark, tmp_path):
    """First seen goes by the names themselves, not by their URI form ('!' < '%20' as text, but ' ' < '!')."""
    root = str(tmp_path / "raw")
    _land(root, "2024-03-01", [b'{"event_id":"a","user_id":"second"}'], name="x!.jsonl")
    _land(root, "2024-03-01", [b'{"event_id":"a","user_id":"first"}'], name="x .jsonl")
    assert raw_to_silver(spark, root).first()["user_id"] == "first"


def test_events_of_one_split_become_lines_in_many_tasks(spark, events):
    """the scan's splits are whole row groups, too few tasks for the work of making lines."""
    from tessera.sources.fixtures import fx_raw_lines

    one = events.coalesce(1)
    plan = fx_raw_lines(one)._jdf.queryExecution().executedPlan().toString()
    tasks = 4 * spark.sparkContext.defaultParallelism
    assert f"RoundRobinPartitioning({tasks})" in plan
    # No event is lost or doubled: a line an event that has an id, a resend of every 200th.
    ids = [r.event_id for r in one.select("event_id").collect()]
    got = {r.batch: r["count"] for r in fx_raw_lines(one).where("line LIKE '%\"schema_version\"%'").groupBy("batch").count().collect()}
    assert got[0] >= len(ids) and got[1] == sum(i is not None and i % 200 == 0 for i in ids)


def test_guard_finds_escapes_and_wrong_types(spark):
    """The guard and the escapes' pattern together match what a plain search of the line finds."""
    from tessera.operators.silver import ESCAPED, GUARD

    lines = {
        '{"event_id": 5}': True, '{"event_id": "5", "price": 3}': False, '{"price" : "3"}': True, '{"device":"x"}': True, '{"device":null,"geo": {}}': False,
        r'{"\u0065vent_id":"x"}': True, r'{"a":"\u00e9"}': False, '{"payload":[]}': True, '{"source" :{}}': False, '{"ingest_time":7}': True, '{"event_time": null}': False,
    }
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.line: r.hit for r in df.select("line", (F.col("line").rlike(GUARD) | F.col("line").rlike(ESCAPED)).alias("hit")).collect()}
    assert got == lines
