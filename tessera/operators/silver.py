"""Raw → Silver.

One lazy plan: text scan → one JSON parse per line → the typed Silver
projection → first-seen dedup per (dt, event_id) → the rare times that need the
general parser.  The only shuffle is the dedup's, on (dt, event_id).

The projection takes a fast or a gated path per line.  The fast one reads all values
as text by one typed `from_json`, without a VARIANT.  Their text alone tells whether the
type-gated conversions B2-B4 could give anything else: a text that is neither a
fraction nor a boolean, nor wide, nor JSON, and a short integer, are the same whether
they were quoted or not.  The few keys where quotes matter are looked at in the line.
Any other line (and any that is not one whole JSON object) is parsed and converted
inside a one-element `transform`, so that these large expressions stay out of the generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.json_values import (
    bound,
    json_type,
    maybe_float_type,
    parse_json_line,
    python_float_text,
    python_json_text,
    variant_at,
    variant_to_int,
    variant_to_str,
)
from tessera.functions.metrics import count_when
from tessera.functions.time import non_canonical, parse_iso_fast, parse_iso_general
from tessera.operators.dedup import first_seen
from tessera.schemas import SILVER_FIELDS, SILVER_TABLE_COLUMNS
from tessera.sources.raw import landed_files, parse_raw_lines, read_raw_lines

_TIMES = ["event_time", "ingest_time"]
_PAYLOAD_KEY = {"search_query": "query"}
_PAYLOAD_COLUMNS = [
    "product_id", "category_id", "brand", "price", "quantity", "order_id", "total_amount",
    "payment_method", "coupon_id", "search_query", "results_count", "refund_amount", "reason_code",
]
#: Silver columns in nested objects, by the object's name and the key in it.
_NESTED = {
    "device_os": ("device", "os"),
    "device_os_version": ("device", "os_version"),
    "device_app_version": ("device", "app_version"),
    "geo_country": ("geo", "country"),
    "geo_region": ("geo", "region"),
    "geo_city": ("geo", "city"),
    "source_referrer": ("source", "referrer"),
    "source_utm_campaign": ("source", "utm_campaign"),
    "source_utm_medium": ("source", "utm_medium"),
    **{n: ("payload", _PAYLOAD_KEY.get(n, n)) for n in _PAYLOAD_COLUMNS},
}
_TYPES = {n: t.simpleString() for n, t, _ in SILVER_FIELDS}
_GROUPS = list(dict.fromkeys(g for g, _ in _NESTED.values()))
#: Silver columns read from values of the line (all but the payload's text), by place: (object or None, key).
_PLACES = {n: _NESTED.get(n, (None, n)) for n in _TYPES if n != "payload_json"}


def _is_int(name: str) -> bool:
    return _TYPES[name] in ("int", "bigint")


def _path(name: str) -> str:
    group, key = _PLACES[name]
    return f"$.{key}" if group is None else f"$.{group}.{key}"


#: Columns that take JSON strings only.
_EXACT_TEXT = ["event_id", *_TIMES]
_INTEGERS = [n for n in _PLACES if _is_int(n)]
_OTHER_TEXT = [n for n in _PLACES if not _is_int(n) and n not in _EXACT_TEXT]
# A key whose value is not of the type that it must have, or a quoted price (O5 counts them); or one that may be written with escapes.
# The class of first letters lets most quotes fail at once; the escapes have a pattern of their own, or each character would be tried for both.
GUARD = (
    rf'"(?=[{"".join(sorted({n[0] for n in (*_EXACT_TEXT, *_GROUPS, "price")}))}])'
    rf'(?:(?:{"|".join(_EXACT_TEXT)})"\s*+:\s*+(?!"|null)|(?:{"|".join(_GROUPS)})"\s*+:\s*+(?!\{{|null)|price"\s*+:\s*+")'
)
ESCAPED = r"\\u00[4-7]"
# Among texts, one a line: one that is written differently as a JSON value than as a string.
# A short fraction without a trailing zero (`13.3`, a version) is not: a float prints as it stands.
_SHORT_FRACTION = r"-?(?:0|[1-9][0-9]{0,9})\.(?:0|[0-9]{0,3}[1-9])$"
AMBIGUOUS_TEXT = (
    rf"(?m)^(?!{_SHORT_FRACTION})(?:-?+[0-9]++(?:\.[0-9]++(?:[eE][+-]?[0-9]++)?|[eE][+-]?[0-9]++)"
    r"|-?+[0-9]{19,}|-0|true|false|[{\[].*)$"
)
# Among integers' texts, one a line: one that is no short integer.
AMBIGUOUS_INTEGER = r"(?m)^(?!(?:0|-?[1-9][0-9]{0,14})?$)"
#: What the parser is given behind the line, to see that the line was one whole value; a line that holds it goes the long way.
_MARK = "7f3a9c51e2d84b60"


def _nested_struct(mark: Column, leaf) -> Column:
    """A struct shaped as `_text_struct`: `leaf` of each column, by place."""
    top = [leaf(n).alias(k) for n, (g, k) in _PLACES.items() if g is None]
    groups = [F.struct(*[leaf(n).alias(k) for n, (h, k) in _PLACES.items() if h == g]).alias(g) for g in _GROUPS]
    return F.struct(mark.alias("_mark"), *top, *groups)


def _text_struct() -> str:
    """The line's shape with every value as text, and the mark."""

    def fields(group):
        return ", ".join(f"{k}: string" for g, k in _PLACES.values() if g == group)

    return f"struct<_mark: string, {fields(None)}, {', '.join(f'{g}: struct<{fields(g)}>' for g in _GROUPS)}>"


def _two(line: Column) -> Column:
    """The line and the mark as an array of two; NULL if that is no JSON."""
    text = F.concat(F.lit("["), line, F.lit(f',{{"_mark":"{_MARK}"}}]'))
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    return F.from_json(F.when(F.is_valid_utf8(line) & line.startswith("{") & ~line.contains(_MARK), text), f"array<{_text_struct()}>", strict)


def _at(row: Column, name: str) -> Column:
    group, key = _PLACES[name]
    return row[key] if group is None else row[group][key]


def _unambiguous(line: Column, two: Column) -> Column:
    """Whether the line is one whole object whose values mean the same whatever their JSON types."""
    row = F.get(two, F.lit(0))
    whole = (F.size(two) == 2) & (F.get(two, F.lit(1))["_mark"] == _MARK) & row.isNotNull() & row["_mark"].isNull()
    texts = F.concat_ws("\n", *[_at(row, n) for n in _OTHER_TEXT])
    integers = F.concat_ws("\n", *[_at(row, n) for n in _INTEGERS])
    return F.coalesce(whole & ~line.rlike(GUARD) & ~(line.contains("\\u00") & line.rlike(ESCAPED)) & ~texts.rlike(AMBIGUOUS_TEXT) & ~integers.rlike(AMBIGUOUS_INTEGER), F.lit(False))


def valid_event_id(v) -> Column:
    """`event_id` must be a non-empty JSON string."""
    eid = variant_at(v, "$.event_id")
    return (json_type(eid) == "STRING") & (F.try_variant_get(eid, "$", "string") != "")


def _gated(line: Column, v: Column) -> Column:
    """B1-B4 for any line: a step through a non-object (`device: "x"`, `payload: []`) gives NULL (B1), which is the payload gate (B2) too.

    Columns of a kind are converted as one array, so that each conversion is in the plan once.
    """
    kinds = {
        "exact": (_EXACT_TEXT, lambda x: F.when(x["t"] == "STRING", F.try_variant_get(x["v"], "$", "string"))),
        "whole": (_INTEGERS, lambda x: variant_to_int(x["v"], "bigint", x["t"]).cast("string")),
        "texts": (_OTHER_TEXT, _any_text),
    }

    def value(name: str, token: bool) -> Column:
        found = variant_at(v, _path(name))
        # Integers wider than 64 bits share their VARIANT types with floats; the line's own token tells
        # them apart and keeps their digits, and only a line with that many digits has any.
        more = [F.when(line.rlike("[0-9]{19}"), F.get_json_object(line, _path(name))).alias("token")] if token else []
        return F.struct(found.alias("v"), json_type(found).alias("t"), *more)

    price = F.when(price_is_text(v), "text").alias("price")
    made = F.struct(price, *[F.transform(F.array(*[value(n, k == "texts") for n in names]), f).alias(k) for k, (names, f) in kinds.items()])
    place = {n: (k, i) for k, (names, _) in kinds.items() for i, n in enumerate(names)}
    return bound(made, lambda x: _nested_struct(x["price"], lambda n: F.get(x[place[n][0]], F.lit(place[n][1]))))


def _any_text(x: Column) -> Column:
    """B4 of a value `x.v` of type `x.t`, whose token is `x.token` where it may be a wide integer."""
    number = python_float_text(F.try_variant_get(x["v"], "$", "double"))
    wide = F.when(x["token"].rlike("^-?[0-9]+$"), x["token"]).otherwise(number)
    return F.when(maybe_float_type(x["t"]), wide).otherwise(variant_to_str(x["v"], x["t"], python_floats=False, is_float=F.lit(False)))


# The line's last value, a payload of plain values, none with a separator or an escape in it: only its separators need to change.
_PLAIN = r'"[^"\\,:]*+":\s?+(?:"[^"\\,:]*+"|-?+(?:0(?<!-0)|[1-9][0-9]*+)|null|true|false)'
PLAIN_PAYLOAD = rf'"payload":\s?+(\{{{_PLAIN}(?:,\s?+{_PLAIN})*+\}})\s*+\}}\s*+$'


def _payload_json(line: Column, plain: Column) -> Column:
    """The payload's JSON text as json.dumps writes it (key order kept, non-ASCII kept); NULL unless the payload is a non-empty object.

    `plain` is the payload's own text where `PLAIN_PAYLOAD` matches, else empty.
    """
    spaced = plain
    for mark in ",:":
        spaced = F.replace(F.replace(spaced, F.lit(mark + " "), F.lit(mark)), F.lit(mark), F.lit(mark + " "))
    general = bound(F.get_json_object(line, "$.payload"), lambda x: F.when(x.startswith("{") & (x != "{}"), python_json_text(x)))
    return F.when(plain != "", spaced).otherwise(general)


def extract_silver(parsed: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The fixed Silver projection of valid raw objects (+ `dt` and position, and whether the price is JSON text).

    Only the line itself is read.  Times that are not canonical are left as text
    (`_raw_event_time`, `_raw_ingest_time`) for `finish_silver`.
    """
    keep = ["dt", "_file", "_block", "_pos", *(carry or [])]
    line = F.col("line")

    # Each step is computed once a line: the optimizer copies no expression out of a generator.
    def step(df: DataFrame, *kept: str, **made: Column) -> DataFrame:
        return df.select(*keep, "line", *kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))

    told = step(parsed, _two=_two(line))
    told = step(told, "_two", _fast=_unambiguous(line, F.col("_two")))
    gated = bound(F.struct(line.alias("line"), parse_json_line(line).alias("v")), lambda x: _gated(x["line"], x["v"]))
    told = step(told, "_fast", _row=F.when(F.col("_fast"), F.get("_two", F.lit(0))).otherwise(gated), _plain=F.when(F.col("_fast"), F.regexp_extract(line, PLAIN_PAYLOAD, 1)))
    row = F.col("_row")
    told = told.where(row["event_id"] != "")
    cols = {n: parse_iso_fast(_at(row, n)) if n in _TIMES else _at(row, n).try_cast(_TYPES[n]) for n in _PLACES}
    cols["payload_json"] = _payload_json(line, F.coalesce(F.col("_plain"), F.lit("")))
    side = [non_canonical(_at(row, n)).alias(f"_raw_{n}") for n in _TIMES]
    price = (~F.col("_fast") & F.coalesce(row["_mark"] == "text", F.lit(False))).alias("_price_text")
    return told.select(*[cols[n].alias(n) for n, _, _ in SILVER_FIELDS], *side, price, *keep)


def finished_time(name: str) -> Column:
    """A time column, with the general parser applied where its text is not canonical."""
    raw = F.col(f"_raw_{name}")
    return F.when(raw.isNull(), F.col(name)).otherwise(parse_iso_general(raw))


def finish_silver(rows: DataFrame) -> DataFrame:
    """Times in non-canonical ISO shapes, read after the dedup window, on one row per event."""
    return rows.select(*[(finished_time(n) if n in _TIMES else F.col(n)).alias(n) for n in SILVER_TABLE_COLUMNS])


def dedup_silver(rows: DataFrame) -> DataFrame:
    """H1: first-seen row per (dt, event_id) in (file, split, line) order, then
    the finishing conversions on the surviving rows."""
    return finish_silver(first_seen(rows, ["dt", "event_id"], ["_file", "_block", "_pos"]))


def raw_to_silver(
    spark: SparkSession, raw_root: str, dates: list[str] | None = None, glob: str = "*.jsonl"
) -> DataFrame:
    """A1 + B8 + H1: Silver rows (30 columns + `dt`) of the requested partitions."""
    parsed = parse_raw_lines(read_raw_lines(spark, raw_root, dates, glob))
    return dedup_silver(extract_silver(parsed))


def raw_to_silver_observed(
    spark: SparkSession, raw_root: str, dates: list[str] | None = None, glob: str = "*.jsonl"
) -> tuple[DataFrame, Observation]:
    """A1 + A2 + B8 + H1 in ONE pass: the Silver rows, plus an Observation that
    is filled with the raw counters (`raw_lines`, `json_parse_errors`,
    `invalid_event_id`, `valid_rows`, over all requested days) by whichever
    action consumes the rows — typically the Silver write."""
    seen = Observation("raw_ingest_counters")
    parsed = parse_raw_lines(read_raw_lines(spark, raw_root, dates, glob))
    v, obj = F.col("_v"), F.col("_object")
    valid = obj & valid_event_id(v)
    parsed = parsed.observe(
        seen,
        count_when(obj).alias("raw_lines"),
        count_when(F.col("_bad")).alias("json_parse_errors"),
        count_when(obj & ~valid).alias("invalid_event_id"),
        count_when(valid).alias("valid_rows"),
    )
    return dedup_silver(extract_silver(parsed)), seen


def line_kinds(parsed: DataFrame) -> DataFrame:
    """A2 per line: `dt`, whether it is an object, bad, valid or an object without a valid id, whether its price is
    text (O5), and its id (NULL unless valid).  Each is derived once a line."""
    v = F.col("_v")
    valid = F.col("_object") & valid_event_id(v)
    told = parsed.select("dt", F.col("_object").alias("object"), F.col("_bad").alias("bad"), F.coalesce(valid, F.lit(False)).alias("valid"), price_is_text(v).alias("price_text"),
                         F.try_variant_get(variant_at(v, "$.event_id"), "$", "string").alias("_id"))
    return told.select("dt", "object", "bad", "valid", (F.col("valid") & F.col("price_text")).alias("price_text"), F.when(F.col("valid"), F.col("_id")).alias("event_id"))


def price_is_text(v) -> F.Column:
    """The payload's price is a JSON string.  A payload that is no object, or empty, has no price."""
    return F.coalesce(json_type(variant_at(v, "$.payload.price")) == "STRING", F.lit(False))


def ingest_stats(spark: SparkSession, raw_root: str, dates: list[str] | None = None, glob: str = "*.jsonl",
                 silver: DataFrame | None = None) -> DataFrame:
    """A2 + H2 per `dt`: files, raw_lines, json_parse_errors, invalid_event_id,
    valid_rows, rows (after dedup), dedup_skipped, price_as_text.

    Two levels: the lines are first reduced, map-side, to one row per (dt, id)
    that carries their counts, then to days; the number of ids of a day is its
    number of such rows.  No line is expanded for a distinct count.  Files are
    counted from their listing, so no path goes through a shuffle, and a day whose
    files are empty has a row.  Pass the written Silver to count what was
    actually written; then the ids are not looked at, and one level is left.
    """
    kinds = line_kinds(parse_raw_lines(read_raw_lines(spark, raw_root, dates, glob)))
    counts = {
        "raw_lines": F.col("object"),
        "json_parse_errors": F.col("bad"),
        "invalid_event_id": F.col("object") & ~F.col("valid"),
        "valid_rows": F.col("valid"),
        "price_as_text": F.col("price_text"),
    }
    if silver is None:
        per_id = kinds.groupBy("dt", "event_id").agg(*[count_when(c).alias(n) for n, c in counts.items()])
        raw = per_id.groupBy("dt").agg(*[F.sum(n).alias(n) for n in counts], F.count("event_id").alias("rows"))
    else:
        raw = kinds.groupBy("dt").agg(*[count_when(c).alias(n) for n, c in counts.items()])
        raw = raw.join(silver.groupBy("dt").agg(F.count(F.lit(1)).alias("rows")), "dt", "left")
    out = landed_files(spark, raw_root, dates, glob).join(raw, "dt", "left").fillna(0, [*counts, "rows"])
    return (
        out.withColumn("dedup_skipped", F.col("valid_rows") - F.col("rows"))
        .select("dt", "files", "raw_lines", "json_parse_errors", "invalid_event_id", "valid_rows", "rows",
                "dedup_skipped", "price_as_text")
    )


def first_copies(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """H1 with the number of copies: per valid (dt, event_id) the named Silver columns of its first-seen line,
    `copies`, and `price_texts` among them (O5).

    One aggregate over one parse.  Copies meet as (position, columns), reduced map-side, so an id
    that holds a large share of the lines ships one row a task.
    """
    rows = extract_silver(parsed)
    times = [c for c in ("event_time", "ingest_time") if c in columns]
    wide = F.struct(*columns, *[f"_raw_{c}" for c in times])
    one = rows.groupBy("dt", "event_id").agg(
        F.min_by(wide, F.struct("_file", "_block", "_pos")).alias("w"),
        F.count(F.lit(1)).alias("copies"),
        count_when(F.col("_price_text")).alias("price_texts"),
    )
    one = one.select("dt", "event_id", "w.*", "copies", "price_texts")
    return one.select("dt", *[(finished_time(c) if c in times else F.col(c)).alias(c) for c in columns], "copies", "price_texts")
