"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import ISO_MILLIS_UTC

# ISO-8601 date-time with an explicit UTC offset, as Python's
# `datetime.fromisoformat` (3.11+) reads it: a calendar date (extended or
# basic) or an ISO week date (`2024-W10-2`, `2024W102`, `2024-W10`), any single
# non-digit separator, `HH[:MM[:SS[.fff]]]` (or basic `HHMM[SS]`), a `.`/`,`
# fraction of any length (6 digits kept), optionally one space, then `Z` or
# `±HH[[:]MM[[:]SS[.ffffff]]]`.  Fractional hours/minutes are not accepted.
ISO_WITH_OFFSET = (
    r"^(?:([0-9]{4})-?([0-9]{2})-?([0-9]{2})|([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?)[^0-9]"
    r"([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]*))?)?)?"
    r" ?(?:(Z)|([+-])([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]{1,6}))?)?)?)$"
)
_Y, _MO, _D, _WY, _WW, _WD = 1, 2, 3, 4, 5, 6
_H, _MI, _S, _FRAC = 7, 8, 9, 10
_ZULU, _SIGN, _OH, _OM, _OS, _OFRAC = 11, 12, 13, 14, 15, 16


# The common shapes, which Spark's own timestamp cast reads exactly: any fraction (it
# keeps 6 digits) and offsets below its limit of 18 hours, with or without a colon.
CANONICAL = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?"
    r"(Z|[+-](?:0[0-9]|1[0-7]):?[0-5][0-9])$"
)


def _groups(text: Column) -> Column:
    """All 16 capture groups from ONE regex evaluation (`;`-separated; groups
    that did not take part come out empty)."""
    return F.split(F.regexp_replace(text, ISO_WITH_OFFSET, ";".join(f"${i}" for i in range(1, 17))), ";")


def _part(g: Column, i: int) -> Column:
    return F.element_at(g, i)


def _num(g: Column, i: int, default: str = "0") -> Column:
    p = _part(g, i)
    return F.when(p == "", F.lit(default)).otherwise(p)


def _week_date(g: Column) -> Column:
    """Date of ISO week date (year, week, weekday); NULL when the week does not
    exist in that year (e.g. W53 of a 52-week year)."""
    year, week = _part(g, _WY).cast("int"), _part(g, _WW).cast("int")
    day = _num(g, _WD, "1").cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    iso_weekday = (F.dayofweek(jan4) + 5) % 7 + 1  # Monday = 1
    date = F.date_add(jan4, (week - 1) * 7 + (day - 1) - (iso_weekday - 1))
    return F.when((week >= 1) & (F.weekofyear(date) == week), date)


def _parse_general(text: Column) -> Column:
    """Any accepted (non-canonical) shape → UTC instant (microseconds kept)."""
    # Python reads a space before the offset unless a 0-5 digit fraction precedes it.
    ok = text.rlike(ISO_WITH_OFFSET) & ~text.rlike(r"[.,][0-9]{0,5} (Z|[+-][0-9])")
    g = _groups(text)
    day = F.when(
        _part(g, _Y) != "",
        F.concat(_part(g, _Y), F.lit("-"), _part(g, _MO), F.lit("-"), _part(g, _D)),
    ).otherwise(F.date_format(_week_date(g), "yyyy-MM-dd"))
    frac = F.rpad(F.substring(_part(g, _FRAC), 1, 6), 6, "0")
    local = F.concat(
        day, F.lit(" "), _part(g, _H), F.lit(":"), _num(g, _MI, "00"), F.lit(":"), _num(g, _S, "00"),
        F.lit("."), frac,
    )
    in_range = (_part(g, _H).cast("int") <= 23) & (_num(g, _MI).cast("int") <= 59) & (_num(g, _S).cast("int") <= 59)
    wall = F.when(in_range, F.try_to_timestamp(local, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))
    off_us = (
        _num(g, _OH).cast("long") * 3_600_000_000
        + _num(g, _OM).cast("long") * 60_000_000
        + _num(g, _OS).cast("long") * 1_000_000
        + F.rpad(_part(g, _OFRAC), 6, "0").try_cast("long")
    )
    off_us = F.when(_part(g, _ZULU) == "Z", F.lit(0).cast("long")).otherwise(
        F.when(_part(g, _SIGN) == "-", -off_us).otherwise(off_us)
    )
    valid_off = (
        (_num(g, _OM).cast("int") <= 59) & (_num(g, _OS).cast("int") <= 59) & (F.abs(off_us) < F.lit(86_400_000_000))
    )
    return F.when(ok & valid_off, F.timestamp_micros(F.unix_micros(wall) - off_us))


def parse_iso_fast(text: Column) -> Column:
    """The canonical shape (`2024-03-05T10:07:08.123Z`, `…+09:00`) through Spark's
    native parser, truncated to ms; NULL for every other shape."""
    return F.date_trunc("millisecond", F.when(text.rlike(CANONICAL), text.try_cast("timestamp")))


def non_canonical(text: Column) -> Column:
    """`text` when it needs the general parser, else NULL."""
    return F.when(~text.rlike(CANONICAL), text)


def parse_iso_general(text: Column) -> Column:
    """Any accepted shape → UTC instant truncated to ms, evaluated inside a
    one-element `transform`, so its large expression is not generated inline."""
    return F.date_trunc("millisecond", F.element_at(F.transform(F.array(text), _parse_general), 1))


def parse_iso_utc(text: Column) -> Column:
    """ISO-8601 text with an offset → UTC instant truncated to milliseconds.

    Text without an offset, empty text and unparseable or out-of-range text
    (month 13, Feb 30, hour 24, offset ≥ 24 h) give NULL.  The canonical shape
    goes through Spark's native parser; every other accepted shape through the
    general path.  (The Silver projection applies the two halves in separate
    stages: see `operators.silver`.)
    """
    return F.coalesce(parse_iso_fast(text), F.when(~text.rlike(CANONICAL), parse_iso_general(text)))


def utc_date(ts: Column) -> Column:
    """B17 `cast(ts as date)` — UTC because the session time zone is UTC."""
    return ts.cast("date")


def format_iso_millis_utc(ts: Column) -> Column:
    """`2024-01-05T07:08:09.123Z`."""
    return F.date_format(ts, ISO_MILLIS_UTC)
