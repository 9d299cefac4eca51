"""Partition quality gate (D7-D9, I1-I14), driven by a table of rules.

A rule names what it measures over a day's rows: a condition that a bad row
meets, or a column whose values must differ.  All rules of the table are
compiled into ONE `groupBy("dt")` aggregate with a measure per rule, and then
into one array of verdicts per day, unpivoted with `inline` — no collect, any
number of days.  A new rule is one more line of the table.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import count_when
from tessera.schemas import EVENT_TYPES, ISO_SECONDS_UTC, RULE_SEVERITY, SCHEMA_VERSIONS, TIME_ORDER_MAX_RATIO


@dataclass(frozen=True)
class Rule:
    """`kind` says what is measured and what passes:

    - `filled`: the number of rows, which must be positive;
    - `none`: rows that meet `bad`, of which there must be none;
    - `unique`: rows too many for the column `bad` to be unique, NULL being one value (D8); there must be none;
    - `share`: the share of rows that meet `bad`, at most `bound`; 1.0 of an empty day (D9).
    """

    name: str
    kind: str
    bad: str = ""
    bound: float = 0.0

    def measure(self) -> Column:
        if self.kind == "unique":
            value = F.col(self.bad)
            return rows_counted() - F.count_distinct(value) - F.coalesce(F.max(F.when(value.isNull(), 1).otherwise(0)), F.lit(0))
        bad = count_when(F.expr(self.bad)) if self.bad else None
        return {"filled": rows_counted, "none": lambda: bad, "share": lambda: bad.cast("double") / rows_counted()}[self.kind]()

    def of_empty_day(self) -> float | int:
        return 1.0 if self.kind == "share" else 0

    def verdict(self) -> Column:
        """The rule's row of the report, from the column that holds its measure."""
        actual = F.col(self.name)
        passed, expected = (actual > 0, "> 0") if self.kind == "filled" else (actual <= self.bound, f"<= {self.bound}" if self.kind == "share" else "0")
        return F.struct(
            F.lit(self.name).alias("rule"),
            passed.alias("passed"),
            actual.cast("double").alias("actual"),
            F.lit(expected).alias("expected"),
            F.lit(RULE_SEVERITY).alias("severity"),
        )


def rows_counted() -> Column:
    return F.count(F.lit(1))


def _listed(column: str, values: list) -> str:
    """A bad row: `column` holds none of `values`."""
    among = ", ".join(repr(v) for v in values)
    return f"{column} IS NULL OR {column} NOT IN ({among})"


#: I1-I13, in report order.
RULES = [
    Rule("partition_not_empty", "filled"),
    Rule("event_id_unique", "unique", "event_id"),
    Rule("event_type_allowed", "none", _listed("event_type", EVENT_TYPES)),
    Rule("schema_version_allowed", "none", _listed("schema_version", SCHEMA_VERSIONS)),
    Rule("event_time_not_null", "none", "event_time IS NULL"),
    Rule("ingest_time_not_null", "none", "ingest_time IS NULL"),
    Rule("event_time_lte_ingest_time_ratio", "share", "event_time > ingest_time", TIME_ORDER_MAX_RATIO),
    Rule("price_non_negative", "none", "price < 0"),
    Rule("total_amount_non_negative", "none", "total_amount < 0"),
    Rule("refund_amount_non_negative", "none", "refund_amount < 0"),
    Rule("purchase_requires_order_id", "none", "event_type = 'purchase' AND order_id IS NULL"),
    Rule("search_requires_query", "none", "event_type = 'search' AND search_query IS NULL"),
    Rule("refund_requires_amount", "none", "event_type = 'refund' AND refund_amount IS NULL"),
]


def quality_metrics(silver: DataFrame, dates: list[str] | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """Per `dt` the number of rows (`row_count`) and the measure of every rule, under its name, in one aggregate.

    With `dates`, every requested day is reported, also one without rows.
    """
    df = silver if dates is None else silver.where(F.col("dt").isin(list(dates)))
    m = df.groupBy("dt").agg(rows_counted().alias("row_count"), *[r.measure().alias(r.name) for r in rules])
    if dates is None:
        return m
    requested = silver.sparkSession.createDataFrame([(d,) for d in dict.fromkeys(dates)], "dt string")
    return requested.join(m, "dt", "left").fillna({"row_count": 0, **{r.name: r.of_empty_day() for r in rules}})


def _verdicts(rules: list[Rule]) -> Column:
    return F.array(*[r.verdict() for r in rules])


def quality_rules(metrics: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per (dt, rule): passed, actual, expected, severity."""
    return metrics.select("dt", F.inline(_verdicts(rules)))


def quality_gate(metrics: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """I14 verdict per day: row count, rules checked/passed, `all_passed`.

    Evaluated on the rule array of each day's metric row — no extra shuffle."""
    verdicts = _verdicts(rules)
    passed = F.filter(verdicts, lambda r: r["passed"])
    return metrics.select(
        "dt",
        "row_count",
        F.size(verdicts).alias("rules_checked"),
        F.size(passed).alias("rules_passed"),
        (F.size(passed) == F.size(verdicts)).alias("all_passed"),
    )


def quality_report(metrics: DataFrame, table: str, checked_at: _dt.datetime | None = None) -> DataFrame:
    """I14 report document per day as JSON text:
    `{table, date, checked_at, row_count, all_passed, rules: [...]}`."""
    when = checked_at or _dt.datetime.now(_dt.timezone.utc)
    checked = F.date_format(F.lit(when.astimezone(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp"), ISO_SECONDS_UTC)
    rules = _verdicts(RULES)
    doc = F.struct(
        F.lit(table).alias("table"),
        F.col("dt").alias("date"),
        checked.alias("checked_at"),
        "row_count",
        (F.size(F.filter(rules, lambda r: r["passed"])) == F.size(rules)).alias("all_passed"),
        rules.alias("rules"),
    )
    return metrics.select("dt", F.to_json(doc).alias("report"))


def write_quality_report(report: DataFrame, path: str) -> None:
    """One small text document per run, overwritten (reports are one row per day)."""
    report.select("report").coalesce(1).write.mode("overwrite").text(path)


def record_quality_results(
    metrics: DataFrame, table: str, checked_at: _dt.datetime | None = None, source_table: str | None = None
) -> None:
    """Append one row per (dt, rule) with the check time to a results table,
    so gate outcomes accumulate across runs (one small row per rule and day)."""
    when = (checked_at or _dt.datetime.now(_dt.timezone.utc)).astimezone(_dt.timezone.utc).replace(tzinfo=None)
    rows = quality_rules(metrics).select(
        F.lit(source_table).cast("string").alias("table"),
        "dt", "rule", "passed", "actual", "expected", "severity",
        F.lit(when).cast("timestamp").alias("checked_at"),
    )
    rows.write.mode("append").saveAsTable(table)


def gate_passed(metrics: DataFrame) -> bool:
    """Gate verdict for the caller's exit code (one tiny collect: one row per day)."""
    failed = quality_rules(metrics).where(~F.col("passed")).limit(1).count()
    return failed == 0
