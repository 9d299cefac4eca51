"""Reusable column tests (I15-I17) and the declared test table.

Each test returns rows `(model, column, test, failures)`:
  * not_null        — rows where the column is NULL
  * unique          — non-NULL values that occur more than once
  * accepted_values — distinct non-NULL values outside the list
All not_null / accepted_values tests of one model share one aggregate; each
unique test is one partially-aggregated `groupBy(column)`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import count_when
from tessera.schemas import EVENT_TYPES

# Declared column tests: (layer, model, column, test).
DECLARED_TESTS = [
    ("source", "silver_events", "event_id", "not_null"),
    ("source", "silver_events", "event_type", "not_null"),
    ("source", "silver_events", "event_type", "accepted_values"),
    ("source", "silver_events", "event_time", "not_null"),
    ("source", "silver_events", "dt", "not_null"),
    ("staging", "stg_silver_events", "event_id", "not_null"),
    ("staging", "stg_silver_events", "event_id", "unique"),
    ("staging", "stg_silver_events", "event_type", "not_null"),
    ("staging", "stg_silver_events", "event_type", "accepted_values"),
    ("staging", "stg_silver_events", "event_ts", "not_null"),
    ("staging", "stg_silver_events", "event_date", "not_null"),
    ("staging", "stg_silver_events", "dt", "not_null"),
    ("marts", "fct_daily_events", "event_date", "not_null"),
    ("marts", "fct_daily_events", "event_date", "unique"),
    ("marts", "fct_daily_events", "event_count", "not_null"),
    ("marts", "fct_daily_events", "unique_users", "not_null"),
    ("marts", "fct_daily_events", "unique_sessions", "not_null"),
    ("marts", "fct_daily_revenue", "event_date", "not_null"),
    ("marts", "fct_daily_revenue", "event_date", "unique"),
    ("marts", "fct_daily_revenue", "order_events", "not_null"),
    ("marts", "fct_daily_revenue", "paying_users", "not_null"),
    ("marts", "fct_daily_revenue", "gross_revenue", "not_null"),
    ("marts", "fct_daily_revenue", "refund_amount", "not_null"),
    ("marts", "fct_daily_revenue", "net_revenue", "not_null"),
    ("marts", "fct_daily_conversion", "event_date", "not_null"),
    ("marts", "fct_daily_conversion", "event_date", "unique"),
    ("marts", "fct_daily_conversion", "view_sessions", "not_null"),
    ("marts", "fct_daily_conversion", "purchase_sessions", "not_null"),
    ("marts", "fct_daily_conversion", "conversion_rate", "not_null"),
]
ACCEPTED_VALUES = {"event_type": EVENT_TYPES}


def _rows(model: str, column: str, test: str, failures) -> F.Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.lit(test).alias("test"),
        failures.cast("long").alias("failures"),
    )


def not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    """I15."""
    return run_tests(df, model, [(column, "not_null")])


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """I16."""
    return run_tests(df, model, [(column, "unique")])


def accepted_values(df: DataFrame, model: str, column: str, values: list) -> DataFrame:
    """I17."""
    return run_tests(df, model, [(column, "accepted_values")], {column: values})


def run_tests(
    df: DataFrame, model: str, tests: list[tuple[str, str]], accepted: dict[str, list] | None = None
) -> DataFrame:
    """Run column tests of one model; not_null / accepted_values in one scan."""
    accepted = {**ACCEPTED_VALUES, **(accepted or {})}
    single = [(c, t) for c, t in tests if t != "unique"]
    parts: list[DataFrame] = []
    if single:
        aggs = []
        for c, t in single:
            col = F.col(c)
            if t == "not_null":
                aggs.append(_rows(model, c, t, count_when(col.isNull())))
            elif t == "accepted_values":
                bad = F.when(col.isNotNull() & ~col.isin(accepted[c]), col.cast("string"))
                aggs.append(_rows(model, c, t, F.count_distinct(bad)))
            else:
                raise ValueError(f"unknown column test {t!r}")
        parts.append(df.agg(F.array(*aggs).alias("r")).select(F.inline("r")))
    for c, t in tests:
        if t == "unique":
            dup_keys = df.where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") > 1)
            parts.append(dup_keys.agg(_rows(model, c, t, F.count(F.lit(1))).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def declared_column_tests(models: dict[str, DataFrame], layers: tuple[str, ...] = ("source", "staging", "marts")) -> DataFrame:
    """All declared tests of the given layers over the supplied model DataFrames."""
    out = None
    for model in dict.fromkeys(m for layer, m, _, _ in DECLARED_TESTS if layer in layers):
        tests = [(c, t) for layer, m, c, t in DECLARED_TESTS if m == model and layer in layers]
        res = run_tests(models[model], model, tests)
        out = res if out is None else out.unionByName(res)
    return out


def row_counts(models: dict[str, DataFrame]) -> DataFrame:
    """`count(*)` of each model (one small aggregate per model)."""
    out = None
    for name, df in models.items():
        res = df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"))
        out = res if out is None else out.unionByName(res)
    return out
