"""Metric building blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_when(cond: Column) -> Column:
    """Number of rows where `cond` holds (NULL counts as false); 0 on no rows."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("long")


def sum_when(cond: Column, value: Column) -> Column:
    """B19 `sum(case when cond then value else 0 end)`."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def null_guarded_ratio(num: Column, den: Column) -> Column:
    """B14 (Gold): num/den when den > 0, else NULL."""
    return F.when(den > 0, num.cast("double") / den)


def zero_guarded_ratio(num: Column, den: Column) -> Column:
    """B15 (marts): 0.0 when den = 0, else num/den."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)
