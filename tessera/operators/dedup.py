"""First-seen deduplication (H1, H2, G1).

`row_number() = 1` over `(keys)` ordered by physical position.  Spark plans it
with a partial `WindowGroupLimit` before the shuffle, so a key that holds a
large share of the rows is cut to one candidate per map partition before it
is shuffled — a hot key never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Keep, per key, the row that comes first in `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def parquet_position(df: DataFrame) -> DataFrame:
    """Physical position of Parquet rows: `(file, row index within file)`."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """G1: keys that occur more than once (empty when unique)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)
