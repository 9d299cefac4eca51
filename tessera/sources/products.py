"""Product dimension (A10): a JSON array of product objects, read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.schemas import PRODUCT_SCHEMA


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """A10: `[{"product_id": ..., ...}, ...]` → typed rows (no schema inference)."""
    return spark.read.option("multiLine", True).schema(PRODUCT_SCHEMA).json(path).select(*PRODUCT_SCHEMA.names)
