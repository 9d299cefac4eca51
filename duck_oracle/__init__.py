"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from duck_oracle.sql import ORACLE_SQL  # noqa: F401
