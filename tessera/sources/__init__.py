"""Scans and sinks: raw JSON lines, Silver Parquet, partitioned tables, products."""
