"""Sinks: keyed merge into Parquet or JDBC tables, console."""
