"""Readers: CSV interchange, parquet, stored tables, landed JSON/HTML documents."""
