"""Flat-file and table sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, every column read as text (no inference pass).

    With ``columns`` the schema is declared up front (all strings), so no job
    runs to read the header; otherwise the header names the columns.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", False).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A stored table, with the catalog's declared column order and types
    (an empty table reads fine)."""
    return spark.table(f"{schema}.{table}")


def literal_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small literal dimension with a declared schema."""
    return spark.createDataFrame(list(rows), ddl)
