"""Projections, casts and column surgery (select/alias, reorder, cast, drop,
rename, positional naming, keep-list)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.functions.scalar import int_from_text


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select ``old`` columns under ``new`` names, in the mapping's order.

    Downstream inserts are positional, so the order is part of the contract.
    """
    return df.select(*[F.col(old).alias(new) for new, old in mapping.items()])


def cast_int(df: DataFrame, cols: Iterable[str], from_text: bool = False) -> DataFrame:
    """Cast columns to int. ``from_text`` accepts float-looking text
    (``'599999.0'``), truncating, and turns unparsable text into null."""
    conv = int_from_text if from_text else (lambda c: F.col(c).cast("int"))
    return df.withColumns({c: conv(c) for c in cols})


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; an absent column is a no-op."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def name_positionally(df: DataFrame, *names: str) -> DataFrame:
    return df.toDF(*names)


def features_without(df: DataFrame, label: str) -> list[str]:
    """Feature column list: every column but the label."""
    return [c for c in df.columns if c != label]
