"""Joins: outer alignment of entity parts, enrichment, anti/orphan checks.

Broadcasts are only forced behind a row-count check with a bound (``limit(n+1)``
stops reading as soon as the bound is crossed); past the bound the join is left
to the planner (sort-merge, with AQE coalescing and skew splitting).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def row_width_estimate(df: DataFrame) -> int:
    """Rough bytes per row from the schema: 8 per fixed-width value, 32 per
    string, 128 per nested value (arrays, maps, structs)."""
    from pyspark.sql import types as T

    def width(dt) -> int:
        if isinstance(dt, (T.StringType, T.BinaryType)):
            return 32
        if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
            return 128
        return 8
    return max(8, sum(width(f.dataType) for f in df.schema.fields))


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than
    ``max_rows + 1`` of them."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its row count is proven to be small;
    the row budget shrinks with the estimated row width (``max_bytes``)."""
    budget = max(1, min(max_rows, max_bytes // row_width_estimate(df)))
    return F.broadcast(df) if row_count_at_most(df, budget) else df


def outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer equi-join; the key columns come out coalesced."""
    return left.join(right, list(keys), "full")


def outer_chain(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chain of full outer joins in the given order (the faithful form)."""
    out = parts[0]
    for p in parts[1:]:
        out = outer_join(out, p, keys)
    return out


def left_enrich(fact: DataFrame, dim: DataFrame, keys: Sequence[str],
                max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left outer join of a fact with a dimension, broadcasting the dimension
    when it is proven small."""
    return fact.join(sized_broadcast(dim, max_rows), list(keys), "left")


def inner_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed enrichment: rows without a match vanish (failed lookups)."""
    return rows.join(lookup, list(keys), "inner")


def absent_from(rows: DataFrame, target: DataFrame, keys: Sequence[str],
                small_rows: int | None = None) -> DataFrame:
    """Rows whose key is not in ``target`` (anti-join).

    With ``small_rows``, when ``rows`` is proven to have at most that many rows
    (an hourly batch against a table that keeps growing), the batch's keys are
    broadcast into a semi-join over the target: the target is scanned but never
    shuffled, and only the few keys it already has come back for the anti-join.
    """
    keys = list(keys)
    key_rows = rows.select(*keys)
    if small_rows is not None and row_count_at_most(
            key_rows, max(1, min(small_rows, DEFAULT_BROADCAST_BYTES // row_width_estimate(key_rows)))):
        probe = F.broadcast(key_rows.distinct())
        hits = target.select(*keys).join(probe, keys, "left_semi")
        return rows.join(hits, keys, "left_anti")
    return rows.join(target.select(*keys), keys, "left_anti")


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    parents = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(parents, [fk], "left_anti")
