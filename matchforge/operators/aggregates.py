"""Aggregations.

Every per-key selection (first-wins, latest, first-at-or-after, last) is an
aggregate (``min``/``max`` of a struct led by the ordering columns) rather than
a window, so a hot key is reduced map-side before the shuffle instead of
landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], largest: bool,
          value_cols: Sequence[str] | None = None) -> DataFrame:
    keys = list(keys)
    values = [c for c in (value_cols or df.columns) if c not in keys]
    # One struct, ordering columns first and then every other value column,
    # so min/max compares by the order and resolves ties the same way on every
    # run whatever the input order; the buffer holds a single copy of the row.
    fields = list(dict.fromkeys(list(order) + values))
    pick = F.max if largest else F.min
    picked = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in fields])).alias("_picked"))
    return picked.select(*keys, *[F.col("_picked")[c].alias(c) for c in values])


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (then by the other columns)."""
    return _pick(df, keys, order, largest=False)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           value_cols: Sequence[str] | None = None) -> DataFrame:
    """Top-1 per key: the largest by ``order``."""
    return _pick(df, keys, order, largest=True, value_cols=value_cols)


def first_at_or_after(df: DataFrame, keys: Sequence[str], ts: str, threshold: int,
                      order: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Per key, the first row (by ``order``) whose ``ts >= threshold``."""
    return _pick(df.filter(F.col(ts) >= threshold), keys, order, largest=False,
                 value_cols=value_cols)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate keys (``kind='duplicate'``, with their row count) and rows
    with any null key part (one ``kind='null_key'`` row with the count)."""
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    dups = (df.filter(~any_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1)
            .select(F.lit("duplicate").alias("kind"), *keys, "n_rows"))
    nulls = (df.filter(any_null).agg(F.count(F.lit(1)).alias("n_rows"))
             .filter(F.col("n_rows") > 0)
             .select(F.lit("null_key").alias("kind"),
                     *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys],
                     "n_rows"))
    return dups.unionByName(nulls)


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a null in any of ``cols`` (not forgiven by an append)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def surrogate_key(df: DataFrame, order: Sequence[str], name: str = "serial_id",
                  start: int = 0, partitions: int | None = None) -> DataFrame:
    """Consecutive ids ``start+1, start+2, ...`` in the declared order, without
    a single-partition sort.

    Range-partition and sort by ``order``; number rows inside each partition
    (``monotonically_increasing_id`` carries the partition in its high bits
    and the row in its low 33 bits) and stage the numbered rows: the offsets and
    the ids are both computed from that one copy, whatever the optimizer makes
    of a repeated plan. Offsets come from a table with one row per partition
    (bounded by the partition count, so broadcasting it is safe). Partitions
    follow ``spark.sql.shuffle.partitions``, which is sized from the data.
    """
    from matchforge.staging import stage
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Sort on ``order`` and then every other column: the order is total, so a
    # value shared by many rows (a hot date) still spreads over several range
    # partitions, and a recomputed partition numbers its rows the same way.
    total = list(order) + [c for c in df.columns if c not in order]
    ordered = df.repartitionByRange(n, *total).sortWithinPartitions(*total)
    numbered = (ordered.withColumn("_mid", F.monotonically_increasing_id())
                .withColumns({"_part": F.shiftright("_mid", 33),
                              "_row": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))}))
    numbered = stage(numbered.drop("_mid"), "numbered")
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    out = numbered.join(F.broadcast(offsets), ["_part"], "inner")
    return out.select(
        (F.lit(start) + F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_row") + 1)
        .cast("long").alias(name),
        *df.columns)
