"""Shards by vector bin packing.

Documents with equal text are one group with a vector (bytes, tokens, rows). A
group goes to the shard where the dot product of its vector with the shard's
residual capacity is highest, groups in descending size.

Three sizes of groups, so that nothing grows in one task or on the driver:

* A group above ``SPLIT_SHARE`` of a shard in any dimension is cut by document
  id into parts (a group of copies may hold a third of all rows, which no shard
  could take). There are at most dimensions * shards / SPLIT_SHARE of them.
* Groups above a ``shards * FINE``-th of the total in any dimension are *large*:
  at most dimensions * shards * FINE, a bound that does not depend on the data.
  They are packed first, on the driver.
* All others are packed in cells of about ``CELL`` groups, one task group each,
  against the capacity that the large ones left, every cell taking its share of
  it. A cell's error is about its smallest groups, so the shards end near equal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import id_text, ship, shuffle_parts, stage

DIMENSIONS = ["bytes", "tokens", "rows"]
#: The dimension that the law is about counts most.
WEIGHTS = np.array([4.0, 1.0, 1.0])
SPLIT_SHARE = 0.25
FINE = 256
CELL = 1_000
WORD = r"[^\x20\x09-\x0D]+"


def pack(vectors: np.ndarray, residual: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Shard of each vector. ``residual`` (shards, dimensions) is what each
    shard may still take; it is used up. Dimensions count by their share of
    ``totals`` and their weight; of equal products the lowest shard wins."""
    scale = np.where(totals > 0, totals, 1)
    v, r = vectors / scale, residual / scale
    out = np.zeros(len(v), dtype=np.int32)
    for i in np.argsort(-v.max(axis=1, initial=0), kind="stable"):
        s = int(np.argmax(r @ (WEIGHTS * v[i])))
        out[i] = s
        r[s] -= v[i]
    residual[:] = r * scale
    return out


def _pack_cells(share: np.ndarray):
    """``share`` (shards, dimensions): of a cell's total, what each shard is to
    get."""
    def run(key, groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values(["h", "crc", "size", "part"], kind="stable")
        v = groups[DIMENSIONS].to_numpy(dtype=float)
        total = v.sum(axis=0)
        turn = int(key[0]) % len(share)  # another shard leads in each cell
        order = np.r_[turn:len(share), 0:turn]
        shard = order[pack(v, (share * total)[order], total)]
        return groups[["h", "crc", "size", "part"]].assign(cell=key[0], shard=shard.astype("int32"))
    return run


def shards_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row
    under the law ``bytes``.

    size is the UTF-8 length of the text plus 1; tokens are white-space
    separated words. Null text counts as empty (size 1, crc 0). slot numbers a
    shard's rows without gaps from 0. Equal texts share a shard unless their
    group is above ``SPLIT_SHARE`` of a shard. Null ids and repeated rows get
    slots like any other (ties in the order are broken arbitrarily among equal
    ids of a group); an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    txt = F.coalesce(F.col("txt"), F.lit(""))
    rows = stage(id_text(docs, id_col, text_col).select(
        "id", F.xxhash64(txt).alias("h"), F.crc32(txt).alias("crc"), (F.octet_length(txt) + 1).cast("long").alias("size"),
        F.regexp_count(txt, F.lit(WORD)).cast("long").alias("tokens")), "shard-rows")
    key = ["h", "crc", "size"]
    groups = rows.groupBy(*key).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = stage(groups, "shard-groups")
    head = groups.agg(*(F.sum(d).alias(d) for d in DIMENSIONS), F.count("*").alias("n")).first()
    totals = np.array([float(head[d] or 0) for d in DIMENSIONS])
    n_cells = max(1, head["n"] // CELL)
    over = lambda share: F.greatest(*(F.col(d) / F.lit(max(t, 1.0)) for d, t in zip(DIMENSIONS, totals))) > F.lit(share)
    huge_at, large_at = SPLIT_SHARE / shards, 1 / (shards * FINE)
    # Parts of the groups that no shard could take whole: at most 1 / huge_at per dimension.
    huge = groups.where(over(huge_at)).withColumn("parts", F.ceil(F.greatest(
        *(F.col(d) / F.lit(max(t, 1.0) * large_at) for d, t in zip(DIMENSIONS, totals)))).cast("int"))
    huge = stage(huge.select(*key, "parts"), "shard-huge")
    part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)).cast("int")
    parted = rows.join(F.broadcast(huge), key).withColumn("part", part).groupBy(*key, "part").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    large = groups.where(over(large_at) & ~over(huge_at)).withColumn("part", F.lit(0)).select(*key, "part", *DIMENSIONS)
    units = large.unionByName(parted.select(*key, "part", *DIMENSIONS)).toPandas().sort_values([*key, "part"], kind="stable")
    residual = np.tile(totals / shards, (shards, 1))
    vectors = units[DIMENSIONS].to_numpy(dtype=float)
    placed = units[[*key, "part"]].assign(shard=pack(vectors, residual, totals) if len(units) else np.zeros(0, dtype=np.int32))
    left = np.maximum(residual, 0)
    share = np.where(left.sum(axis=0) > 0, left / np.where(left.sum(axis=0) > 0, left.sum(axis=0), 1), 1 / shards)
    whole = "h long, crc long, size long, part int, shard int"
    fixed = spark.createDataFrame([tuple(map(int, r)) for r in placed.itertuples(index=False)], whole)
    cell = F.pmod(F.xxhash64("h", "crc"), F.lit(n_cells)).cast("int")
    small = groups.where(~over(large_at)).withColumn("part", F.lit(0)).withColumn("cell", cell)
    packed = small.groupBy("cell").applyInPandas(
        _pack_cells(share), "h long, crc long, size long, part int, cell int, shard int")
    where = stage(packed.drop("part"), "shard-cells")
    # Rows of large groups are numbered in cells of their own choice, so no cell is theirs alone.
    own = F.pmod(F.xxhash64("id", "h"), F.lit(n_cells)).cast("int")
    with_part = rows.join(F.broadcast(huge), key, "left").withColumn("part", F.coalesce(part, F.lit(0)))
    of_large = with_part.join(F.broadcast(fixed), [*key, "part"]).withColumn("cell", own)
    of_small = rows.join(F.broadcast(fixed.select(*key).distinct()), key, "left_anti").join(where, key)
    cols = ["id", "size", "crc", "cell", "shard"]
    placed_rows = stage(of_large.select(*cols).unionByName(of_small.select(*cols)), "shard-placed")
    count = placed_rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = count.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("id")) - 1
    out = placed_rows.withColumn("inner", inner).join(offset, ["shard", "cell"])
    return out.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("inner")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
