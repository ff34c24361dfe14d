"""Connected components of a link table by alternating star contraction.

Every round is two aggregations and two joins over the links; the smaller end
of a link always survives, so a component ends as a star around its smallest
node. No links, nodes or components reach the driver: a round reports one
checksum row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import stage


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node that it
    sees (itself included)."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.join(low, both["a"] == low["u"]).where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node (column a, the larger end) and its smaller neighbours are
    linked to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    hop = down.join(low, down["a"] == low["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hop.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b long) -> (node, root): root is the smallest node of the
    component; one row per node that has a link to another node.

    Null ends and self-links add nothing; repeated links count once; an empty
    table gives an empty result.
    """
    e = stage(links.select("a", "b").where("a <> b")
              .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                     F.bit_xor(F.xxhash64("b", "a"))).first()
        if mark == seen or mark[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = mark
        e = stage(_small_star(_large_star(e)), "links")
