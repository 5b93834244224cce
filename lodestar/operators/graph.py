"""Item relation graph (survey G5): who is bought with whom.

An edge joins two items of one basket; its weight is the number of baskets that
hold both. Edges are expanded from each basket's item array, so a row meets
only rows of its own basket, and weights are combined map-side. A basket of up
to ``tile`` items is one array; a larger one is cut into tiles of about that
size, and each pair of its tiles is a row with a join key of its own, so the
pairs of one very large basket are spread like those of many small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pairs(a, b, same):
    """Ordered item pairs (src < dst) of two arrays; within one array each
    pair is met twice and kept once."""
    cross = F.flatten(F.transform(a, lambda x: F.transform(
        b, lambda y: F.struct(F.least(x, y).alias("src"), F.greatest(x, y).alias("dst"), (x < y).alias("up")))))
    return F.filter(cross, lambda p: (p["src"] != p["dst"]) & (~same | p["up"]))


def item_edges(lines: DataFrame, basket: str, item: str, tile: int = 32) -> DataFrame:
    """(src, dst, weight), src < dst: in how many baskets both items occur.
    Repeated lines count once; null items and baskets do not count."""
    x = lines.select(F.col(basket).alias("_k"), F.col(item).alias("_i")).where(
        "_k is not null and _i is not null").distinct()
    sizes = x.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > tile)
    small = x.join(large.select("_k"), "_k", "left_anti").groupBy("_k").agg(
        F.collect_list("_i").alias("_a"))
    within = small.where(F.size("_a") > 1).select(
        F.explode(_pairs(F.col("_a"), F.col("_a"), F.lit(True))).alias("p"))
    # tile pairs (t <= u) are join keys of their own: one basket, many tasks
    tiles = F.ceil(F.col("_n") / tile)
    cut = x.join(large, "_k").withColumn("_t", F.pmod(F.xxhash64("_i"), tiles)).groupBy(
        "_k", "_t", tiles.alias("_all")).agg(F.collect_list("_i").alias("_a"))
    left = cut.select("_k", "_t", "_a", F.explode(F.sequence(F.col("_t"), F.col("_all") - 1)).alias("_u"))
    right = cut.select("_k", F.col("_t").alias("_u"), F.col("_a").alias("_c"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("_t"))).alias("_t"))
    across = left.join(right, ["_k", "_t", "_u"]).select(
        F.explode(_pairs(F.col("_a"), F.col("_c"), F.col("_t") == F.col("_u"))).alias("p"))
    return within.unionByName(across).groupBy("p.src", "p.dst").agg(F.count(F.lit(1)).alias("weight"))


def item_graph(lines: DataFrame, basket: str, item: str, tile: int = 32) -> DataFrame:
    """``item_edges`` with the degree of both ends (number of neighbours)."""
    edges = item_edges(lines, basket, item, tile)
    ends = F.explode(F.array("src", "dst")).alias("item")
    degree = edges.select(ends).groupBy("item").agg(F.count(F.lit(1)).alias("degree"))
    return (edges.join(degree.select(F.col("item").alias("src"), F.col("degree").alias("src_degree")), "src")
            .join(degree.select(F.col("item").alias("dst"), F.col("degree").alias("dst_degree")), "dst")
            .select("src", "dst", "weight", "src_degree", "dst_degree"))
