"""Connected components of a link table, by hooking and contraction.

Every node hooks to its smallest neighbour (a minimum per node, combined
before its shuffle), pointers double until they reach the roots of that
forest, and links between different roots form the next, at most half as
large, graph. Lineage is cut after every step; nothing is gathered on the
driver but emptiness flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import discard, is_small, materialise


def _held(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def roots(parents: DataFrame, small: bool = False) -> DataFrame:
    """(node, component): the root each node reaches. ``parents``
    (node, parent) has each node at most once, and parent < node; ``small``:
    it may be broadcast."""
    now, step = parents.select("node", F.col("parent").alias("component")), None
    while True:
        up = now.select(F.col("node").alias("at"), F.col("component").alias("above"))
        before, step = step, materialise(
            now.join(_held(up, small), F.col("component") == F.col("at"), "left").select(
                "node", F.coalesce("above", "component").alias("component"),
                F.col("above").isNotNull().alias("moved")), "roots")
        if before is not None:
            discard(before)
        now = step.select("node", "component")
        if step.filter("moved").isEmpty():
            return step.drop("moved")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns u, v; any order,
    repeats and loops allowed) but the smallest of each component: component
    is the smallest node reachable."""
    now = materialise(links.filter("u <> v").select("u", "v"), "links")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    small = is_small(now)           # a node that is not its own root is the larger end of a link
    both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hooks = both.groupBy("u").agg(F.min("v").alias("v")).filter("v < u")
    found = roots(hooks.select(F.col("u").alias("node"), F.col("v").alias("parent")), small)

    def named(name: str) -> DataFrame:
        return _held(found.select(F.col("node").alias(f"n{name}"), F.col("component").alias(f"c{name}")), small)

    across = (now.join(named("u"), F.col("u") == F.col("nu"), "left")
              .join(named("v"), F.col("v") == F.col("nv"), "left")
              .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
              .filter("u <> v").distinct())
    above = components(across).select(F.col("node").alias("at"), F.col("component").alias("above"))
    merged = found.join(_held(above, small), F.col("component") == F.col("at"), "left").select(
        "node", F.coalesce("above", "component").alias("component"))
    # roots that a later round joined to smaller ones
    return merged.unionByName(above.select(F.col("at").alias("node"),
                                           F.col("above").alias("component")).join(
        _held(merged.select("node"), small), "node", "left_anti"))
