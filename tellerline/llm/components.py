"""Connected components of a link table, by repeated contraction in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerline.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node in ``links(a, b)``; nodes of one component share one root.

    Each round points every node at its smallest neighbour, follows the pointers to
    their tops, and renames the links' ends; links within a root vanish. Links shrink
    from round to round and stay in tables: nothing but "is a link left?" and "did a
    pointer move?" reaches the driver. A node with very many links is only ever a grouping key with partial
    minima or the many-rows side of a join, which adaptive execution splits.
    Links with a null end are ignored.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = durable(both.where("a <> b").distinct())
    roots = None
    while not both.isEmpty():
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        parent = _tops(durable(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("root"))))
        moved = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        if roots is None:
            roots = parent
        else:
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        ends = {side: parent.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")) for side in "ab"}
        both = both.join(ends["a"], "a").join(ends["b"], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        both = durable(both.where("a <> b").distinct())
        roots = durable(roots)
    if roots is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _tops(parent: DataFrame) -> DataFrame:
    """Each node with the top of its chain of pointers; every step doubles how far pointers reach."""
    while True:
        further = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = parent.join(further, "root", "left").select("node", F.coalesce("top", "root").alias("top"), "root")
        step = durable(step)
        parent = step.select("node", F.col("top").alias("root"))
        if step.where("top <> root").isEmpty():
            return parent
