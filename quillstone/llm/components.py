"""Connected components of a graph of links, by rounds of large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

def _smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with m, the smallest node among u and its neighbours.

    A hub may have a third of all edges. Its minimum is pre-aggregated by the map tasks and written
    out, so that the join back has plain exchanges on both sides, which adaptive execution splits
    where one of them is skewed.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(common.settle(least, "component-least"), "u").select("u", "v", "m")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of links (a, b); component is the smallest node reachable.

    Null ends are left out; an empty table gives an empty one. Each round's edges are written to the
    shared folder; the number of rounds grows with the logarithm of a component's size.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = common.settle(edges, "component-edges")
    seen = None
    for _ in range(most_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        own = _smallest(common.settle(large, "component-edges"))
        small = own.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = common.settle(small, "component-edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots
