"""Connected components by alternating stars, as joins and pre-combined minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import release, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the not larger) neighbours of each node on its smallest one.

    The minimum per node is combined before the shuffle, and both sides of the
    join are staged, so a node with very many neighbours is split over tasks.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    if large:
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(high.alias("u"), low.alias("v"))
    least = staged(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
    joined = around.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    result = staged(moved.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    release(least)
    return result


def _print(edges: DataFrame) -> tuple:
    """A fingerprint of a set of edges that does not depend on their order."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges``: the smallest node it is connected with.

    Large and small stars alternate until nothing moves, a number of rounds that
    grows with the logarithm of the component size. Each round is staged; the
    driver only sees a count and a checksum.
    """
    current = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges")
    before = _print(current)
    while before[0]:
        wide = _star(current, large=True)
        narrow = _star(wide, large=False)
        release(current, wide)
        current, after = narrow, _print(narrow)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    result = staged(nodes.unionByName(nodes.select(F.col("root").alias("node"), "root")).distinct(), "components")
    release(current)
    return result
