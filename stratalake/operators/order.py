"""Whether records stand in order, without bringing a whole file or key together.

Neighbours within one split of a file are compared there; of each split only its
first and last value go on, and these are stitched at the borders of splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _step(before: Column, after: Column) -> Column:
    """1 up, -1 down, 0 equal; null if either is missing."""
    return F.when(after > before, 1).when(after < before, -1).when(after == before, 0)


def split_steps(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Steps up, down and level in every split, and its first and last value.

    ``rows`` has ``key, path, split, place`` and ``value``; a null value is passed
    over. A window holds one split, whose size the reader bounds.
    """
    within = Window.partitionBy("path", "split").orderBy("place")
    steps = rows.filter(F.col(value).isNotNull()).withColumn("step", _step(F.lag(value).over(within), F.col(value)))
    return steps.groupBy(key, "path", "split").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("step") == s).alias(name) for s, name in ((1, "up"), (-1, "down"), (0, "level"))],
        F.min_by(value, "place").alias("first"),
        F.max_by(value, "place").alias("last"),
    )


def _with_borders(name: str, step: int) -> Column:
    """Steps of one kind inside the splits of a file and at their borders."""
    return F.col(name) + F.size(F.filter("borders", lambda border: border == step))


def order_report(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``key, values, out_of_order``: records that do not go on in their file's direction.

    A file may rise or fall; steps of the rarer direction and repeats of the value
    before are out of order. Files of a key are judged one by one. The splits of a
    file, a few numbers each, are gathered in order.
    """
    splits = split_steps(rows, key, value)
    ordered = splits.groupBy(key, "path").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ("up", "down", "level")],
        F.sort_array(F.collect_list(F.struct("split", "first", "last"))).alias("ends"),
    )
    borders = F.transform(
        F.slice("ends", 2, F.size("ends")), lambda end, i: _step(F.get(F.col("ends"), i)["last"], end["first"])
    )
    counted = ordered.withColumn("borders", borders)
    up, down, level = (_with_borders(name, s) for s, name in ((1, "up"), (-1, "down"), (0, "level")))
    per_file = counted.select(key, "n", (F.least(up, down) + level).alias("out"))
    return per_file.groupBy(key).agg(F.sum("n").alias("values"), F.sum("out").alias("out_of_order"))
