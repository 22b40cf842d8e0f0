"""Versions of a row over time: closing their intervals, and the table as it was."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def close_versions(df: DataFrame, keys: Sequence[str], start: str, end: str, unit: str = "month") -> DataFrame:
    """``df`` with ``end``: where the next version of the same key starts, null for the last one.

    Neighbours are looked up within one ``unit`` of time of a key, and across units
    by the first start of each unit, of which a key has few; so no window holds all
    versions of a key. Versions that start together end at once but for one.
    """
    unit_of = F.date_trunc(unit, F.col(start))
    chunked = df.withColumn("version_unit", unit_of)
    firsts = chunked.groupBy(*keys, "version_unit").agg(F.min(start).alias("first"))
    ahead = firsts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("version_unit", "first"))).alias("version_units"))
    ahead = ahead.withColumnsRenamed({k: f"version_{k}" for k in keys})
    within = Window.partitionBy(*keys, "version_unit").orderBy(start)
    near = chunked.withColumn("version_next", F.lead(start).over(within))
    met = near.join(ahead, [F.col(k).eqNullSafe(F.col(f"version_{k}")) for k in keys])
    # A row keeps its unit as a column, so the lambda may refer to it.
    later = F.get(F.filter("version_units", lambda u: u["version_unit"] > F.col("version_unit")), F.lit(0))["first"]
    columns = [c for c in df.columns if c != end]
    return met.select(*columns, F.coalesce("version_next", later).alias(end))


def as_of(df: DataFrame, moment: Column, start: str, end: str) -> DataFrame:
    """Rows of closed versions that held at a moment: one per key."""
    return df.filter((F.col(start) <= moment) & (F.col(end).isNull() | (moment < F.col(end))))
