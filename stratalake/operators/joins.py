"""Joins against lists of keys.

No side carries a hint: the planner broadcasts one whose size in bytes it knows
to be small, and adaptive execution splits a shuffled join where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def keep_listed(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is on the list."""
    return df.join(listed.select(*keys), keys, "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not on the list."""
    return df.join(listed.select(*keys), keys, "left_anti")
