"""Completeness scores of a record."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of each field in the score of a record.
EVENT_WEIGHTS = {"category_level_1": 0.6, "brand": 0.4}
WEATHER_WEIGHTS = {
    "temperature_celsius": 0.6,
    "pressure_hpa": 0.1,
    "humidity_percent": 0.1,
    "cloud_cover_percent": 0.1,
    "precipitation_mm": 0.1,
}
BAR_FIELDS = ("open_price", "high_price", "low_price", "close_price", "volume")


def weighted_presence(weights: Mapping[str, float], blank_is_missing: bool = False) -> Column:
    """Sum of the weights of the fields a record holds, to two decimals."""

    def share(name: str, weight: float) -> Column:
        held = F.col(name)
        if blank_is_missing:
            held = F.nullif(held, F.lit(""))
        return F.when(held.isNotNull(), F.lit(weight)).otherwise(F.lit(0.0))

    return F.round(reduce(operator.add, [share(n, w) for n, w in weights.items()]), 2)


def event_confidence() -> Column:
    """1.0 with category and brand, 0.6 without brand, 0.4 without category, else 0."""
    return weighted_presence(EVENT_WEIGHTS, blank_is_missing=True)


def weather_confidence() -> Column:
    return weighted_presence(WEATHER_WEIGHTS)


def filled_ratio(fields: Sequence[str] = BAR_FIELDS) -> Column:
    """Share of the named fields that are not null."""
    held = reduce(operator.add, [F.col(name).isNotNull().cast("int") for name in fields])
    return held / F.lit(float(len(fields)))
