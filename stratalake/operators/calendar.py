"""Calendars: day spines, month ranges and the days of a month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "interval 1 day"
MONTH = "interval 1 month"


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def days_in_period(start: str | dt.date, end: str | dt.date) -> int:
    """Number of days in a closed period: the row bound of anything grouped by day."""
    return (as_date(end) - as_date(start)).days + 1


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(F.lit(as_date(start)).alias("low"), F.lit(as_date(end)).alias("high"))
    return spread_days(bounds, "low", "high")


def spread_days(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """One ``date`` row per day of each row's closed date range."""
    return bounds.select(F.explode(F.sequence(low, high, F.expr(DAY))).alias("date"))


def covered_days(df: DataFrame, day: Column, extra_days: int = 0) -> DataFrame:
    """Continuous calendar over the days a table covers, lengthened at the end."""
    bounds = df.agg(F.min(day).alias("low"), F.date_add(F.max(day), extra_days).alias("high"))
    return spread_days(bounds, "low", "high")


def month_range(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """One ``month_start, year, month`` row per month of each row's closed range.

    Other columns of ``bounds`` are kept, so a table of cities with their
    periods becomes cities times months without a cross join.
    """
    others = [c for c in bounds.columns if c not in (low, high)]
    months = F.sequence(F.trunc(low, "month"), F.trunc(high, "month"), F.expr(MONTH))
    return bounds.select(*others, F.explode(months).alias("month_start")).select(
        *others,
        "month_start",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
    )


def month_days(months: DataFrame, month_start: str = "month_start") -> DataFrame:
    """One row per calendar day of each month row."""
    days = F.sequence(F.col(month_start), F.last_day(month_start), F.expr(DAY))
    return months.withColumn("date", F.explode(days))
