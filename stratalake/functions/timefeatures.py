"""Time parsing and calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark numbers the days of the week from 1 = Sunday.
SUNDAY, MONDAY, FRIDAY, SATURDAY = 1, 2, 6, 7
HOLIDAY_MONTHS = (11, 12, 1)


def to_event_time(text: Column) -> Column:
    """Parse ``2020-09-24 11:57:06 UTC``; unreadable text becomes null."""
    return F.try_to_timestamp(text)


def to_day(text: Column) -> Column:
    """Date of a date or time stamp text; unreadable text becomes null."""
    return text.try_cast("timestamp").cast("date")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def add_time_features(df: DataFrame, day: str = "date") -> DataFrame:
    """Day of week, month and the flags derived from them."""
    weekday, month = F.dayofweek(day), F.month(day)
    return df.withColumns(
        {
            "day_of_week": weekday,
            "is_weekend": weekday.isin(SUNDAY, SATURDAY).cast("int"),
            "is_monday": flag(weekday == MONDAY),
            "is_friday": flag(weekday == FRIDAY),
            "month": month,
            "is_holiday_season": flag(month.isin(*HOLIDAY_MONTHS)),
        }
    )
