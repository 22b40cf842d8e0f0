import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.operators.calendar import covered_days, date_spine, days_in_period, month_days, month_range


def test_standard_period_has_181_days(spark):
    days = [r.date for r in date_spine(spark, "2020-09-01", "2021-02-28").orderBy("date").collect()]
    assert len(days) == 181 == days_in_period("2020-09-01", "2021-02-28")
    assert (days[0], days[-1]) == (dt.date(2020, 9, 1), dt.date(2021, 2, 28))


def test_one_day(spark):
    assert date_spine(spark, "2024-02-29", "2024-02-29").count() == 1


def test_covered_days_fills_gaps(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 4),)], "d date")
    assert covered_days(df, F.col("d"), extra_days=2).count() == 6


@pytest.mark.parametrize(
    "low, high, months",
    [
        ("2023-11-01", "2024-02-01", [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]),
        ("2024-01-31", "2024-02-01", [(2024, 1), (2024, 2)]),
        ("2024-01-01", "2024-01-01", [(2024, 1)]),
    ],
)
def test_month_range(spark, low, high, months):
    df = spark.createDataFrame([("x", dt.date.fromisoformat(low), dt.date.fromisoformat(high))], "c string, l date, h date")
    out = month_range(df, "l", "h").orderBy("month_start")
    assert [(r.year, r.month) for r in out.collect()] == months
    assert out.columns == ["c", "month_start", "year", "month"]


@pytest.mark.parametrize("month, days", [("2024-02-01", 29), ("2023-02-01", 28), ("2024-12-01", 31)])
def test_month_days(spark, month, days):
    df = spark.createDataFrame([(dt.date.fromisoformat(month),)], "month_start date")
    assert month_days(df).select("date").distinct().count() == days
