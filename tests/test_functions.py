import datetime as dt

from itertools import product

import pytest
from pyspark.sql import functions as F

from stratalake.functions.scores import event_confidence, filled_ratio, weather_confidence
from stratalake.functions.text import (
    batch_time,
    blank_to_null,
    category_levels,
    month_key,
    path_batch,
    path_key,
    slug,
)
from stratalake.functions.timefeatures import add_time_features, to_day, to_event_time
from stratalake.operators.daily import change_pct, fahrenheit


def values(df):
    return [tuple(row) for row in df.collect()]


@pytest.mark.parametrize(
    "code, levels",
    [
        ("garden.tools.spade", ("garden", "tools", "spade")),
        ("toys.dice", ("toys", "dice", None)),
        ("office", ("office", None, None)),
        ("a.b.c.d", ("a", "b", "c")),
        ("a..c", ("a", "", "c")),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_category_levels(spark, code, levels):
    df = spark.createDataFrame([(code,)], "code string")
    assert values(df.select(*category_levels(F.col("code")))) == [levels]


@pytest.mark.parametrize("category, brand", product((None, "", "word"), repeat=2))
def test_event_confidence(spark, category, brand):
    """Six tenths for a category and four for a brand."""
    df = spark.createDataFrame([(category, brand)], "category_level_1 string, brand string")
    assert values(df.select(event_confidence())) == [(round(0.6 * bool(category) + 0.4 * bool(brand), 2),)]


def test_weather_confidence(spark):
    schema = (
        "temperature_celsius double, pressure_hpa long, humidity_percent int, "
        "cloud_cover_percent double, precipitation_mm double"
    )
    rows = [(3.37, 1021, 72, 100.0, 1.14), (3.37, None, 72, None, 1.14), (None,) * 5, (None, 1, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, schema)
    assert [s for (s,) in values(df.select(weather_confidence()))] == [1.0, 0.8, 0.0, 0.4]


def test_filled_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0, None, 4.0, None)], "a double, b double, c double, d double, e double")
    assert values(df.select(filled_ratio(list("abcde")))) == [(0.6,)]


def test_text_helpers(spark):
    df = spark.createDataFrame([("New York", ""), ("london", "x"), (None, None)], "city string, brand string")
    assert values(df.select(slug(F.col("city")), blank_to_null(F.col("brand")))) == [
        ("new_york", None),
        ("london", "x"),
        (None, None),
    ]


def test_month_key(spark):
    df = spark.createDataFrame([("New York", 2024, 3)], "c string, y int, m int")
    key = month_key(F.col("c"), F.col("y"), F.col("m"), "bronze/x")
    assert values(df.select(key)) == [("bronze/x/city=new_york/year=2024/03.json",)]


@pytest.mark.parametrize(
    "path, key, batch, time",
    [
        ("a/AAPL/20240115_093000.csv", "AAPL", "20240115_093000.csv", dt.datetime(2024, 1, 15, 9, 30)),
        ("a/AAPL/readme.csv", "AAPL", "readme.csv", None),
        ("a/symbol=IBM/batch_ts=20240101_000000/part-1.csv", "IBM", "20240101_000000", dt.datetime(2024, 1, 1)),
    ],
)
def test_paths(spark, path, key, batch, time):
    df = spark.createDataFrame([(path,)], "p string")
    p = F.col("p")
    assert values(df.select(path_key(p), path_batch(p), batch_time(path_batch(p)))) == [(key, batch, time)]


def test_time_parsing(spark):
    df = spark.createDataFrame(
        [("2020-09-24 11:57:06 UTC", "2024-01-01"), ("nonsense", "invalid"), (None, None)], "t string, d string"
    )
    assert values(df.select(to_event_time(F.col("t")), to_day(F.col("d")))) == [
        (dt.datetime(2020, 9, 24, 11, 57, 6), dt.date(2024, 1, 1)),
        (None, None),
        (None, None),
    ]


@pytest.mark.parametrize(
    "day, expected",
    [
        ("2020-11-01", (1, 1, 0, 0, 11, 1)),  # Sunday
        ("2021-02-01", (2, 0, 1, 0, 2, 0)),  # Monday
        ("2021-01-01", (6, 0, 0, 1, 1, 1)),  # Friday
        ("2020-10-03", (7, 1, 0, 0, 10, 0)),  # Saturday
    ],
)
def test_time_features(spark, day, expected):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "date date")
    features = add_time_features(df).select(
        "day_of_week", "is_weekend", "is_monday", "is_friday", "month", "is_holiday_season"
    )
    assert values(features) == [expected]


def test_change_and_fahrenheit(spark):
    df = spark.createDataFrame([(100.0, 102.0), (0.0, 5.0), (None, 1.0)], "o double, c double")
    assert [r[0] for r in values(df.select(change_pct(F.col("o"), F.col("c"))))] == [2.0, None, None]
    assert values(spark.createDataFrame([(10.0,)], "c double").select(fahrenheit(F.col("c")))) == [(50.0,)]
