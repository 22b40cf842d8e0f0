import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.quality import Rule, between, not_null, one_of
from stratalake.plans import rules
from stratalake.schemas import SILVER_EVENTS, SILVER_WEATHER
from stratalake.session import scratch_path

NOW = dt.datetime(2024, 1, 1, 12)

EVENT = {
    "event_time": NOW,
    "event_type": "view",
    "product_id": 1,
    "category_id": 2144415922100000123,
    "category_level_1": "garden",
    "category_level_2": None,
    "category_level_3": None,
    "brand": "fiskar",
    "price": 24.5,
    "user_id": 1515915625500000101,
    "user_session": "s",
    "year_month": "2024-01",
    "processing_timestamp": NOW,
    "effective_from": NOW,
    "effective_to": None,
    "data_confidence_score": 1.0,
    "source_system": "EcommerceEvents",
    "source_file": "f",
    "batch_id": "b",
    "record_id": "r",
}

WEATHER = {
    "observation_date": dt.date(2024, 1, 1),
    "ingestion_datetime": NOW,
    "year": 2024,
    "city": "new_york",
    "latitude": 40.7,
    "longitude": -74.0,
    "temperature_celsius": 4.25,
    "pressure_hpa": 1012,
    "humidity_percent": 72,
    "cloud_cover_percent": 100.0,
    "precipitation_mm": 0.75,
    "data_confidence_score": 1.0,
    "source_system": "openweathermap",
}


def nullable(schema):
    for field in schema.fields:
        field.nullable = True
    return schema


def frame(spark, schema, record, **changes):
    row = {**record, **changes}
    copy = type(schema).fromJson(schema.jsonValue())
    return spark.createDataFrame([tuple(row[n] for n in schema.fieldNames())], nullable(copy))


def broken(df, rule_list):
    return {name for name, n in quality.check(df, rule_list).violations.items() if n}


def test_valid_event(spark):
    df = frame(spark, SILVER_EVENTS, EVENT)
    assert broken(df, rules.EVENT_RULES) == set()
    assert quality.contract_gaps(df, SILVER_EVENTS) == []


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"event_type": "refund"}, "event_type_in_set"),
        ({"event_type": None}, "event_type_not_null"),
        ({"product_id": 0}, "product_id_in_range"),
        ({"product_id": None}, "product_id_not_null"),
        ({"price": -0.01}, "price_in_range"),
        ({"user_id": None}, "user_id_not_null"),
        ({"data_confidence_score": 1.01}, "data_confidence_score_in_range"),
        ({"event_time": None}, "event_time_not_null"),
    ],
)
def test_broken_event(spark, change, rule):
    assert broken(frame(spark, SILVER_EVENTS, EVENT, **change), rules.EVENT_RULES) == {rule}


def test_nullable_event_fields(spark):
    df = frame(spark, SILVER_EVENTS, EVENT, price=None, brand=None, category_id=None, category_level_1=None)
    assert broken(df, rules.EVENT_RULES) == set()


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"latitude": 200.0}, "latitude_in_range"),
        ({"longitude": -181.0}, "longitude_in_range"),
        ({"year": 2019}, "year_in_range"),
        ({"humidity_percent": 101}, "humidity_percent_in_range"),
        ({"cloud_cover_percent": -1.0}, "cloud_cover_percent_in_range"),
        ({"precipitation_mm": -1.0}, "precipitation_mm_in_range"),
        ({"pressure_hpa": -1}, "pressure_hpa_in_range"),
        ({"city": None}, "city_not_null"),
    ],
)
def test_broken_weather(spark, change, rule):
    assert broken(frame(spark, SILVER_WEATHER, WEATHER), rules.WEATHER_RULES) == set()
    assert broken(frame(spark, SILVER_WEATHER, WEATHER, **change), rules.WEATHER_RULES) == {rule}


def test_contract_gaps(spark):
    df = frame(spark, SILVER_WEATHER, WEATHER)
    assert quality.contract_gaps(df.withColumn("feels_like_celsius", F.lit(1.0)), SILVER_WEATHER) == [
        "unexpected column feels_like_celsius"
    ]
    assert quality.contract_gaps(df.drop("city"), SILVER_WEATHER) == ["missing column city"]
    assert quality.contract_gaps(df.withColumn("year", F.lit("2024")), SILVER_WEATHER) == [
        "column year is string, not int"
    ]


RAW = {
    **{name: 10.0 for name in rules.RAW_WEATHER_FIELDS},
    **{name: "x" for name in ("date", "source", "ingestion_timestamp", "city", "timezone")},
}


@pytest.mark.parametrize(
    "change, rule",
    [
        ({}, None),
        ({"lat": 200.0}, "lat_in_range"),
        ({"lon": 200.0}, "lon_in_range"),
        ({"humidity_afternoon": 150.0}, "humidity_afternoon_in_range"),
        ({"wind_max_direction": 400.0}, "wind_max_direction_in_range"),
        ({"cloud_cover_afternoon": 1.5}, "cloud_cover_afternoon_is_integer"),
        ({"lat": None}, "lat_not_null"),
    ],
)
def test_raw_weather_contract(spark, change, rule):
    row = {**RAW, **change}
    schema = ", ".join(f"{n} {'string' if isinstance(RAW[n], str) else 'double'}" for n in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    assert broken(df, rules.RAW_WEATHER_RULES) == ({rule} if rule else set())


ROWS = [("a", 1, "x"), ("a", None, "y"), ("b", -1, "z"), ("b", 5, None), ("c", 3, "x")]
RULES = [not_null("n"), between("n", low=0), one_of("t", ["x", "y"])]


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(ROWS, "k string, n int, t string")


def test_report_counts_nulls_only_in_not_null(sample):
    report = {r.rule: (r.rows_checked, r.violations, r.passed) for r in quality.rule_report(sample, RULES).collect()}
    assert report == {"n_not_null": (5, 1, False), "n_in_range": (5, 1, False), "t_in_set": (5, 1, False)}


def test_quarantine_and_rest_partition_the_rows(sample):
    bad = {(r.k, r.n, r.t): r.broken_rules for r in quality.quarantine(sample, RULES).collect()}
    assert bad == {("a", None, "y"): ["n_not_null"], ("b", -1, "z"): ["n_in_range", "t_in_set"]}
    assert quality.without_broken(sample, RULES).count() == 3


def test_both_sides_in_one_query(sample):
    kept = quality.without_broken(sample, RULES).select("k", "n")
    other = quality.quarantine(sample, RULES[:1]).select("k", "n")
    assert kept.unionByName(other).count() == 4


def test_outcome_by_key(sample):
    got = {r.k: (r.status, r.reason, r.row_count) for r in quality.outcome_by_key(sample, RULES, "k").collect()}
    assert got == {
        "a": ("failed", "n_not_null", 2),
        "b": ("failed", "n_in_range,t_in_set", 2),
        "c": ("passed", None, 1),
    }
    tally = {r.status: (r["keys"], r.row_count) for r in quality.outcome_tally(quality.outcome_by_key(sample, RULES, "k")).collect()}
    assert tally == {"failed": (2, 4), "passed": (1, 1)}


def test_null_profile_and_repeats(sample):
    got = {r.column: (r.rows_checked, r.null_count) for r in quality.null_profile(sample, ["n", "t"]).collect()}
    assert got == {"n": (5, 1), "t": (5, 1)}
    assert [(r.k, r.copies) for r in quality.repeated_keys(sample, ["k"]).orderBy("k").collect()] == [("a", 2), ("b", 2)]


def test_stage_and_check_agrees_with_check(spark, sample):
    staged, result = quality.stage_and_check(sample, RULES, scratch_path(spark, "stage"))
    assert result == quality.check(sample, RULES)
    assert sorted(map(str, staged.collect())) == sorted(map(str, sample.collect()))
    with pytest.raises(quality.QualityError, match="n_in_range"):
        result.require("sample")


def test_check_of_no_rows(spark, sample):
    result = quality.check(sample.filter("false"), RULES)
    assert result.rows == 0 and result.passed


def test_rule_on_quoted_text(spark):
    df = spark.createDataFrame([("it's",), ("b",)], "t string")
    assert quality.check(df, [one_of("t", ["it's"])]).violations == {"t_in_set": 1}
    odd = spark.createDataFrame([("a\\",), ("\\'b",), ("c\\n",), ("d",)], "t string")
    assert quality.check(odd, [one_of("t", ["a\\", "\\'b", "c\\n"])]).violations == {"t_in_set": 1}


def test_bar_sanity(spark):
    df = spark.createDataFrame(
        [(10.0, 12.0, 9.0, 11.0, 5.0), (10.0, 9.5, 9.0, 9.2, 5.0), (10.0, 12.0, 10.5, 11.0, -1.0)],
        "open_price double, high_price double, low_price double, close_price double, volume double",
    )
    found = {n: v for n, v in quality.check(df, rules.BAR_SANITY_RULES).violations.items() if v}
    assert found == {"high_is_highest": 1, "low_is_lowest": 1, "volume_in_range": 1}


def test_rules_are_data():
    assert Rule("r", "c", "c > 1") == Rule("r", "c", "c > 1")
