import datetime as dt
import re
from collections import defaultdict
from statistics import mean, stdev

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators.daily import daily_market, daily_sales, daily_weather
from stratalake.operators.lineage import Run
from stratalake.operators.quality import QualityError, check, contract_gaps
from stratalake.plans import gold as plan
from stratalake.plans.rules import gold_rules
from stratalake.schemas import GOLD_DAILY
from stratalake.sources.files import read_table

RUN = Run("batch", dt.datetime(2024, 1, 10, 12))
EVENTS = "event_time timestamp, price double, user_id long, product_id long"
BARS = "ticker string, trade_date date, open_price double, close_price double, volume double"
WEATHER = (
    "city string, observation_date date, temperature_celsius double, humidity_percent int, "
    "pressure_hpa long, cloud_cover_percent double, precipitation_mm double"
)
D1, D2, D3 = (dt.date(2020, 9, d) for d in (1, 2, 3))


def at(day, hour=12):
    return dt.datetime(day.year, day.month, day.day, hour)


@pytest.fixture
def inputs(spark):
    events = [(at(D1), 10.0, 1, 7), (at(D1), 20.0, 1, 8), (at(D1), None, 2, 8), (at(D3), 5.0, None, 9)]
    bars = [
        ("AAPL", D1, 100.0, 102.0, 10.0),
        ("TSLA", D1, 100.0, 98.0, 30.0),
        ("AMZN", D2, 0.0, 1.0, None),
        ("IBM", D2, 1.0, 2.0, 5.0),
        ("GOOGL", D3, 50.0, 51.0, 4.0),
    ]
    weather = [
        ("new_york", D1, 5.0, 70, 1000, 50.0, 0.0),
        ("new_york", D2, None, None, None, None, None),
        ("new_york", D3, 15.0, 60, 1010, None, 2.5),
        ("london", D1, 99.0, 1, 1, 1.0, 1.0),
    ]
    make = spark.createDataFrame
    return make(events, EVENTS), make(bars, BARS), make(weather, WEATHER)


def build(spark, inputs, start=D1, end=dt.date(2020, 9, 4), **options):
    return plan.build_gold(spark, *inputs, plan.Period(start=start, end=end, **options), RUN)


def test_daily_rows(spark, inputs):
    gold = build(spark, inputs)
    assert contract_gaps(gold, GOLD_DAILY) == []
    one, two, three, four = gold.orderBy("date").collect()
    assert (one.sales_event_count, one.sales_total_revenue, one.sales_avg_price) == (3, 30.0, 15.0)
    assert (one.sales_unique_users, one.sales_unique_products, one.sales_revenue_per_user) == (2, 2, 15.0)
    assert (one.market_avg_change_pct, one.market_positive_ratio, one.market_stocks_traded) == (0.0, 0.5, 2)
    assert one.market_volatility == pytest.approx(stdev([2, -2])) and one.market_avg_volume == 20.0
    assert (one.weather_temp_f, one.weather_is_cold, one.weather_is_rainy) == (41.0, 1, 0)
    # A zero open has no change: counted as traded, not positive, no volatility.
    assert (two.market_avg_change_pct, two.market_volatility, two.market_positive_ratio) == (0.0, 0.0, 0.0)
    assert (two.market_stocks_traded, two.market_avg_volume) == (1, None)
    # A day with weather but no readings: flags 0, average filled, Fahrenheit null.
    assert (two.weather_avg_temp_c, two.weather_temp_f, two.weather_is_cold, two.weather_is_rainy) == (0.0, None, 0, 0)
    # Only unknown users: nothing to divide by.
    assert (three.sales_unique_users, three.sales_revenue_per_user) == (0, None)
    assert (three.market_volatility, three.weather_is_rainy) == (0.0, 1)
    # No data at all.
    assert (four.sales_event_count, four.sales_total_revenue, four.sales_unique_users) == (0, 0.0, 0)
    assert (four.sales_avg_price, four.sales_unique_products, four.sales_revenue_per_user) == (None, None, None)
    assert (four.market_avg_change_pct, four.market_volatility) == (0.0, 0.0)
    assert (four.market_positive_ratio, four.market_stocks_traded, four.market_avg_volume) == (None, None, None)
    assert (four.weather_avg_temp_c, four.weather_total_precipitation) == (0.0, 0.0)
    assert (four.weather_temp_f, four.weather_is_cold, four.weather_is_rainy) == (None, None, None)
    assert {r.processing_timestamp for r in (one, four)} == {dt.datetime(2024, 1, 10, 12)}


def test_standard_period(spark, inputs):
    gold = plan.build_gold(spark, *inputs, plan.Period(), RUN)
    assert gold.count() == 181 and len(gold.columns) == 29


@pytest.mark.parametrize("whole, hours", [(False, [0]), (True, [0, 10, 23])])
def test_last_day(spark, whole, hours):
    end = dt.date(2021, 2, 28)
    events = spark.createDataFrame(
        [(at(end, h), 1.0, h, h) for h in (0, 10, 23)] + [(at(end) + dt.timedelta(days=1), 1.0, 1, 1)], EVENTS
    )
    days = daily_sales(events, "2020-09-01", end, whole_last_day=whole).collect()
    assert [(r.date, r.sales_event_count) for r in days] == [(end, len(hours))]


def test_closed_date_range(spark, inputs):
    _, bars, weather = inputs
    tickers = plan.Period().tickers
    assert {r.date for r in daily_market(bars, tickers, D2, D3).collect()} == {D2, D3}
    assert {r.date for r in daily_weather(weather, "new_york", D1, D2).collect()} == {D1, D2}


def test_approximate_counts(spark):
    events = spark.range(5000).select(
        F.lit(at(D1)).alias("event_time"), F.lit(1.0).alias("price"), F.col("id").alias("user_id"), (F.col("id") % 10).alias("product_id")
    )
    day = daily_sales(events, D1, D2, approx_rsd=0.02).first()
    assert abs(day.sales_unique_users - 5000) < 500 and day.sales_unique_products == 10


def test_gate_lets_good_tables_through(spark, inputs, tmp_path):
    path = str(tmp_path / "gold")
    period = plan.Period(start=D1, end=dt.date(2020, 9, 4))
    result = plan.publish_gold(build(spark, inputs), period, path)
    assert result.check.passed and result.check.rows == 4 and len(result.check.violations) == 12
    assert result.summary == {"row_count": 4, "first_day": D1, "last_day": dt.date(2020, 9, 4)}
    assert [r.date for r in result.preview] == [D1, D2, D3, dt.date(2020, 9, 4)]
    assert result.table.count() == 4
    # A second run replaces the table.
    plan.publish_gold(build(spark, inputs), period, path)
    assert read_table(spark, path).count() == 4


def test_refresh_touches_only_changed_days(spark, inputs, tmp_path):
    events, bars, weather = inputs
    period, path = plan.Period(start=D1, end=dt.date(2020, 9, 4)), str(tmp_path / "gold")
    later = Run("later", dt.datetime(2024, 1, 11, 12))
    early = events.filter(F.to_date("event_time") != D3)
    plan.refresh_gold(spark, plan.changed_days(early), early, bars, weather, period, RUN, path)
    late = events.filter(F.to_date("event_time") == D3)
    result = plan.refresh_gold(spark, plan.changed_days(late), events, bars, weather, period, later, path)
    same = [c for c in GOLD_DAILY.fieldNames() if c != "processing_timestamp"]
    want = build(spark, inputs).select(same).orderBy("date").collect()
    assert result.table.select(same).orderBy("date").collect() == want
    assert {r.date: r.processing_timestamp.day for r in result.table.collect()} == {D1: 10, D2: 10, D3: 11, dt.date(2020, 9, 4): 10}
    nothing = plan.refresh_gold(spark, plan.changed_days(late.limit(0)), events, bars, weather, period, later, path)
    assert nothing.table.select(same).orderBy("date").collect() == want


@pytest.mark.parametrize(
    "column, value, rule",
    [
        ("date", "DATE'2030-01-01'", "date_in_range"),
        ("sales_event_count", "CAST(NULL AS BIGINT)", "sales_event_count_not_null"),
        ("sales_event_count", "-1L", "sales_event_count_in_range"),
        ("sales_total_revenue", "-0.5D", "sales_total_revenue_in_range"),
        ("market_avg_change_pct", "100.5D", "market_avg_change_pct_in_range"),
        ("market_positive_ratio", "1.5D", "market_positive_ratio_in_range"),
        ("weather_avg_temp_c", "51D", "weather_avg_temp_c_in_range"),
        ("weather_avg_humidity", "101D", "weather_avg_humidity_in_range"),
        ("day_of_week", "8", "day_of_week_in_range"),
        ("is_weekend", "2", "is_weekend_in_set"),
        ("processing_timestamp", "CAST(NULL AS TIMESTAMP)", "processing_timestamp_not_null"),
        ("data_source", "'x'", "data_source_in_set"),
    ],
)
def test_gate_stops_bad_tables(spark, inputs, tmp_path, column, value, rule):
    bad = build(spark, inputs).withColumn(column, F.expr(value))
    path = tmp_path / "gold"
    with pytest.raises(QualityError, match=rule):
        plan.publish_gold(bad, plan.Period(start=D1, end=dt.date(2020, 9, 4)), str(path))
    assert not path.exists()


def test_nulls_pass_range_rules(spark, inputs):
    gold = build(spark, inputs).withColumn("market_positive_ratio", F.lit(None).cast("double"))
    assert check(gold, gold_rules(D1, dt.date(2020, 9, 4))).passed


def test_run_gold_from_stored_tables(spark, inputs, tmp_path):
    events, bars, weather = inputs
    events.withColumn("year_month", F.date_format("event_time", "yyyy-MM")).write.partitionBy("year_month").parquet(
        str(tmp_path / "ecommerce")
    )
    bars.write.partitionBy("ticker").parquet(str(tmp_path / "alphavantage"))
    weather.write.partitionBy("city").parquet(str(tmp_path / "openweathermap"))
    period = plan.Period(start=D1, end=dt.date(2020, 9, 4))
    result = plan.run_gold(spark, str(tmp_path), str(tmp_path / "gold"), period, RUN)
    expected = build(spark, inputs)
    assert sorted(map(str, result.table.collect())) == sorted(map(str, expected.collect()))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_prunes_and_broadcasts(spark, inputs, tmp_path):
    events, bars, weather = inputs
    events.withColumns({"year_month": F.date_format("event_time", "yyyy-MM"), "brand": F.lit("x")}).write.partitionBy(
        "year_month"
    ).parquet(str(tmp_path / "e"))
    bars.write.partitionBy("ticker").parquet(str(tmp_path / "b"))
    weather.write.partitionBy("city").parquet(str(tmp_path / "w"))
    stored = [read_table(spark, str(tmp_path / n)) for n in "ebw"]
    text = physical(plan.build_gold(spark, *stored, plan.Period(), RUN))
    assert text.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in text and "Cartesian" not in text and "Python" not in text
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 3
    assert "brand" not in text
    assert re.search(r"PartitionFilters: \[[^\]]*year_month", scans[0]) and "PushedFilters: [IsNotNull(event_time)" in scans[0]
    assert re.search(r"PartitionFilters: \[[^\]]*ticker", scans[1]) and "trade_date" in scans[1].split("PushedFilters")[1]
    assert re.search(r"PartitionFilters: \[[^\]]*city", scans[2])


def test_long_periods_are_not_forced_to_broadcast(spark, inputs):
    spine = spark.createDataFrame([(D1,)], "date date")
    part = spark.createDataFrame([(D1, 1)], "date date, v int")
    hinted = plan.join_days(spine, [part], 10)._jdf.queryExecution().analyzed().toString()
    plain = plan.join_days(spine, [part], plan.BROADCAST_DAYS + 1)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 5),
            st.one_of(st.none(), st.integers(0, 10_000)),
            st.one_of(st.none(), st.integers(1, 4)),
            st.integers(1, 4),
        ),
        max_size=40,
    )
)
def test_daily_sales_against_brute_force(spark, rows):
    data = [(at(D1 + dt.timedelta(days=d)), None if c is None else c / 100, u, p) for d, c, u, p in rows]
    df = spark.createDataFrame(data, EVENTS)
    got = {r.date: r for r in daily_sales(df, D1, D1 + dt.timedelta(days=4), price_decimals=2).collect()}
    groups = defaultdict(list)
    for moment, price, user, product in data:
        if moment <= at(D1 + dt.timedelta(days=4), 0):
            groups[moment.date()].append((price, user, product))
    assert set(got) == set(groups)
    for day, group in groups.items():
        prices = [p for p, _, _ in group if p is not None]
        users = {u for _, u, _ in group if u is not None}
        row = got[day]
        assert row.sales_event_count == len(group)
        assert row.sales_total_revenue == (pytest.approx(sum(prices)) if prices else None)
        assert row.sales_avg_price == (pytest.approx(mean(prices)) if prices else None)
        assert row.sales_unique_users == len(users)
        assert row.sales_unique_products == len({p for _, _, p in group})


def test_one_hot_user_and_day(spark):
    """A third of the rows share one user, nearly all one day."""
    n = 60_000
    events = spark.range(n).select(
        F.when(F.col("id") % 100 == 0, F.lit(at(D2))).otherwise(F.lit(at(D1))).alias("event_time"),
        F.lit(0.25).alias("price"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("long").alias("user_id"),
        (F.col("id") % 7).alias("product_id"),
    )
    got = {r.date: r for r in daily_sales(events, D1, D3).collect()}
    assert got[D2].sales_event_count == n // 100 and got[D1].sales_event_count == n - n // 100
    others = {i for i in range(n) if i % 100 and i % 3}
    assert got[D1].sales_unique_users == len(others) + 1
    assert got[D1].sales_total_revenue == 0.25 * (n - n // 100)
