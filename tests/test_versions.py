"""Closed versions and merged states against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import daily, states, versions


def test_versions_are_closed_by_the_next_one(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 37 + rng.randrange(30)), i) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, since timestamp, n int")
    got = {r.n: r.until for r in versions.close_versions(df, ["k"], "since", "until").collect()}
    want = {n: min((s for j, s, m in rows if j == k and s > since), default=None) for k, since, n in rows}
    assert got == want
    closed = versions.close_versions(df, ["k"], "since", "until")
    for moment in (dt.datetime(2023, 1, 1), dt.datetime(2024, 2, 11, 5), dt.datetime(2030, 1, 1)):
        held = {r.k: r.n for r in versions.as_of(closed, F.lit(moment), "since", "until").collect()}
        assert held == {k: max((s, n) for j, s, n in rows if j == k and s <= moment)[1] for k in {j for j, s, _ in rows if s <= moment}}


def test_versions_that_start_together_leave_one(spark):
    day = dt.datetime(2024, 1, 1)
    closed = versions.close_versions(spark.createDataFrame([("a", day, 1), ("a", day, 2)], "k string, since timestamp, n int"), ["k"], "since", "until")
    assert versions.as_of(closed, F.lit(day), "since", "until").count() == 1


def bars(n, parts):
    rng = random.Random(n)
    day = dt.date(2024, 1, 2)
    rows = [(f"t{i}", day, 1e6 + rng.random(), None if i % 7 == 3 else 1e6 + rng.random(), i if i % 5 else None, i % parts) for i in range(n)]
    return rows, "ticker string, trade_date date, open_price double, close_price double, volume long, part int"


@pytest.mark.parametrize("n,parts", [(1, 1), (40, 1), (40, 7), (200, 200)])
def test_market_states_merge_to_the_daily_figures(spark, n, parts):
    df = spark.createDataFrame(*bars(n, parts))
    tickers, start, end = [f"t{i}" for i in range(n)], dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    whole = daily.daily_market(df, tickers, start, end).first().asDict()
    merged = states.market_of(states.merge_market_states(states.market_states(df, tickers, start, end, by=["part"]))).first().asDict()
    assert whole.keys() == merged.keys()
    assert merged.pop("date") == whole.pop("date")
    for name in whole:
        assert merged[name] == (None if whole[name] is None else pytest.approx(whole[name], rel=1e-6, abs=1e-12)), name


def test_sales_states_merge_in_any_grouping(spark):
    rng = random.Random(5)
    rows = [(dt.datetime(2024, 1, 1 + i % 3), None if i % 11 == 0 else round(rng.random() * 99, 2), rng.randrange(3000), rng.randrange(200)) for i in range(9000)]
    events = spark.createDataFrame(rows, "event_time timestamp, price double, user_id long, product_id long")
    exact = {r.date: r for r in daily.daily_sales(events, "2024-01-01", "2024-01-03", whole_last_day=True, price_decimals=2).collect()}
    for parts in (1, 4, 50):
        split = states.sales_states(events.withColumn("part", F.col("user_id") % parts), by=["part"])
        got = {r.date: r for r in states.sales_of(states.merge_sales_states(split)).collect()}
        assert got.keys() == exact.keys()
        for day, r in got.items():
            assert (r.sales_event_count, r.sales_total_revenue) == (exact[day].sales_event_count, exact[day].sales_total_revenue)
            assert abs(r.sales_unique_users / exact[day].sales_unique_users - 1) < 3 * 1.04 / 64
            assert abs(r.sales_unique_products / exact[day].sales_unique_products - 1) < 3 * 1.04 / 64
