"""Daily aggregates of events, bars and weather."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefeatures import flag
from .calendar import as_date


def _in_timestamp_period(df: DataFrame, start, end, whole_last_day: bool) -> Column:
    """Closed period on a time stamp column.

    The end bound is the first instant of the last day unless ``whole_last_day``.
    Bounds are constants on the bare column, so they reach the scan; a
    ``year_month`` partition column is bounded as well, to prune folders.
    """
    first, last = as_date(start), as_date(end)
    stop = last + dt.timedelta(days=1) if whole_last_day else last
    below = F.col("event_time") < F.lit(stop).cast("timestamp")
    if not whole_last_day:
        below = F.col("event_time") <= F.lit(stop).cast("timestamp")
    inside = (F.col("event_time") >= F.lit(first).cast("timestamp")) & below
    if "year_month" in df.columns:
        inside = inside & F.col("year_month").between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    return inside


def daily_sales(
    events: DataFrame,
    start,
    end,
    *,
    whole_last_day: bool = False,
    price_decimals: int | None = None,
    approx_rsd: float | None = None,
) -> DataFrame:
    """Events, revenue, average price, users and products per day.

    ``price_decimals`` sums prices as integers of that many decimals: exact and
    the same in every run, where a floating sum depends on the order of the
    shuffle. ``approx_rsd`` trades the exact distinct counts, whose shuffle holds
    every (day, user) and (day, product) pair, for sketches of constant size.
    """
    price = F.col("price")
    if price_decimals is None:
        total = F.sum(price)
    else:
        unit = 10**price_decimals
        total = F.sum(F.rint(price * unit).cast("bigint")) / F.lit(float(unit))

    def distinct(name: str) -> Column:
        return F.approx_count_distinct(name, approx_rsd) if approx_rsd else F.count_distinct(name)

    per_day = (
        events.filter(_in_timestamp_period(events, start, end, whole_last_day))
        .groupBy(F.to_date("event_time").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("sales_event_count"),
            total.alias("sales_total_revenue"),
            F.count(price).alias("priced"),
            distinct("user_id").alias("sales_unique_users"),
            distinct("product_id").alias("sales_unique_products"),
        )
    )
    return per_day.select(
        "date",
        "sales_event_count",
        "sales_total_revenue",
        F.try_divide("sales_total_revenue", "priced").alias("sales_avg_price"),
        "sales_unique_users",
        "sales_unique_products",
        F.try_divide("sales_total_revenue", "sales_unique_users").alias("sales_revenue_per_user"),
    )


def change_pct(opened: Column, closed: Column) -> Column:
    """Change over the day in percent; null for a zero open."""
    return F.try_divide(closed - opened, opened) * 100


def daily_market(bars: DataFrame, tickers: Sequence[str], start, end) -> DataFrame:
    """Index of the chosen tickers per day; volatility is the sample deviation."""
    change = F.col("change_pct")
    return (
        bars.filter(F.col("ticker").isin(*tickers) & F.col("trade_date").between(as_date(start), as_date(end)))
        .select(
            F.col("trade_date").cast("date").alias("date"),
            "ticker",
            "volume",
            change_pct(F.col("open_price"), F.col("close_price")).alias("change_pct"),
        )
        .groupBy("date")
        .agg(
            F.avg(change).alias("market_avg_change_pct"),
            F.stddev_samp(change).alias("market_volatility"),
            F.avg(flag(change > 0)).alias("market_positive_ratio"),
            F.count("ticker").alias("market_stocks_traded"),
            F.avg("volume").alias("market_avg_volume"),
        )
    )


# Fixed value: a day colder than this, in degrees Celsius, counts as cold.
COLD_BELOW_C = 10


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def daily_weather(weather: DataFrame, city: str, start, end) -> DataFrame:
    """Weather of one city per day with cold and rainy flags."""
    averages = {
        "weather_avg_temp_c": "temperature_celsius",
        "weather_avg_humidity": "humidity_percent",
        "weather_avg_pressure": "pressure_hpa",
        "weather_avg_cloud_cover": "cloud_cover_percent",
    }
    inside = F.col("observation_date").between(as_date(start), as_date(end))
    per_day = (
        weather.filter((F.col("city") == city) & inside)
        .groupBy(F.col("observation_date").cast("date").alias("date"))
        .agg(
            *[F.avg(source).alias(name) for name, source in averages.items()],
            F.sum("precipitation_mm").alias("weather_total_precipitation"),
        )
    )
    return per_day.withColumns(
        {
            "weather_temp_f": fahrenheit(F.col("weather_avg_temp_c")),
            "weather_is_cold": flag(F.col("weather_avg_temp_c") < COLD_BELOW_C),
            "weather_is_rainy": flag(F.col("weather_total_precipitation") > 0),
        }
    )
