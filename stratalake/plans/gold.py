"""The daily table: calendar joined with sales, market and weather."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefeatures import add_time_features
from ..operators.calendar import date_spine, days_in_period
from ..operators.daily import daily_market, daily_sales, daily_weather
from ..operators.lineage import Run
from ..operators.quality import Check, check
from ..schemas import GOLD_DAILY, select_contract
from ..session import path_exists, staged
from ..sinks.tables import overwrite_table, preview, summary
from ..sources.files import read_table
from .rules import GOLD_SOURCE, GOLD_VERSION, gold_rules

# Columns that read 0 on a day without data. All others stay null.
DEFAULTS = {
    "sales_event_count": 0,
    "sales_total_revenue": 0.0,
    "sales_unique_users": 0,
    "market_avg_change_pct": 0.0,
    "market_volatility": 0.0,
    "weather_avg_temp_c": 0.0,
    "weather_total_precipitation": 0.0,
}

# A side with one short row per day is broadcast up to this many days (270 years).
BROADCAST_DAYS = 100_000

# Columns of the preview.
PREVIEW = ("date", "sales_event_count", "sales_total_revenue", "market_avg_change_pct", "weather_avg_temp_c")


@dataclass(frozen=True)
class Period:
    """What the daily table covers. The defaults, fixed values, are the standard report."""

    start: dt.date = dt.date(2020, 9, 1)
    end: dt.date = dt.date(2021, 2, 28)
    tickers: tuple[str, ...] = ("AAPL", "TSLA", "AMZN", "GOOGL")
    city: str = "new_york"
    whole_last_day: bool = False
    price_decimals: int | None = None


def join_days(spine: DataFrame, parts: list[DataFrame], days: int) -> DataFrame:
    """Left-join daily aggregates onto the calendar.

    Each part has at most one row per day of the period, so its size is known
    before anything runs.
    """
    joined = spine
    for part in parts:
        side = F.broadcast(part) if days <= BROADCAST_DAYS else part
        joined = joined.join(side, "date", "left")
    return joined


def build_gold(
    spark: SparkSession,
    events: DataFrame,
    bars: DataFrame,
    weather: DataFrame,
    period: Period,
    run: Run,
) -> DataFrame:
    """One row per day of the period, with features, defaults and metadata."""
    start, end = period.start, period.end
    parts = [
        daily_sales(
            events,
            start,
            end,
            whole_last_day=period.whole_last_day,
            price_decimals=period.price_decimals,
        ),
        daily_market(bars, period.tickers, start, end),
        daily_weather(weather, period.city, start, end),
    ]
    joined = join_days(date_spine(spark, start, end), parts, days_in_period(start, end))
    filled = add_time_features(joined).fillna(DEFAULTS)
    stamped = filled.withColumns(
        {
            "processing_timestamp": run.timestamp(),
            "data_source": F.lit(GOLD_SOURCE),
            "version": F.lit(GOLD_VERSION),
        }
    )
    return select_contract(stamped, GOLD_DAILY)


@dataclass(frozen=True)
class GoldResult:
    table: DataFrame
    check: Check
    summary: dict
    preview: list


def publish_gold(gold: DataFrame, period: Period, path: str, *, fmt: str = "parquet") -> GoldResult:
    """Gate, write and summarise. The rows, one per day, are computed once.

    Nothing is written when a rule is broken.
    """
    kept = gold.persist()
    try:
        result = check(kept, gold_rules(period.start, period.end))
        result.require("daily table")
        overwrite_table(kept, path, fmt=fmt)
        return GoldResult(
            read_table(gold.sparkSession, path, fmt),
            result,
            summary(kept).first().asDict(),
            preview(kept, PREVIEW, "date").collect(),
        )
    finally:
        kept.unpersist()


def changed_days(events: DataFrame | None = None, bars: DataFrame | None = None, weather: DataFrame | None = None) -> DataFrame:
    """Days that new rows of the standardised tables belong to: ``date``, each once."""
    parts = [
        rows.select(F.to_date(column).alias("date"))
        for rows, column in ((events, "event_time"), (bars, "trade_date"), (weather, "observation_date")) if rows is not None
    ]
    days = parts[0]
    for part in parts[1:]:
        days = days.unionByName(part)
    return days.filter(F.col("date").isNotNull()).distinct()


def refresh_gold(
    spark: SparkSession,
    changed: DataFrame,
    events: DataFrame,
    bars: DataFrame,
    weather: DataFrame,
    period: Period,
    run: Run,
    path: str,
    *,
    fmt: str = "parquet",
) -> GoldResult:
    """Bring the daily table up to date after new rows, from the days they belong to alone.

    ``events``, ``bars`` and ``weather`` are the whole standardised tables, ``changed``
    the days to read again; their first and last one bound the scans. All other days
    keep their row. The whole new table is gated before it takes the old one's
    place. Without a stored table all days are built.
    """
    if not path_exists(spark, path):
        return publish_gold(build_gold(spark, events, bars, weather, period, run), period, path, fmt=fmt)
    days = staged(changed.filter(F.col("date").between(period.start, period.end)), "changed-days")  # a day of the period at most once
    first, last = days.agg(F.min("date"), F.max("date")).first()
    stored = read_table(spark, path, fmt)
    if first is None:
        return publish_gold(staged(stored, "gold"), period, path, fmt=fmt)
    whole_last = period.whole_last_day or last < period.end
    part = replace(period, start=first, end=last, whole_last_day=whole_last)
    of = lambda rows, column: rows.join(F.broadcast(days), F.to_date(column) == days["date"], "left_semi")
    fresh = build_gold(spark, of(events, "event_time"), of(bars, "trade_date"), of(weather, "observation_date"), part, run)
    kept = stored.join(F.broadcast(days), "date", "left_anti")
    merged = kept.unionByName(fresh.join(F.broadcast(days), "date", "left_semi"))
    return publish_gold(staged(select_contract(merged, GOLD_DAILY), "gold"), period, path, fmt=fmt)


def run_gold(
    spark: SparkSession,
    silver_root: str,
    gold_path: str,
    period: Period = Period(),
    run: Run | None = None,
    *,
    fmt: str = "parquet",
) -> GoldResult:
    """Build and publish the daily table from the stored standardised tables."""
    root = silver_root.rstrip("/")
    gold = build_gold(
        spark,
        read_table(spark, f"{root}/ecommerce", fmt),
        read_table(spark, f"{root}/alphavantage", fmt),
        read_table(spark, f"{root}/openweathermap", fmt),
        period,
        run or Run(),
    )
    return publish_gold(gold, period, gold_path, fmt=fmt)
