"""Registered queries: each takes ``(spark, sf_dir)`` and reads whole tables.

Dates and time stamps are returned as text and nullable integers as double, so
that results print alike in every engine.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import event_confidence, filled_ratio, weather_confidence
from ..functions.text import batch_time, blank_to_null, category_levels, path_batch, path_key, slug
from ..functions.timefeatures import add_time_features
from ..operators import calendar, daily, nesting, planning, quality, states, versions
from ..operators.lineage import Run, row_id
from ..plans import bars as bar_plan
from ..plans import events as event_plan
from ..plans import gold as gold_plan
from ..plans import landing, rules
from ..plans import weather as weather_plan
from ..session import apply_settings, scratch_path, staged
from ..sinks import tables as sinks
from ..sources import files as sources
from ..sources import manifest
from ..streaming.ingest import ingest_events
from . import roles

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Parameters of the registered runs.
RUN = Run("batch-1", dt.datetime(2024, 2, 15, 12, 0, 0))
STALE_RUN = Run("batch-2", dt.datetime(2024, 1, 31, 18, 0, 0))
PERIOD = gold_plan.Period(
    start=dt.date(2024, 1, 1),
    end=dt.date(2024, 2, 10),
    tickers=("click", "view", "purchase", "signup"),
    city="new_york",
    price_decimals=2,
)
SALES_END = dt.date(2024, 1, 30)
MARKET_START, MARKET_END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
ALLOWED_TICKERS = ("click", "view", "missing")
TEXT = "yyyy-MM-dd HH:mm:ss"


def registered(query: Query) -> Query:
    """Add a query under its function name, with the session settings it needs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_settings(spark), sf_dir)

    _REGISTRY[query.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def text_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def text_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, TEXT) for c in columns})


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = roles.raw_events(roles.events(spark, sf_dir))
    return event_plan.standardize_events(raw, RUN, F.lit("events.csv"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nesting.monthly_documents(roles.weather_readings(roles.events(spark, sf_dir)), RUN)


def _silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_plan.standardize_weather(_documents(spark, sf_dir))


def _bar_texts(ev: DataFrame) -> DataFrame:
    """Bars with every field as the text a CSV file would hold."""
    return roles.raw_bars(ev).select(
        F.col("ticker").alias("symbol"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("timestamp"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


# --- calendar ----------------------------------------------------------------


@registered
def date_spine(spark, sf_dir):
    days = calendar.covered_days(roles.events(spark, sf_dir), F.to_date("ts"), extra_days=11)
    return text_dates(days, "date")


@registered
def time_features(spark, sf_dir):
    days = calendar.covered_days(roles.events(spark, sf_dir), F.to_date("ts"), extra_days=330)
    return text_dates(add_time_features(days), "date")


@registered
def month_range(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    bounds = orders.groupBy("o_orderpriority").agg(
        F.min(F.to_date("o_orderdate")).alias("low"), F.max(F.to_date("o_orderdate")).alias("high")
    )
    return text_dates(calendar.month_range(bounds, "low", "high"), "month_start")


@registered
def month_days(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    months = orders.select(F.trunc("o_orderdate", "month").alias("month_start")).distinct()
    return text_dates(calendar.month_days(months), "month_start", "date")


# --- daily aggregates and the daily table ------------------------------------


@registered
def daily_sales(spark, sf_dir):
    sales = roles.sales_events(roles.events(spark, sf_dir))
    return text_dates(daily.daily_sales(sales, PERIOD.start, SALES_END, price_decimals=2), "date")


@registered
def daily_sales_whole_last_day(spark, sf_dir):
    sales = roles.sales_events(roles.events(spark, sf_dir))
    per_day = daily.daily_sales(sales, PERIOD.start, SALES_END, whole_last_day=True, price_decimals=2)
    return text_dates(per_day, "date")


@registered
def daily_bars(spark, sf_dir):
    return text_dates(roles.raw_bars(roles.events(spark, sf_dir)), "trade_date")


_MARKET_FLOATS = ("market_avg_change_pct", "market_volatility", "market_positive_ratio", "market_avg_volume")


@registered
def daily_market(spark, sf_dir):
    bars = roles.silver_bars(roles.events(spark, sf_dir))
    per_day = daily.daily_market(bars, PERIOD.tickers, MARKET_START, MARKET_END)
    return text_dates(rounded(per_day, *_MARKET_FLOATS), "date")


@registered
def daily_weather(spark, sf_dir):
    per_day = daily.daily_weather(_silver_weather(spark, sf_dir), PERIOD.city, MARKET_START, MARKET_END)
    return text_dates(per_day, "date")


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = roles.events(spark, sf_dir)
    return gold_plan.build_gold(
        spark, roles.sales_events(ev), roles.silver_bars(ev), _silver_weather(spark, sf_dir), PERIOD, RUN
    )


_GOLD_NULLABLE_INTS = ("sales_unique_products", "market_stocks_traded", "weather_is_cold", "weather_is_rainy")


def _gold_text(gold: DataFrame) -> DataFrame:
    plain = rounded(as_double(gold, *_GOLD_NULLABLE_INTS), *_MARKET_FLOATS)
    return text_times(text_dates(plain, "date"), "processing_timestamp")


@registered
def gold_daily(spark, sf_dir):
    return _gold_text(_gold(spark, sf_dir))


@registered
def gold_preview(spark, sf_dir):
    top = sinks.preview(_gold(spark, sf_dir), gold_plan.PREVIEW, "date")
    return text_dates(rounded(top, "market_avg_change_pct"), "date")


@registered
def gold_summary(spark, sf_dir):
    return text_dates(sinks.summary(_gold(spark, sf_dir)), "first_day", "last_day")


def _damped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales, bars and weather whose daily table passes the gate."""
    ev = roles.events(spark, sf_dir)
    bars = roles.silver_bars(ev).withColumns(
        {c: F.col(c) / 10 + 50 for c in ("open_price", "close_price")}
    )
    weather = _silver_weather(spark, sf_dir).withColumn("temperature_celsius", F.col("temperature_celsius") / 20)
    return roles.sales_events(ev), bars, weather


@registered
def gold_published(spark, sf_dir):
    """Gate, write, read back, on inputs damped to pass the gate."""
    gold = gold_plan.build_gold(spark, *_damped(spark, sf_dir), PERIOD, RUN)
    return _gold_text(gold_plan.publish_gold(gold, PERIOD, scratch_path(spark, "gold")).table)


@registered
def gold_incremental(spark, sf_dir):
    """The daily table after three deliveries of sales, each one read for its own days alone."""
    sales, bars, weather = _damped(spark, sf_dir)
    target = scratch_path(spark, "gold")
    late, odd = F.dayofmonth("event_time") > 20, F.col("user_id") % 2 == 1
    arrived = None
    for delivery in (sales.filter(~odd), sales.filter(odd & late), sales.filter(odd & ~late)):
        arrived = delivery if arrived is None else arrived.unionByName(delivery)
        result = gold_plan.refresh_gold(spark, gold_plan.changed_days(delivery), arrived, bars, weather, PERIOD, RUN, target)
    return _gold_text(result.table)


# --- scalar functions --------------------------------------------------------


@registered
def category_levels_of_products(spark, sf_dir):
    level_1, level_2, level_3 = category_levels(F.col("category_code"))
    return roles.catalogue(spark, sf_dir).select(
        "p_partkey",
        level_1.alias("category_level_1"),
        level_2.alias("category_level_2"),
        level_3.alias("category_level_3"),
    )


@registered
def brand_clean(spark, sf_dir):
    return roles.catalogue(spark, sf_dir).select("p_partkey", blank_to_null(F.col("brand")).alias("brand"))


@registered
def event_confidence_of_products(spark, sf_dir):
    products = roles.catalogue(spark, sf_dir).withColumn("category_level_1", F.col("category_code"))
    return products.select("p_partkey", event_confidence().alias("data_confidence_score"))


@registered
def weather_confidence_of_days(spark, sf_dir):
    readings = roles.weather_readings(roles.events(spark, sf_dir)).select(
        "city",
        "date",
        F.col("temperature.afternoon").alias("temperature_celsius"),
        F.col("pressure.afternoon").alias("pressure_hpa"),
        F.col("humidity.afternoon").alias("humidity_percent"),
        F.col("cloud_cover.afternoon").alias("cloud_cover_percent"),
        F.col("precipitation.total").alias("precipitation_mm"),
    )
    return readings.select("city", "date", weather_confidence().alias("data_confidence_score"))


@registered
def bar_completeness(spark, sf_dir):
    bars = roles.gapped_bars(roles.events(spark, sf_dir))
    score = filled_ratio(("open", "high", "low", "close", "volume"))
    return text_dates(bars.select("ticker", "trade_date", score.alias("completeness_score")), "trade_date")


@registered
def city_slug(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", slug(F.col("o_orderpriority")).alias("slug"))


@registered
def record_ids(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    return ev.select("event_id", row_id(["event_id", "user_id", "event_type"]).alias("record_id"))


@registered
def json_props(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    return ev.select("event_id", "k", F.to_json(F.struct("k")).alias("props"))


# --- standardised tables -----------------------------------------------------


@registered
def silver_events(spark, sf_dir):
    plain = text_times(_silver_events(spark, sf_dir), "event_time", "processing_timestamp", "effective_from")
    return plain.withColumn("effective_to", F.col("effective_to").cast("string"))


@registered
def silver_weather(spark, sf_dir):
    plain = text_times(text_dates(_silver_weather(spark, sf_dir), "observation_date"), "ingestion_datetime")
    return as_double(plain, "pressure_hpa", "humidity_percent")


@registered
def silver_bars(spark, sf_dir):
    rows = _bar_texts(roles.events(spark, sf_dir)).select(
        F.col("symbol").alias("ticker"),
        "timestamp",
        *[F.col(c).try_cast("double").alias(c) for c in rules.BAR_NUMBERS],
        F.lit("bars.csv").alias("source_file"),
    )
    plain = text_dates(bar_plan.standardize_bars(rows, RUN), "trade_date", "effective_from")
    return text_times(plain, "processing_timestamp").withColumn("effective_to", F.col("effective_to").cast("string"))


@registered
def sql_view_count(spark, sf_dir):
    return sources.sql_over(
        _silver_events(spark, sf_dir),
        "silver_events_view",
        "SELECT year_month, event_type, count(*) AS event_count FROM silver_events_view GROUP BY year_month, event_type",
    )


# --- nesting -----------------------------------------------------------------


def _flat_weather(rows: DataFrame) -> DataFrame:
    return rows.select(
        "metadata.city",
        "metadata.year",
        "metadata.month",
        "metadata.source",
        "metadata.record_count",
        "day.date",
        "day.lat",
        "day.lon",
        F.col("day.temperature.afternoon").alias("temperature"),
        F.col("day.pressure.afternoon").alias("pressure"),
        F.col("day.humidity.afternoon").alias("humidity"),
        F.col("day.cloud_cover.afternoon").alias("cloud_cover"),
        F.col("day.precipitation.total").alias("precipitation"),
        F.col("day.wind.max_speed").alias("wind_speed"),
    )


@registered
def weather_documents(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "city",
        "year",
        "month",
        "s3_key",
        "data.metadata.record_count",
        F.array_join(F.col("data.data.date"), ",").alias("dates"),
    )


@registered
def weather_flat(spark, sf_dir):
    return _flat_weather(nesting.document_days(_documents(spark, sf_dir)))


@registered
def latest_readings(spark, sf_dir):
    """Last landed value of each user and type: the re-fetch rule of documents."""
    ev = roles.events(spark, sf_dir).select("user_id", "event_type", "event_id", "value", "k")
    return nesting.last_per_key(ev, ["user_id", "event_type"], "event_id")


def _series_payloads(ev: DataFrame) -> DataFrame:
    """JSON payload per symbol and month."""
    bar = F.create_map(
        *[part for name, label in nesting.SERIES_FIELDS.items() for part in (F.lit(label), F.col(name))]
    )
    entries = F.collect_list(F.struct("timestamp", bar))
    grouped = _bar_texts(ev).groupBy("symbol", F.substring("timestamp", 1, 7).alias("month"))
    series = F.map_from_entries(entries).alias(nesting.SERIES)
    return grouped.agg(series).select("symbol", "month", F.to_json(F.struct(nesting.SERIES)).alias("value"))


def _csv_payloads(ev: DataFrame) -> DataFrame:
    """CSV payload per symbol and month."""
    line = F.concat_ws(",", *nesting.BAR_COLUMNS)
    grouped = _bar_texts(ev).groupBy("symbol", F.substring("timestamp", 1, 7).alias("month"))
    lines = grouped.agg(F.sort_array(F.collect_list(line)).alias("lines"))
    text = F.concat_ws("\n", F.lit(",".join(nesting.BAR_COLUMNS)), F.array_join("lines", "\n"))
    return lines.select("symbol", "month", text.alias("value"))


@registered
def series_map_rows(spark, sf_dir):
    rows = landing.payload_bars(_series_payloads(roles.events(spark, sf_dir)))
    return text_dates(landing.typed_bars(rows), "trade_date")


@registered
def csv_text_rows(spark, sf_dir):
    rows = landing.payload_bars(_csv_payloads(roles.events(spark, sf_dir)))
    return text_dates(landing.typed_bars(rows), "trade_date")


# --- quality -----------------------------------------------------------------


@registered
def null_profile(spark, sf_dir):
    bars = roles.gapped_bars(roles.events(spark, sf_dir))
    return quality.null_profile(bars, rules.BAR_NUMBERS)


@registered
def ticker_outcomes(spark, sf_dir):
    bars = roles.gapped_bars(roles.events(spark, sf_dir))
    return quality.outcome_by_key(bars, rules.BAR_NUMBER_RULES, "ticker")


@registered
def outcome_tally(spark, sf_dir):
    bars = roles.gapped_bars(roles.events(spark, sf_dir))
    return quality.outcome_tally(quality.outcome_by_key(bars, rules.BAR_NUMBER_RULES, "ticker"))


@registered
def clean_bars(spark, sf_dir):
    bars = roles.gapped_bars(roles.events(spark, sf_dir))
    kept = bar_plan.drop_failed(bars, quality.outcome_by_key(bars, rules.BAR_NUMBER_RULES, "ticker"))
    return text_dates(kept, "trade_date")


@registered
def rule_report_events(spark, sf_dir):
    return quality.rule_report(_silver_events(spark, sf_dir), rules.EVENT_RULES)


@registered
def rule_report_events_by_month(spark, sf_dir):
    return quality.rule_report(_silver_events(spark, sf_dir), rules.EVENT_RULES, by=["year_month"])


@registered
def rule_report_weather(spark, sf_dir):
    return quality.rule_report(_silver_weather(spark, sf_dir), rules.WEATHER_RULES)


@registered
def rule_report_raw_weather(spark, sf_dir):
    """Readings in the flat shape of the contract, humidity stretched out of range."""
    readings = roles.weather_readings(roles.events(spark, sf_dir))
    humidity = F.col("humidity.afternoon")
    flat = readings.select(
        "city",
        "lat",
        "lon",
        "date",
        F.col("cloud_cover.afternoon").alias("cloud_cover_afternoon"),
        (humidity * 1.25).alias("humidity_afternoon"),
        F.col("precipitation.total").alias("precipitation_total"),
        *[
            F.col(f"temperature.{part}").alias(f"temperature_{part}")
            for part in ("min", "max", "afternoon", "night", "evening", "morning")
        ],
        F.col("pressure.afternoon").alias("pressure_afternoon"),
        F.col("wind.max_speed").alias("wind_max_speed"),
        F.col("wind.max_direction").alias("wind_max_direction"),
        F.lit("openweathermap").alias("source"),
        F.date_format(RUN.timestamp(), TEXT).alias("ingestion_timestamp"),
        F.lit("+00:00").alias("timezone"),
    )
    return quality.rule_report(flat, rules.RAW_WEATHER_RULES)


@registered
def rule_report_bars(spark, sf_dir):
    return quality.rule_report(roles.silver_bars(roles.events(spark, sf_dir)), rules.BAR_SANITY_RULES)


@registered
def rule_report_landed_bars(spark, sf_dir):
    texts = _bar_texts(roles.events(spark, sf_dir))
    spoiled = texts.withColumns(
        {
            "open": F.when(F.col("symbol") == "error", F.lit("n/a")).otherwise(F.col("open")),
            "volume": F.when(F.col("symbol") == "signup", F.concat("volume", F.lit(".5"))).otherwise(F.col("volume")),
            "low": F.when(F.col("symbol") == "view", F.concat(F.lit("-"), F.col("low"))).otherwise(F.col("low")),
        }
    )
    return quality.rule_report(spoiled, rules.LANDED_BAR_RULES)


@registered
def rule_report_gold(spark, sf_dir):
    return quality.rule_report(_gold(spark, sf_dir), rules.gold_rules(PERIOD.start, PERIOD.end))


@registered
def quarantine_events(spark, sf_dir):
    broken = quality.quarantine(_silver_events(spark, sf_dir), rules.EVENT_RULES)
    return broken.select(
        "user_session", "event_type", F.array_join("broken_rules", ",").alias("broken_rules")
    )


@registered
def accepted_events(spark, sf_dir):
    kept = quality.without_broken(_silver_events(spark, sf_dir), rules.EVENT_RULES)
    return kept.select("user_session", "event_type", "price")


@registered
def repeated_keys(spark, sf_dir):
    ev = roles.events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return text_dates(quality.repeated_keys(ev, ["user_id", "event_type", "day"]), "day")


# --- planning ----------------------------------------------------------------


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = roles.table(spark, sf_dir, "customer")
    return customers.select(F.concat(F.lit("Site "), F.col("c_custkey").cast("string")).alias("city"))


@registered
def missing_partitions(spark, sf_dir):
    """Sites times months without an order, as documents still to fetch."""
    stored = roles.table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit(f"lake/{nesting.DOCUMENT_PREFIX}/city=site "),
            F.col("o_custkey").cast("string"),
            F.date_format("o_orderdate", "'/year='yyyy'/'MM'.json'"),
        ).alias("path")
    )
    keys = planning.document_keys(stored)
    missing = planning.missing_months(_sites(spark, sf_dir), keys, "1995-01", "2001-12")
    return missing.select("city", "year", "month", "document_key")


@registered
def missing_days(spark, sf_dir):
    """Days to fetch for weather months not stored, from written documents."""
    root = scratch_path(spark, "stored")
    readings = roles.weather_readings(roles.events(spark, sf_dir))
    weather_plan.land_documents(nesting.monthly_documents(readings, RUN), root)
    stored = sources.list_files(spark, root, "*.json")
    plan = planning.month_plan(readings.select("city").distinct(), "2023-12", "2024-03")
    missing = planning.missing_documents(plan, planning.document_inventory(stored))
    return text_dates(planning.days_to_fetch(missing).select("city", "date", "document_key"), "date")


def _landed_files(ev: DataFrame) -> DataFrame:
    """A file listing: each event is a file of its type's folder."""
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    suffix = F.when(F.col("k") % 4 == 0, F.lit(".txt")).otherwise(F.lit(".csv"))
    return ev.select(
        F.concat(F.lit("lake/bronze/alphavantage/"), "event_type", F.lit("/"), stamp, suffix).alias("path")
    )


@registered
def file_keys(spark, sf_dir):
    """Key, batch and batch time of every listed path."""
    paths = _landed_files(roles.events(spark, sf_dir))
    parsed = paths.select(
        "path",
        path_key(F.col("path")).alias("symbol"),
        path_batch(F.col("path")).alias("batch"),
        batch_time(path_batch(F.col("path"))).alias("batch_time"),
    )
    return text_times(parsed, "batch_time")


@registered
def latest_per_key(spark, sf_dir):
    return planning.latest_files(_landed_files(roles.events(spark, sf_dir)))


@registered
def allow_listed(spark, sf_dir):
    allowed = spark.createDataFrame([(t,) for t in ALLOWED_TICKERS], "ticker string")
    return planning.latest_files(_landed_files(roles.events(spark, sf_dir)), allowed=F.broadcast(allowed))


@registered
def fresh_keys(spark, sf_dir):
    """Per user: is the newest file younger than a day before the run?"""
    ev = roles.events(spark, sf_dir).withColumn("event_type", F.col("user_id").cast("string"))
    fresh = planning.freshness(_landed_files(ev), STALE_RUN.timestamp(), days=1)
    return text_times(fresh, "newest_stamp")


@registered
def symbols_to_fetch(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    listed = _landed_files(ev.withColumn("event_type", F.col("user_id").cast("string")))
    wanted = roles.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    return planning.symbols_to_fetch(wanted, planning.freshness(listed, STALE_RUN.timestamp(), days=1))


@registered
def symbols_forced(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    listed = _landed_files(ev.withColumn("event_type", F.col("user_id").cast("string")))
    wanted = ev.select(F.col("user_id").cast("string").alias("symbol")).distinct()
    forced = planning.freshness(listed, STALE_RUN.timestamp(), days=1, force_refresh=True)
    return planning.symbols_to_fetch(wanted, forced)


@registered
def fetch_outcomes(spark, sf_dir):
    """Planned days of two months against the readings that arrived."""
    readings = roles.weather_readings(roles.events(spark, sf_dir))
    plan = planning.month_plan(readings.select("city").distinct(), "2024-01", "2024-02")
    outcomes = weather_plan.fetch_outcomes(planning.days_to_fetch(plan), readings)
    return text_dates(outcomes.select("city", "date", "status", "reason", "row_count"), "date")


@registered
def city_subset(spark, sf_dir):
    root = scratch_path(spark, "weather")
    weather_plan.publish_weather(_silver_weather(spark, sf_dir), root)
    chosen = sources.only_cities(sources.read_table(spark, root), ["New York", "Sao Paulo"])
    return text_dates(chosen.select("city", "year", "observation_date", "latitude"), "observation_date")


# --- landing, publishing and reading back ------------------------------------


@registered
def landed_bars(spark, sf_dir):
    """Payloads of both formats, one refused, landed as CSV and read back."""
    ev = roles.events(spark, sf_dir)
    payloads, target = scratch_path(spark, "payloads"), scratch_path(spark, "landed")
    as_json = _series_payloads(ev.filter(F.col("event_type").isin("view", "click")))
    as_text = _csv_payloads(ev.filter(~F.col("event_type").isin("view", "click")))
    spoiled = as_text.withColumn(
        "value", F.when(F.col("symbol") == "error", F.lit("Invalid API call")).otherwise(F.col("value"))
    )
    as_json.unionByName(spoiled).write.partitionBy("symbol", "month").text(payloads)
    landing.land_payloads(spark, payloads, target, "20240215_120000")
    landed = spark.read.option("header", "true").csv(target)
    return text_dates(
        landing.typed_bars(landed.select("symbol", *nesting.BAR_COLUMNS)), "trade_date"
    )


def _spoiled_payloads(ev: DataFrame) -> DataFrame:
    """CSV payloads, three of them of no use."""
    return _csv_payloads(ev).withColumn(
        "value",
        F.when(F.col("symbol") == "error", F.lit('{"Error Message": "Invalid API call"}'))
        .when(F.col("symbol") == "signup", F.lit("Invalid API Key"))
        .when(F.col("symbol") == "click", F.regexp_replace("value", "volume", "amount"))
        .otherwise(F.col("value")),
    )


@registered
def landing_outcomes(spark, sf_dir):
    ev = roles.events(spark, sf_dir)
    return landing.inspect_payloads(_spoiled_payloads(ev)).outcomes


@registered
def landing_file_outcomes(spark, sf_dir):
    """The same spoiled payloads, a file each, some of the good ones as JSON."""
    ev = roles.events(spark, sf_dir)
    series = _series_payloads(ev).filter("symbol NOT IN ('error', 'signup', 'click', 'view')")
    texts = _spoiled_payloads(ev).select("symbol", "value").join(series.select("symbol"), "symbol", "left_anti").unionByName(series.select("symbol", "value"))
    root = scratch_path(spark, "payloads")
    texts.write.partitionBy("symbol").text(root)
    return landing.land_payloads(spark, root, scratch_path(spark, "landed"), "20240215_120000").outcomes


@registered
def bars_empty_files(spark, sf_dir):
    """The newest file of one ticker has a header only, that of another no byte: both fail, no older file counts."""
    texts = _bar_texts(roles.events(spark, sf_dir))
    root = scratch_path(spark, "bronze-bars")
    sinks.write_bar_files(texts, root, "20240214_090000")
    nothing = texts.drop("symbol").limit(0)
    for symbol, header in (("error", "true"), ("view", "false")):
        nothing.write.option("header", header).csv(f"{root}/symbol={symbol}/batch_ts=20240215_090000")
    return bar_plan.bars_to_silver(spark, root, run=RUN).outcomes


@registered
def bars_from_files(spark, sf_dir):
    """Two landed batches; only the newest one of each allowed ticker counts."""
    texts = _bar_texts(roles.events(spark, sf_dir))
    root = scratch_path(spark, "bronze-bars")
    sinks.write_bar_files(texts.withColumn("open", F.lit("0.0")), root, "20240214_090000")
    broken = texts.withColumn("close", F.when(F.col("symbol") == "error", F.lit("x")).otherwise(F.col("close")))
    sinks.write_bar_files(broken, root, "20240215_090000")
    result = bar_plan.bars_to_silver(spark, root, run=RUN)
    target = scratch_path(spark, "silver-bars")
    bar_plan.publish_bars(result.silver, target)
    stored = sources.read_table(spark, target)
    return text_dates(
        stored.select("ticker", "trade_date", "open_price", "close_price", "volume", "record_id"), "trade_date"
    )


@registered
def bars_file_outcomes(spark, sf_dir):
    texts = _bar_texts(roles.events(spark, sf_dir))
    root = scratch_path(spark, "bronze-bars")
    broken = texts.withColumn("close", F.when(F.col("symbol") == "error", F.lit("x")).otherwise(F.col("close")))
    sinks.write_bar_files(broken, root, "20240215_090000")
    return bar_plan.bars_to_silver(spark, root, tickers=["error", "view", "click"], run=RUN).outcomes


def _write_raw_events(spark: SparkSession, sf_dir: str) -> str:
    """All raw events as CSV files."""
    root = scratch_path(spark, "bronze-events")
    roles.raw_events(roles.events(spark, sf_dir)).write.option("header", "true").csv(root)
    return root


def _stored_events(spark: SparkSession, target: str) -> DataFrame:
    stored = sources.read_table(spark, target)
    return text_times(
        stored.select("event_time", "event_type", "product_id", "brand", "price", "user_id", "user_session", "record_id"),
        "event_time",
    )


def _rejected(rejected: DataFrame) -> DataFrame:
    return rejected.select("user_session", "event_type", F.array_join("broken_rules", ",").alias("broken_rules"))


@registered
def events_from_csv(spark, sf_dir):
    """CSV scan of all rows, contract, two identical publishes of what keeps it, read back."""
    result = event_plan.split_events(spark, _write_raw_events(spark, sf_dir), RUN)
    target = scratch_path(spark, "silver-events")
    event_plan.publish_events(result.accepted, target)
    event_plan.publish_events(result.accepted, target)
    return _stored_events(spark, target)


@registered
def events_rejected_from_csv(spark, sf_dir):
    return _rejected(event_plan.split_events(spark, _write_raw_events(spark, sf_dir), RUN).rejected)


DELIVERIES = 7


@registered
def events_by_source_file(spark, sf_dir):
    """Every stored row names the very file it came from: rows per delivery, and rows that stand in another one."""
    number = F.substring("user_session", 2, 20).cast("bigint")
    root = scratch_path(spark, "bronze-events")
    raw = roles.raw_events(roles.events(spark, sf_dir)).withColumn("delivery", number % DELIVERIES)
    raw.write.option("header", "true").partitionBy("delivery").csv(root)
    accepted = event_plan.split_events(spark, root, RUN).accepted
    located = accepted.select(number.alias("number"), F.regexp_extract("source_file", "/delivery=([0-9]+)/[^/]+[.]csv$", 1).cast("bigint").alias("delivery"))
    return located.groupBy("delivery").agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("number") % DELIVERIES != F.col("delivery")).alias("misplaced"))


@registered
def events_in_two_batches(spark, sf_dir):
    """Each month comes in two parts, and both parts twice: every event is there once."""
    silver = event_plan.split_events(spark, _write_raw_events(spark, sf_dir), RUN).accepted
    target = scratch_path(spark, "silver-events")
    late = F.dayofmonth("event_time") > 15
    for part in (~late, late, late, ~late):
        event_plan.publish_events(silver.filter(part), target)
    return _stored_events(spark, target)


@registered
def batch_then_stream(spark, sf_dir):
    """A batch publishes the views; the stream then adds all files to the same table."""
    source = _write_raw_events(spark, sf_dir)
    target, rejected, state = (scratch_path(spark, label) for label in ("stream", "rejected", "state"))
    silver = event_plan.split_events(spark, source, RUN).accepted
    event_plan.publish_events(silver.filter("event_type = 'view'"), target)
    ingest_events(spark, source, target, rejected, state, RUN).awaitTermination()
    return _stored_events(spark, target)


@registered
def partition_keys(spark, sf_dir):
    silver = _silver_events(spark, sf_dir)
    target = scratch_path(spark, "silver-events")
    event_plan.publish_events(silver, target, mode="append")
    return sinks.partition_keys(sources.read_table(spark, target), sinks.EVENT_PARTITIONS)


@registered
def events_append_twice(spark, sf_dir):
    """An append that is repeated doubles every row."""
    silver = _silver_events(spark, sf_dir).select("user_session", "price", "year_month", "event_type")
    target = scratch_path(spark, "silver-events")
    for _ in range(2):
        sinks.write_partitioned(silver, target, sinks.EVENT_PARTITIONS, mode="append")
    stored = sources.read_table(spark, target)
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"))


@registered
def weather_from_documents(spark, sf_dir):
    """Documents landed as JSON, read by city folders, published, read back."""
    root = scratch_path(spark, "bronze")
    weather_plan.land_documents(_documents(spark, sf_dir), root)
    paths = sources.weather_paths(f"{root}/{nesting.DOCUMENT_PREFIX}", ["all"])
    target = scratch_path(spark, "silver-weather")
    weather_plan.publish_weather(weather_plan.weather_to_silver(spark, paths), target)
    stored = sources.read_table(spark, target)
    plain = text_dates(
        stored.select("city", "year", "observation_date", "temperature_celsius", "pressure_hpa", "data_confidence_score"),
        "observation_date",
    )
    return as_double(plain, "pressure_hpa")


@registered
def streamed_events(spark, sf_dir):
    """The event stream run to the end of the files; a second run adds nothing."""
    source = _write_raw_events(spark, sf_dir)
    target, rejected, state = (scratch_path(spark, label) for label in ("stream", "rejected", "state"))
    for _ in range(2):
        ingest_events(spark, source, target, rejected, state, RUN).awaitTermination()
    return _stored_events(spark, target)


@registered
def streamed_rejects(spark, sf_dir):
    """What the stream refused, with the rules it breaks."""
    source = _write_raw_events(spark, sf_dir)
    target, rejected, state = (scratch_path(spark, label) for label in ("stream", "rejected", "state"))
    ingest_events(spark, source, target, rejected, state, RUN).awaitTermination()
    return _rejected(sources.read_table(spark, rejected))


# Characters that paths and globs treat in special ways.
ODD = ("^", "% ", "[1]", "'", "+", "x {y}")


@registered
def symbols_round_trip(spark, sf_dir):
    """Symbols with odd characters: landed, fresh, standardised and stored under one name.

    A symbol is an odd text and a nation; it has one bar, on a day of its own,
    per supplier.
    """
    key = F.col("s_suppkey")
    suppliers = roles.table(spark, sf_dir, "supplier").join(roles.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    symbol = F.concat(F.get(F.array(*map(F.lit, ODD)), (key % len(ODD)).cast("int")), F.col("n_name"))
    day = F.date_format(F.date_add(F.lit("2000-01-01"), key.cast("int")), "yyyy-MM-dd")
    line = F.concat(day, F.lit(',1.5,"2.5",0.5,2.0,"'), key.cast("string"), F.lit('"'))
    lines = suppliers.groupBy(symbol.alias("symbol")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    text = F.concat_ws("\n", F.lit('"Timestamp","open","high","low","close","volume"'), F.array_join("lines", "\n"))
    payloads, landed, target = (scratch_path(spark, label) for label in ("payloads", "landed", "silver-bars"))
    lines.select("symbol", text.alias("value")).write.partitionBy("symbol").text(payloads)
    landing.land_payloads(spark, payloads, landed, "20240131_120000")
    fresh = planning.freshness(sources.list_files(spark, landed, "*.csv"), STALE_RUN.timestamp()).select("symbol", "fresh")
    result = bar_plan.bars_to_silver(spark, landed, run=RUN)
    bar_plan.publish_bars(result.silver, target)
    stored = sources.read_table(spark, target, schema=result.silver.schema).groupBy(F.col("ticker").alias("symbol")).agg(
        F.count(F.lit(1)).alias("stored_rows"), F.sum("volume").cast("double").alias("volume")
    )
    outcomes = result.outcomes.select(F.col("ticker").alias("symbol"), "status", "row_count")
    return stored.join(fresh, "symbol", "full").join(outcomes, "symbol", "full")


@registered
def fetch_cycle(spark, sf_dir):
    """Two cycles of plan, landing and outcome; the second finds only months without a reading."""
    root = scratch_path(spark, "cycle")
    readings = roles.weather_readings(roles.events(spark, sf_dir))
    cities = readings.select("city").distinct()
    first = weather_plan.fetch_cycle(spark, cities, readings, "2023-12", "2024-03", root, RUN)
    second = weather_plan.fetch_cycle(spark, cities, readings, "2023-12", "2024-03", root, RUN)
    both = first.withColumn("cycle", F.lit(1)).unionByName(second.withColumn("cycle", F.lit(2)))
    return text_dates(both.select("cycle", "city", "date", "status"), "date")


def _write_spoiled_documents(spark: SparkSession, sf_dir: str) -> str:
    """Landed documents, those of two cities cut short or left without days."""
    docs = _documents(spark, sf_dir).withColumn("whole", F.to_json(F.struct("city", "year", "month", "data", "s3_key")))
    spoiled = docs.select(
        "city", "year", "month",
        F.when(F.col("city") == "Tokyo", F.expr("substring(whole, 1, length(whole) - 20)"))
        .when(F.col("city") == "London", F.to_json(F.struct(F.struct("data.metadata").alias("data"))))
        .otherwise(F.col("whole")).alias("value"),
    )
    root = scratch_path(spark, "documents")
    spoiled.withColumn("n", F.col("month")).drop("month").write.partitionBy("city", "year", "n").text(root)
    return root


def _by_city_month(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        F.regexp_extract("path", "city=([^/]+)/", 1).alias("city"), F.regexp_extract("path", "year=([0-9]+)/n=([0-9]+)/", 2).cast("int").alias("month"), "status", "reason", "row_count"
    )


@registered
def document_outcomes(spark, sf_dir):
    """The ledger of documents, some of them spoiled."""
    return _by_city_month(weather_plan.document_outcomes(spark, _write_spoiled_documents(spark, sf_dir)))


@registered
def documents_split(spark, sf_dir):
    """Spoiled documents are set aside and the others published: rows stored beside each outcome."""
    result = weather_plan.split_documents(spark, _write_spoiled_documents(spark, sf_dir))
    target = scratch_path(spark, "silver-weather")
    weather_plan.publish_weather(result.silver, target)
    stored = sources.read_table(spark, target).groupBy("city", F.month("observation_date").alias("month")).agg(F.count("*").alias("stored_rows"))
    outcomes = _by_city_month(result.outcomes).withColumn("place", slug(F.col("city")))
    met = outcomes.join(stored.withColumnRenamed("city", "place"), ["place", "month"], "left")
    return met.select("city", "month", "status", F.coalesce("stored_rows", F.lit(0).cast("long")).alias("stored_rows"))


AS_OF = ("2024-02-05", "2024-02-20")


@registered
def bars_as_of(spark, sf_dir):
    """Bars restated twice for some tickers, as they were known at two dates."""
    bars = roles.silver_bars(roles.events(spark, sf_dir)).select("ticker", "trade_date", "close_price")
    known = [
        (bars, "2024-02-01", 0), (bars.filter("ticker IN ('view', 'click')"), "2024-02-10", 1), (bars.filter("ticker = 'view'"), "2024-03-01", 2),
    ]
    parts = [part.withColumns({"close_price": F.col("close_price") + more, "known_from": F.to_timestamp(F.lit(day))}) for part, day, more in known]
    every = versions.close_versions(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["ticker", "trade_date"], "known_from", "known_to")
    held = staged(every, "versions")
    reads = [versions.as_of(held, F.to_timestamp(F.lit(day)), "known_from", "known_to").withColumn("as_of", F.lit(day)) for day in AS_OF]
    read = reads[0].unionByName(reads[1])
    return text_dates(read.select("as_of", "ticker", "trade_date", F.round("close_price", 6).alias("close_price")), "trade_date")


@registered
def rule_report_silver_bars(spark, sf_dir):
    """The contract of stored bars over bars that miss numbers."""
    texts = roles.gapped_bars(roles.events(spark, sf_dir)).select(
        "ticker", F.date_format("trade_date", "yyyy-MM-dd").alias("timestamp"), *rules.BAR_NUMBERS, F.lit("bars.csv").alias("source_file")
    )
    return quality.rule_report(bar_plan.standardize_bars(texts, RUN), rules.BAR_RULES)


@registered
def daily_sales_float(spark, sf_dir):
    """Revenue as a sum of doubles, the default of the pipeline, compared to six digits."""
    sales = daily.daily_sales(roles.sales_events(roles.events(spark, sf_dir)), PERIOD.start, SALES_END)
    floats = ("sales_total_revenue", "sales_avg_price", "sales_revenue_per_user")
    return text_dates(sales.withColumns({c: F.round(c, 6) for c in floats}), "date")


BATCHINGS = (1, 2, 5)


@registered
def events_any_batching(spark, sf_dir):
    """The same rows, a tenth of them twice, in 1, 2 and 5 files, every file published twice."""
    ev = roles.events(spark, sf_dir)
    doubled = ev.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("k") % 10 == 0, 2).otherwise(1))))
    events = event_plan.standardize_events(roles.raw_events(doubled), RUN, F.lit(""))
    number = F.substring("user_session", 2, 20).cast("bigint")
    silver = staged(events.withColumn("slot", number % math.lcm(*BATCHINGS)), "silver", by=["slot"])
    tables = []
    for n in BATCHINGS:
        target = scratch_path(spark, "silver-events")
        for part in [*range(n), *range(n)]:
            batch = silver.filter(F.col("slot") % n == part).drop("slot").withColumn("source_file", F.lit(f"part-{part}"))
            event_plan.publish_events(batch, target)
        tables.append(sources.read_table(spark, target, schema=events.schema).withColumn("batches", F.lit(n)))
    stored = tables[0].unionByName(tables[1]).unionByName(tables[2])
    cents = F.sum(F.rint(F.col("price") * 100).cast("bigint"))
    return stored.groupBy("batches", "year_month", "event_type").agg(F.count(F.lit(1)).alias("row_count"), cents.alias("cents"))


NOTE = 'first line\nsecond "line", end'


@registered
def bars_with_line_breaks(spark, sf_dir):
    """Files of two header orders, with a quoted cell that holds a line break, a comma and quotes."""
    texts = _bar_texts(roles.events(spark, sf_dir)).withColumns({"note": F.lit(NOTE), "batch_ts": F.lit("20240215_090000")})
    root = scratch_path(spark, "bronze-bars")
    turned = F.col("symbol").isin("click", "view")
    keys = list(sinks.LANDING_PARTITIONS)
    for part, order in ((turned, ["note", *reversed(nesting.BAR_COLUMNS)]), (~turned, [*nesting.BAR_COLUMNS, "note"])):
        options = {"header": "true", "escape": '"'}
        sinks.write_partitioned(texts.filter(part).select(*order, *keys), root, keys, fmt="csv", sort_by=["timestamp"], options=options)
    result = bar_plan.bars_to_silver(spark, root, run=RUN)
    return text_dates(result.silver.select("ticker", "trade_date", "open_price", "close_price", "volume"), "trade_date")


@registered
def bars_out_of_order(spark, sf_dir):
    """Files that rise, fall, have a week moved to the end, or repeat days."""
    day = F.dayofmonth("timestamp")
    symbol = F.col("symbol")
    texts = _bar_texts(roles.events(spark, sf_dir))
    copies = F.when((symbol == "signup") & (day % 7 == 0), 2).otherwise(1)
    place = F.when(symbol == "error", -day).when((symbol == "view") & (day <= 7), day + 100).otherwise(day)
    rows = texts.withColumns({"place": place, "copy": F.explode(F.sequence(F.lit(1), copies)), "batch_ts": F.lit("20240215_090000")})
    root = scratch_path(spark, "bronze-bars")
    whole = rows.repartition("symbol").sortWithinPartitions("symbol", "batch_ts", "place")
    whole.write.option("header", "true").partitionBy(*sinks.LANDING_PARTITIONS).csv(root)
    return bar_plan.order_outcomes(spark, root)


@registered
def manifest_agrees(spark, sf_dir):
    """Two landings, the second without a symbol: what the manifest knows against a listing."""
    texts = _bar_texts(roles.events(spark, sf_dir))
    root, record = scratch_path(spark, "landed"), scratch_path(spark, "manifest")
    for batch, part in (("20240214_090000", texts), ("20240215_090000", texts.filter("symbol <> 'error'"))):
        for _ in range(2):  # a landing that is repeated replaces its own files and rows
            sinks.write_bar_files(part, root, batch)
            manifest.record_landing(spark, root, record, batch)
    recorded = manifest.landed_files(spark, record)
    newest = planning.latest_batch_files(recorded, key="symbol").select("symbol", path_batch(F.col("path")).alias("recorded_batch"))
    sides = manifest.disagreements(sources.list_files(spark, root, "*.csv"), recorded).withColumnRenamed("key", "symbol")
    return sides.join(newest, "symbol", "left")


@registered
def daily_market_merged(spark, sf_dir):
    """The market figures from states of three batches."""
    bars = roles.silver_bars(roles.events(spark, sf_dir)).withColumn("part", F.length("ticker") % 3)
    parts = states.market_states(bars, PERIOD.tickers, MARKET_START, MARKET_END, by=["part"])
    per_day = states.market_of(states.merge_market_states(parts))
    return text_dates(rounded(per_day, *_MARKET_FLOATS), "date")


@registered
def daily_sales_merged(spark, sf_dir):
    """Sales from states of five batches; users and products within three standard errors of the exact counts."""
    sales = roles.sales_events(roles.events(spark, sf_dir))
    parts = states.sales_states(sales.withColumn("part", F.col("user_id") % 5), by=["part"])
    merged = states.sales_of(states.merge_sales_states(parts))
    exact = sales.groupBy(F.to_date("event_time").alias("date")).agg(F.count_distinct("user_id").alias("users"), F.count_distinct("product_id").alias("products"))
    error = 3 * 1.04 / 2 ** (states.LG_K / 2)
    near = lambda estimate, n: F.abs(F.col(estimate) - F.col(n)) <= F.col(n) * error + 1
    return text_dates(
        merged.join(exact, "date").select(
            "date", "sales_event_count", F.round("sales_total_revenue", 2).alias("sales_total_revenue"), F.round("sales_avg_price", 6).alias("sales_avg_price"),
            near("sales_unique_users", "users").alias("users_near"), near("sales_unique_products", "products").alias("products_near"),
        ),
        "date",
    )
