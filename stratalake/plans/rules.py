"""Row rules of every table contract."""

from __future__ import annotations

import datetime as dt

from ..operators.quality import Rule, between, not_null, one_of, required_rules
from ..schemas import SILVER_BARS, SILVER_EVENTS, SILVER_WEATHER

# Accepted values and ranges of the contracts.
EVENT_TYPES = ("view", "cart", "purchase")
GOLD_SOURCE = "daily_business_analytics"
GOLD_VERSION = "1.0"

EVENT_RULES = [
    *required_rules(SILVER_EVENTS),
    one_of("event_type", EVENT_TYPES),
    between("product_id", low=1),
    between("price", low=0),
    between("data_confidence_score", 0, 1),
]

WEATHER_RULES = [
    *required_rules(SILVER_WEATHER),
    between("year", 2020, 2030),
    between("latitude", -90, 90),
    between("longitude", -180, 180),
    between("pressure_hpa", low=0),
    between("humidity_percent", 0, 100),
    between("cloud_cover_percent", 0, 100),
    between("precipitation_mm", low=0),
    between("data_confidence_score", 0, 1),
]

BAR_RULES = required_rules(SILVER_BARS)

# A null in any of these rejects every bar of the ticker.
BAR_NUMBERS = ("open", "high", "low", "close", "volume")
BAR_NUMBER_RULES = [not_null(name) for name in BAR_NUMBERS]

# Text fields as landed. A value that does not read as its type is null after
# the try_cast and breaks the rule like a missing one.
LANDED_BAR_RULES = [
    Rule("timestamp_is_date", "timestamp", "try_cast(`timestamp` AS TIMESTAMP) IS NULL"),
    *[Rule(f"{c}_is_number", c, f"try_cast({c} AS DOUBLE) IS NULL") for c in BAR_NUMBERS[:4]],
    Rule("volume_is_integer", "volume", "try_cast(volume AS BIGINT) IS NULL OR volume LIKE '%.%'"),
    *[Rule(f"{c}_not_negative", c, f"try_cast({c} AS DOUBLE) < 0") for c in BAR_NUMBERS],
]

BAR_SANITY_RULES = [
    Rule("high_is_highest", "high_price", "high_price < greatest(low_price, open_price, close_price)"),
    Rule("low_is_lowest", "low_price", "low_price > least(open_price, close_price)"),
    *[between(c, low=0) for c in ("open_price", "high_price", "low_price", "close_price", "volume")],
]

# Fields of the flat daily weather record as delivered.
RAW_WEATHER_FIELDS = (
    "lat",
    "lon",
    "date",
    "cloud_cover_afternoon",
    "humidity_afternoon",
    "precipitation_total",
    "temperature_min",
    "temperature_max",
    "temperature_afternoon",
    "temperature_night",
    "temperature_evening",
    "temperature_morning",
    "pressure_afternoon",
    "wind_max_speed",
    "wind_max_direction",
    "source",
    "ingestion_timestamp",
    "city",
    "timezone",
)
RAW_WEATHER_INTEGERS = ("cloud_cover_afternoon", "humidity_afternoon", "pressure_afternoon", "wind_max_direction")

RAW_WEATHER_RULES = [
    *[not_null(name) for name in RAW_WEATHER_FIELDS],
    *[Rule(f"{c}_is_integer", c, f"{c} <> floor({c})") for c in RAW_WEATHER_INTEGERS],
    between("lat", -90, 90),
    between("lon", -180, 180),
    between("cloud_cover_afternoon", 0, 100),
    between("humidity_afternoon", 0, 100),
    between("wind_max_direction", 0, 360),
]


def gold_rules(start: dt.date, end: dt.date) -> list[Rule]:
    """The gate of the daily table; names and ranges are fixed values."""
    return [
        between("date", str(start), str(end)),
        not_null("sales_event_count"),
        between("sales_event_count", low=0),
        between("sales_total_revenue", low=0),
        between("market_avg_change_pct", -100, 100),
        between("market_positive_ratio", 0, 1),
        between("weather_avg_temp_c", -50, 50),
        between("weather_avg_humidity", 0, 100),
        between("day_of_week", 1, 7),
        one_of("is_weekend", [0, 1]),
        not_null("processing_timestamp"),
        one_of("data_source", [GOLD_SOURCE]),
    ]
