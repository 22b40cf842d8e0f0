"""Table contracts. Every scan uses one of these, never schema inference."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


_STR, _DBL, _INT, _BIG = StringType(), DoubleType(), IntegerType(), LongType()
_TS, _DATE = TimestampType(), DateType()

# --- raw layer ---------------------------------------------------------------

RAW_EVENTS = _struct(
    ("event_time", _STR, True),
    ("event_type", _STR, True),
    ("product_id", _STR, True),
    ("category_id", _STR, True),
    ("category_code", _STR, True),
    ("brand", _STR, True),
    ("price", _STR, True),
    ("user_id", _STR, True),
    ("user_session", _STR, True),
)

RAW_BARS = _struct(
    ("timestamp", _STR, True),
    ("open", _STR, True),
    ("high", _STR, True),
    ("low", _STR, True),
    ("close", _STR, True),
    ("volume", _STR, True),
)

# Measurements are read as double whatever they look like in one batch: a whole
# month of integers or nulls must not change the column type.
WEATHER_DAY = _struct(
    ("lat", _DBL, True),
    ("lon", _DBL, True),
    ("date", _STR, True),
    (
        "temperature",
        _struct(
            ("min", _DBL, True),
            ("max", _DBL, True),
            ("afternoon", _DBL, True),
            ("night", _DBL, True),
            ("evening", _DBL, True),
            ("morning", _DBL, True),
        ),
        True,
    ),
    ("pressure", _struct(("afternoon", _DBL, True)), True),
    ("humidity", _struct(("afternoon", _DBL, True)), True),
    ("cloud_cover", _struct(("afternoon", _DBL, True)), True),
    ("precipitation", _struct(("total", _DBL, True)), True),
    ("wind", _struct(("max_speed", _DBL, True), ("max_direction", _DBL, True)), True),
)

WEATHER_METADATA = _struct(
    ("city", _STR, True),
    ("year", _INT, True),
    ("month", _INT, True),
    ("source", _STR, True),
    ("ingestion_timestamp", _STR, True),
    ("record_count", _INT, True),
)

WEATHER_DOCUMENT = StructType(
    [
        StructField(
            "data",
            StructType(
                [
                    StructField("metadata", WEATHER_METADATA),
                    StructField("data", ArrayType(WEATHER_DAY)),
                ]
            ),
        )
    ]
)

# --- standardised layer ------------------------------------------------------

SILVER_EVENTS = _struct(
    ("event_time", _TS, False),
    ("event_type", _STR, False),
    ("product_id", _BIG, False),
    ("category_id", _BIG, True),
    ("category_level_1", _STR, True),
    ("category_level_2", _STR, True),
    ("category_level_3", _STR, True),
    ("brand", _STR, True),
    ("price", _DBL, True),
    ("user_id", _BIG, False),
    ("user_session", _STR, False),
    ("year_month", _STR, False),
    ("processing_timestamp", _TS, False),
    ("effective_from", _TS, False),
    ("effective_to", _TS, True),
    ("data_confidence_score", _DBL, False),
    ("source_system", _STR, False),
    ("source_file", _STR, False),
    ("batch_id", _STR, False),
    ("record_id", _STR, False),
)

SILVER_WEATHER = _struct(
    ("observation_date", _DATE, False),
    ("ingestion_datetime", _TS, False),
    ("year", _INT, False),
    ("city", _STR, False),
    ("latitude", _DBL, False),
    ("longitude", _DBL, False),
    ("temperature_celsius", _DBL, True),
    ("pressure_hpa", _BIG, True),
    ("humidity_percent", _INT, True),
    ("cloud_cover_percent", _DBL, True),
    ("precipitation_mm", _DBL, True),
    ("data_confidence_score", _DBL, False),
    ("source_system", _STR, False),
)

SILVER_BARS = _struct(
    ("ticker", _STR, False),
    ("trade_date", _DATE, True),
    ("open_price", _DBL, True),
    ("high_price", _DBL, True),
    ("low_price", _DBL, True),
    ("close_price", _DBL, True),
    ("volume", _DBL, True),
    ("processing_timestamp", _TS, False),
    ("effective_from", _DATE, True),
    ("effective_to", _DATE, True),
    ("source_system", _STR, False),
    ("source_file", _STR, False),
    ("batch_id", _STR, False),
    ("record_id", _STR, False),
    ("completeness_score", _DBL, False),
    ("data_confidence", _DBL, False),
)

# --- daily layer -------------------------------------------------------------

GOLD_DAILY = _struct(
    ("date", _DATE, False),
    ("sales_event_count", _BIG, False),
    ("sales_total_revenue", _DBL, False),
    ("sales_avg_price", _DBL, True),
    ("sales_unique_users", _BIG, False),
    ("sales_unique_products", _BIG, True),
    ("sales_revenue_per_user", _DBL, True),
    ("market_avg_change_pct", _DBL, False),
    ("market_volatility", _DBL, False),
    ("market_positive_ratio", _DBL, True),
    ("market_stocks_traded", _BIG, True),
    ("market_avg_volume", _DBL, True),
    ("weather_avg_temp_c", _DBL, False),
    ("weather_avg_humidity", _DBL, True),
    ("weather_avg_pressure", _DBL, True),
    ("weather_avg_cloud_cover", _DBL, True),
    ("weather_total_precipitation", _DBL, False),
    ("weather_temp_f", _DBL, True),
    ("weather_is_cold", _INT, True),
    ("weather_is_rainy", _INT, True),
    ("day_of_week", _INT, False),
    ("is_weekend", _INT, False),
    ("is_monday", _INT, False),
    ("is_friday", _INT, False),
    ("month", _INT, False),
    ("is_holiday_season", _INT, False),
    ("processing_timestamp", _TS, False),
    ("data_source", _STR, False),
    ("version", _STR, False),
)


def select_contract(df, contract: StructType):
    """Project a frame onto a contract's columns, in its order."""
    return df.select(*contract.fieldNames())
