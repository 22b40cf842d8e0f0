"""For each registered query, the SQL whose rows it must return."""

from __future__ import annotations

from ..operators.nesting import DOCUMENT_PREFIX
from ..plans.rules import BAR_NUMBERS, EVENT_TYPES, GOLD_SOURCE, GOLD_VERSION
from .queries import ALLOWED_TICKERS, MARKET_END, MARKET_START, PERIOD, RUN, SALES_END, STALE_RUN
from .roles import CITIES, oracle_with

# Months of the holiday season.
HOLIDAY_MONTHS = (11, 12, 1)

RUN_TEXT = f"{RUN.run_ts:%Y-%m-%d %H:%M:%S}"
TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)
TICKERS = ", ".join(f"'{t}'" for t in PERIOD.tickers)
TIME = "'%Y-%m-%d %H:%M:%S'"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def blank(column: str) -> str:
    return f"nullif({column}, '')"


def level(i: int, code: str = "category_code") -> str:
    return f"string_split({blank(code)}, '.')[{i}]"


# --- pieces shared by several statements -------------------------------------


def sales_cte(end: str, closed: bool = True) -> str:
    bound = f"ts <= TIMESTAMP '{end}'" if closed else f"ts < TIMESTAMP '{end}' + INTERVAL 1 DAY"
    return f"""
sales AS (
  SELECT CAST(ts AS DATE) AS date, CAST(count(*) AS BIGINT) AS sales_event_count,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sales_total_revenue,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS sales_avg_price,
         CAST(count(DISTINCT user_id) AS BIGINT) AS sales_unique_users,
         CAST(count(DISTINCT k) AS BIGINT) AS sales_unique_products,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(DISTINCT user_id), 0)
           AS sales_revenue_per_user
  FROM ev WHERE ts >= TIMESTAMP '{PERIOD.start}' AND {bound} GROUP BY 1
)"""


def market_cte(start, end, bars: str = "bars") -> str:
    return f"""
changes AS (
  SELECT trade_date AS date, ticker, volume, (close - open) / nullif(open, 0) * 100 AS change
  FROM {bars} WHERE ticker IN ({TICKERS}) AND trade_date BETWEEN DATE '{start}' AND DATE '{end}'
),
market AS (
  SELECT date, round(avg(change), 6) AS market_avg_change_pct,
         round(stddev_samp(change), 6) AS market_volatility,
         round(avg(CASE WHEN change > 0 THEN 1 ELSE 0 END), 6) AS market_positive_ratio,
         CAST(count(ticker) AS BIGINT) AS market_stocks_traded,
         round(avg(volume), 6) AS market_avg_volume
  FROM changes GROUP BY 1
)"""


def daily_weather_cte(start, end, weather: str = "weather") -> str:
    return f"""
averaged AS (
  SELECT observation_date AS date, avg(temperature_celsius) AS t, avg(humidity_percent) AS h,
         avg(pressure_hpa) AS p, avg(cloud_cover_percent) AS c, sum(precipitation_mm) AS r
  FROM {weather}
  WHERE city = '{PERIOD.city}' AND observation_date BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY 1
),
day_weather AS (
  SELECT date, t AS weather_avg_temp_c, h AS weather_avg_humidity, p AS weather_avg_pressure,
         c AS weather_avg_cloud_cover, r AS weather_total_precipitation,
         t * 9 / 5 + 32 AS weather_temp_f,
         CASE WHEN t < 10 THEN 1 ELSE 0 END AS weather_is_cold,
         CASE WHEN r > 0 THEN 1 ELSE 0 END AS weather_is_rainy
  FROM averaged
)"""


def features(column: str = "date") -> str:
    dow, month = f"(dayofweek({column}) + 1)", f"month({column})"
    return f"""
         CAST({dow} AS INT) AS day_of_week, CAST({dow} IN (1, 7) AS INT) AS is_weekend,
         CAST({dow} = 2 AS INT) AS is_monday, CAST({dow} = 6 AS INT) AS is_friday,
         CAST({month} AS INT) AS month,
         CAST({month} IN ({", ".join(map(str, HOLIDAY_MONTHS))}) AS INT) AS is_holiday_season"""


def spine(first: str, last: str) -> str:
    return f"SELECT CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS date"


def gold_cte(inputs: str, bars: str = "bars", weather: str = "weather") -> str:
    return f"""
{inputs},{sales_cte(PERIOD.end)},{market_cte(PERIOD.start, PERIOD.end, bars)},
{daily_weather_cte(PERIOD.start, PERIOD.end, weather)},
spine AS ({spine(f"DATE '{PERIOD.start}'", f"DATE '{PERIOD.end}'")}),
gold AS (
  SELECT date, coalesce(sales_event_count, 0) AS sales_event_count,
         coalesce(sales_total_revenue, 0.0) AS sales_total_revenue, sales_avg_price,
         coalesce(sales_unique_users, 0) AS sales_unique_users,
         CAST(sales_unique_products AS DOUBLE) AS sales_unique_products, sales_revenue_per_user,
         coalesce(market_avg_change_pct, 0.0) AS market_avg_change_pct,
         coalesce(market_volatility, 0.0) AS market_volatility, market_positive_ratio,
         CAST(market_stocks_traded AS DOUBLE) AS market_stocks_traded, market_avg_volume,
         coalesce(weather_avg_temp_c, 0.0) AS weather_avg_temp_c, weather_avg_humidity,
         weather_avg_pressure, weather_avg_cloud_cover,
         coalesce(weather_total_precipitation, 0.0) AS weather_total_precipitation, weather_temp_f,
         CAST(weather_is_cold AS DOUBLE) AS weather_is_cold, CAST(weather_is_rainy AS DOUBLE) AS weather_is_rainy,
         {features()},
         '{RUN_TEXT}' AS processing_timestamp, '{GOLD_SOURCE}' AS data_source, '{GOLD_VERSION}' AS version
  FROM spine LEFT JOIN sales USING (date) LEFT JOIN market USING (date) LEFT JOIN day_weather USING (date)
)"""


GOLD_INPUTS = oracle_with("bars", "weather")
GOLD = gold_cte(GOLD_INPUTS)
DAMPED_INPUTS = f"""{GOLD_INPUTS},
damped_bars AS (SELECT * REPLACE (open / 10 + 50 AS open, close / 10 + 50 AS close) FROM bars),
damped_weather AS (SELECT * REPLACE (temperature_celsius / 20 AS temperature_celsius) FROM weather)"""
DAMPED_GOLD = gold_cte(DAMPED_INPUTS, "damped_bars", "damped_weather")

SELECT_GOLD = f"SELECT * REPLACE ({day('date')} AS date) FROM gold"

SILVER_EVENTS = f"""
{oracle_with("raw_events")},
silver AS (
  SELECT event_time, event_type, product_id, category_id,
         {level(1)} AS category_level_1, {level(2)} AS category_level_2, {level(3)} AS category_level_3,
         {blank("brand")} AS brand, price, user_id, user_session,
         strftime(event_time, '%Y-%m') AS year_month,
         '{RUN_TEXT}' AS processing_timestamp, event_time AS effective_from, CAST(NULL AS VARCHAR) AS effective_to,
         CASE WHEN {level(1)} IS NULL THEN 0 ELSE 0.6 END
           + CASE WHEN {blank("brand")} IS NULL THEN 0 ELSE 0.4 END AS data_confidence_score,
         'EcommerceEvents' AS source_system, 'events.csv' AS source_file, 'batch-1' AS batch_id,
         md5(concat_ws(':', strftime(event_time, {TIME}), event_type, product_id, user_id, user_session)) AS record_id
  FROM raw_events
)"""

STORED_EVENTS = f"""{SILVER_EVENTS}
SELECT strftime(event_time, {TIME}) AS event_time, event_type, product_id, brand, price, user_id, user_session, record_id
FROM silver WHERE event_type IN ({TYPES})"""

REJECTED_EVENTS = f"""{oracle_with("raw_events")}
SELECT user_session, event_type, 'event_type_in_set' AS broken_rules FROM raw_events WHERE event_type NOT IN ({TYPES})"""

BAR_TEXT_ROWS = f"{oracle_with('bars')} SELECT ticker AS symbol, {day('trade_date')} AS trade_date, open, high, low, close, volume FROM bars"

LANDED = f"""{oracle_with("bars")}
SELECT ticker AS symbol,
       CASE WHEN ticker IN ('error', 'signup', 'click') THEN 'failed' ELSE 'passed' END AS status,
       CASE ticker WHEN 'error' THEN 'no series' WHEN 'signup' THEN 'error message'
                   WHEN 'click' THEN 'missing columns' END AS reason,
       CAST(CASE WHEN ticker IN ('error', 'signup', 'click') THEN 0 ELSE count(*) END AS BIGINT) AS row_count
FROM bars GROUP BY ticker"""

DOCUMENT_KEY = "'{prefix}/city=' || replace(lower({city}), ' ', '_') || '/year=' || {year} || '/' || lpad(CAST({month} AS VARCHAR), 2, '0') || '.json'"


def document_key(city: str, year: str, month: str) -> str:
    return DOCUMENT_KEY.format(prefix=DOCUMENT_PREFIX, city=city, year=year, month=month)


def missing(*columns: str) -> list[tuple[str, str, str]]:
    return [(f"{c}_not_null", c, f'"{c}" IS NULL') for c in columns]


def outside(column: str, condition: str, name: str = "in_range") -> tuple[str, str, str]:
    return (f"{column}_{name}", column, condition)


# The rules of every contract as ``(name, column, what breaks it)``, written out here and
# not taken from the code under test.
RULES = {
    "events": [
        *missing("event_time", "event_type", "product_id", "user_id", "user_session", "year_month", "processing_timestamp", "effective_from", "data_confidence_score", "source_system", "source_file", "batch_id", "record_id"),
        outside("event_type", "event_type NOT IN ('view', 'cart', 'purchase')", "in_set"),
        outside("product_id", "product_id < 1"),
        outside("price", "price < 0"),
        outside("data_confidence_score", "data_confidence_score < 0 OR data_confidence_score > 1"),
    ],
    "weather": [
        *missing("observation_date", "ingestion_datetime", "year", "city", "latitude", "longitude", "data_confidence_score", "source_system"),
        outside("year", "year < 2020 OR year > 2030"),
        outside("latitude", "abs(latitude) > 90"),
        outside("longitude", "abs(longitude) > 180"),
        outside("pressure_hpa", "pressure_hpa < 0"),
        outside("humidity_percent", "humidity_percent < 0 OR humidity_percent > 100"),
        outside("cloud_cover_percent", "cloud_cover_percent < 0 OR cloud_cover_percent > 100"),
        outside("precipitation_mm", "precipitation_mm < 0"),
        outside("data_confidence_score", "data_confidence_score < 0 OR data_confidence_score > 1"),
    ],
    "silver_bars": missing("ticker", "processing_timestamp", "source_system", "source_file", "batch_id", "record_id", "completeness_score", "data_confidence"),
    "bars": [
        ("high_is_highest", "high_price", "high_price < low_price OR high_price < open_price OR high_price < close_price"),
        ("low_is_lowest", "low_price", "low_price > open_price OR low_price > close_price"),
        *[outside(c, f"{c} < 0") for c in ("open_price", "high_price", "low_price", "close_price", "volume")],
    ],
    "landed_bars": [
        ("timestamp_is_date", "timestamp", 'try_cast("timestamp" AS TIMESTAMP) IS NULL'),
        *[(f"{c}_is_number", c, f"try_cast({c} AS DOUBLE) IS NULL") for c in ("open", "high", "low", "close")],
        ("volume_is_integer", "volume", "NOT regexp_full_match(volume, '-?[0-9]+')"),
        *[(f"{c}_not_negative", c, f"try_cast({c} AS DOUBLE) < 0") for c in ("open", "high", "low", "close", "volume")],
    ],
    "raw_weather": [
        *missing("lat", "lon", "date", "cloud_cover_afternoon", "humidity_afternoon", "precipitation_total", "temperature_min", "temperature_max", "temperature_afternoon", "temperature_night", "temperature_evening", "temperature_morning", "pressure_afternoon", "wind_max_speed", "wind_max_direction", "source", "ingestion_timestamp", "city", "timezone"),
        *[(f"{c}_is_integer", c, f"{c} <> floor({c})") for c in ("cloud_cover_afternoon", "humidity_afternoon", "pressure_afternoon", "wind_max_direction")],
        outside("lat", "abs(lat) > 90"),
        outside("lon", "abs(lon) > 180"),
        outside("cloud_cover_afternoon", "cloud_cover_afternoon < 0 OR cloud_cover_afternoon > 100"),
        outside("humidity_afternoon", "humidity_afternoon < 0 OR humidity_afternoon > 100"),
        outside("wind_max_direction", "wind_max_direction < 0 OR wind_max_direction > 360"),
    ],
    "gold": [
        outside("date", f"date NOT BETWEEN DATE '{PERIOD.start}' AND DATE '{PERIOD.end}'"),
        *missing("sales_event_count"),
        outside("sales_event_count", "sales_event_count < 0"),
        outside("sales_total_revenue", "sales_total_revenue < 0"),
        outside("market_avg_change_pct", "abs(market_avg_change_pct) > 100"),
        outside("market_positive_ratio", "market_positive_ratio < 0 OR market_positive_ratio > 1"),
        outside("weather_avg_temp_c", "abs(weather_avg_temp_c) > 50"),
        outside("weather_avg_humidity", "weather_avg_humidity < 0 OR weather_avg_humidity > 100"),
        outside("day_of_week", "day_of_week < 1 OR day_of_week > 7"),
        outside("is_weekend", "is_weekend NOT IN (0, 1)", "in_set"),
        *missing("processing_timestamp"),
        outside("data_source", "data_source <> 'daily_business_analytics'", "in_set"),
    ],
}


def report(prelude: str, table: str, rules: list[tuple[str, str, str]], by: str = "") -> str:
    """One row per rule."""
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    parts = []
    for name, column, broken in rules:
        count = f"CAST(count(*) FILTER (WHERE {broken}) AS BIGINT)"
        parts.append(
            f"SELECT {lead}CAST(count(*) AS BIGINT) AS rows_checked, '{name}' AS rule, "
            f"'{column}' AS \"column\", {count} AS violations, {count} = 0 AS passed FROM {table}{group}"
        )
    return prelude + "\n" + "\nUNION ALL\n".join(parts)


def outcomes(prelude: str, table: str, key: str) -> str:
    reasons = " || ".join(
        f"CASE WHEN count({c}) < count(*) THEN '{c}_not_null,' ELSE '' END" for c in BAR_NUMBERS
    )
    return f"""{prelude},
outcomes AS (
  SELECT {key}, nullif(rtrim({reasons}, ','), '') AS reason, CAST(count(*) AS BIGINT) AS row_count
  FROM {table} GROUP BY {key}
),
judged AS (
  SELECT {key}, CASE WHEN reason IS NULL THEN 'passed' ELSE 'failed' END AS status, reason, row_count FROM outcomes
)"""


TICKER_OUTCOMES = outcomes(oracle_with("gapped"), "gapped", "ticker")

LISTING = f"""{oracle_with("ev")},
listing AS (
  SELECT event_type AS key, CAST(user_id AS VARCHAR) AS user_key, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
         CASE WHEN k % 4 = 0 THEN '.txt' ELSE '.csv' END AS suffix, date_trunc('second', ts) AS seen_at
  FROM ev
)"""
FRESH = f"""{LISTING},
newest AS (SELECT user_key AS symbol, max(stamp || suffix) AS newest_batch, max(seen_at) AS seen_at FROM listing GROUP BY 1),
fresh AS (
  SELECT symbol, newest_batch, seen_at, seen_at > TIMESTAMP '{STALE_RUN.run_ts}' - INTERVAL 1 DAY AS fresh FROM newest
)"""
LATEST = f"""{LISTING}
SELECT key AS ticker, max('lake/bronze/alphavantage/' || key || '/' || stamp || suffix) AS path
FROM listing WHERE suffix = '.csv'"""

RAW_WEATHER = f"""{oracle_with("readings")},
flat AS (
  SELECT city, lat, lon, {day("day")} AS date, cloud AS cloud_cover_afternoon, humidity * 1.25 AS humidity_afternoon,
         precip AS precipitation_total, level - 5 AS temperature_min, level + 5 AS temperature_max,
         temp AS temperature_afternoon, level - 3 AS temperature_night, level - 1 AS temperature_evening,
         level - 2 AS temperature_morning, pressure AS pressure_afternoon, humidity / 10 AS wind_max_speed,
         humidity * 4 AS wind_max_direction, 'openweathermap' AS source, '{RUN_TEXT}' AS ingestion_timestamp,
         '+00:00' AS timezone
  FROM readings
)"""

LANDED_TEXTS = f"""{oracle_with("bars")},
spoiled AS (
  SELECT {day("trade_date")} AS "timestamp",
         CASE ticker WHEN 'error' THEN 'n/a' ELSE CAST(open AS VARCHAR) END AS open,
         CAST(high AS VARCHAR) AS high,
         CASE ticker WHEN 'view' THEN '-' ELSE '' END || CAST(low AS VARCHAR) AS low,
         CAST(close AS VARCHAR) AS close,
         CAST(volume AS VARCHAR) || CASE ticker WHEN 'signup' THEN '.5' ELSE '' END AS volume
  FROM bars
)"""

WEATHER_FULL = f"""{oracle_with("weather")},
stamped AS (
  SELECT *, '{RUN_TEXT}' AS ingestion_datetime, 'openweathermap' AS source_system FROM weather
)"""

CITY_DAYS = f"""{oracle_with("readings")},
wanted AS (
  SELECT city, CAST(m AS DATE) AS month_start,
         {document_key("city", "year(m)", "month(m)")} AS document_key
  FROM (SELECT DISTINCT city FROM readings),
       (SELECT unnest(generate_series(DATE '{{first}}', DATE '{{last}}', INTERVAL 1 MONTH)) AS m)
)"""


def city_days(first: str, last: str) -> str:
    return CITY_DAYS.replace("{first}", first).replace("{last}", last)


def ranked_cities() -> str:
    return ", ".join(f"'{c.lower().replace(' ', '_')}'" for c in CITIES if c in ("New York", "Sao Paulo"))


def statements() -> dict[str, str]:
    ev = oracle_with("ev")
    sales = (
        "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM sales"
    )
    return {
        "date_spine": f"""SELECT {day("date")} AS date FROM (
            {spine("min(CAST(ts AS DATE))", "max(CAST(ts AS DATE)) + 11")} FROM events)""",
        "time_features": f"""SELECT {day("date")} AS date, {features()} FROM (
            {spine("min(CAST(ts AS DATE))", "max(CAST(ts AS DATE)) + 330")} FROM events)""",
        "month_range": f"""SELECT o_orderpriority, {day("m")} AS month_start, CAST(year(m) AS INT) AS year,
              CAST(month(m) AS INT) AS month
            FROM (SELECT o_orderpriority, unnest(generate_series(date_trunc('month', min(o_orderdate)),
                    date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m
                  FROM orders GROUP BY 1)""",
        "month_days": f"""SELECT {day("m")} AS month_start, {day("d")} AS date
            FROM (SELECT m, unnest(generate_series(m, last_day(m), INTERVAL 1 DAY)) AS d
                  FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders))""",
        "daily_sales": f"{ev},{sales_cte(SALES_END)} {sales}",
        "daily_sales_whole_last_day": f"{ev},{sales_cte(SALES_END, closed=False)} {sales}",
        "daily_bars": f"""{oracle_with("bars")}
            SELECT ticker, {day("trade_date")} AS trade_date, open, high, low, close, volume FROM bars""",
        "daily_market": f"""{oracle_with("bars")},{market_cte(MARKET_START, MARKET_END)}
            SELECT * REPLACE ({day("date")} AS date) FROM market""",
        "daily_weather": f"""{oracle_with("weather")},{daily_weather_cte(MARKET_START, MARKET_END)}
            SELECT * REPLACE ({day("date")} AS date) FROM day_weather""",
        "gold_daily": f"{GOLD} {SELECT_GOLD}",
        "gold_published": f"{DAMPED_GOLD} {SELECT_GOLD}",
        "gold_incremental": f"{DAMPED_GOLD} {SELECT_GOLD}",
        "gold_preview": f"""{GOLD} SELECT {day("date")} AS date, sales_event_count, sales_total_revenue,
            market_avg_change_pct, weather_avg_temp_c FROM gold ORDER BY gold.date LIMIT 10""",
        "gold_summary": f"""{GOLD} SELECT CAST(count(*) AS BIGINT) AS row_count, {day("min(date)")} AS first_day,
            {day("max(date)")} AS last_day FROM gold""",
        "category_levels_of_products": f"""{oracle_with("catalogue")}
            SELECT p_partkey, {level(1)} AS category_level_1, {level(2)} AS category_level_2,
                   {level(3)} AS category_level_3 FROM catalogue""",
        "brand_clean": f"{oracle_with('catalogue')} SELECT p_partkey, {blank('brand')} AS brand FROM catalogue",
        "event_confidence_of_products": f"""{oracle_with("catalogue")}
            SELECT p_partkey, CASE WHEN {blank("category_code")} IS NULL THEN
                     CASE WHEN {blank("brand")} IS NULL THEN 0.0 ELSE 0.4 END
                   ELSE CASE WHEN {blank("brand")} IS NULL THEN 0.6 ELSE 1.0 END END::DOUBLE AS data_confidence_score
            FROM catalogue""",
        "weather_confidence_of_days": f"""{oracle_with("readings", "weather")}
            SELECT r.city, {day("r.day")} AS date, CAST(w.data_confidence_score AS DOUBLE) AS data_confidence_score
            FROM readings r JOIN weather w ON w.observation_date = r.day
             AND w.city = replace(lower(r.city), ' ', '_')""",
        "bar_completeness": f"""{oracle_with("gapped")}
            SELECT ticker, {day("trade_date")} AS trade_date,
                   ({" + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in BAR_NUMBERS)}) / 5.0::DOUBLE
                     AS completeness_score FROM gapped""",
        "city_slug": "SELECT o_orderkey, replace(lower(o_orderpriority), ' ', '_') AS slug FROM orders",
        "record_ids": "SELECT event_id, md5(concat_ws(':', event_id, user_id, event_type)) AS record_id FROM events",
        "json_props": f"{ev} SELECT event_id, k, '{{\"k\":' || k || '}}' AS props FROM ev",
        "silver_events": f"""{SILVER_EVENTS}
            SELECT * REPLACE (strftime(event_time, {TIME}) AS event_time,
                              strftime(effective_from, {TIME}) AS effective_from,
                              CAST(data_confidence_score AS DOUBLE) AS data_confidence_score) FROM silver""",
        "silver_weather": f"""{WEATHER_FULL}
            SELECT * REPLACE ({day("observation_date")} AS observation_date,
                              CAST(pressure_hpa AS DOUBLE) AS pressure_hpa,
                              CAST(humidity_percent AS DOUBLE) AS humidity_percent,
                              CAST(data_confidence_score AS DOUBLE) AS data_confidence_score) FROM stamped""",
        "silver_bars": f"""{oracle_with("bars")}
            SELECT ticker, {day("trade_date")} AS trade_date, open AS open_price, high AS high_price,
                   low AS low_price, close AS close_price, CAST(volume AS DOUBLE) AS volume,
                   '{RUN_TEXT}' AS processing_timestamp, {day("trade_date")} AS effective_from,
                   CAST(NULL AS VARCHAR) AS effective_to, 'AlphaVantage' AS source_system,
                   'bars.csv' AS source_file, 'batch-1' AS batch_id,
                   md5(ticker || ':' || {day("trade_date")}) AS record_id,
                   1.0::DOUBLE AS completeness_score, 1.0::DOUBLE AS data_confidence FROM bars""",
        "sql_view_count": f"""{oracle_with("raw_events")}
            SELECT strftime(event_time, '%Y-%m') AS year_month, event_type, CAST(count(*) AS BIGINT) AS event_count
            FROM raw_events GROUP BY 1, 2""",
        "weather_documents": f"""{oracle_with("readings")}
            SELECT city, CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month,
                   {document_key("city", "year(day)", "month(day)")} AS s3_key,
                   CAST(count(*) AS INT) AS record_count,
                   string_agg({day("day")}, ',' ORDER BY day) AS dates
            FROM readings GROUP BY ALL""",
        "weather_flat": f"""{oracle_with("readings")}
            SELECT city, CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month, 'openweathermap' AS source,
                   CAST(count(*) OVER (PARTITION BY city, year(day), month(day)) AS INT) AS record_count,
                   {day("day")} AS date, lat, lon, temp AS temperature, CAST(pressure AS DOUBLE) AS pressure,
                   CAST(humidity AS DOUBLE) AS humidity, cloud AS cloud_cover, precip AS precipitation, humidity / 10 AS wind_speed
            FROM readings""",
        "latest_readings": f"""{ev}
            SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value,
                   arg_max(k, event_id) AS k FROM ev GROUP BY 1, 2""",
        "series_map_rows": BAR_TEXT_ROWS,
        "csv_text_rows": BAR_TEXT_ROWS,
        "null_profile": oracle_with("gapped")
        + " UNION ALL ".join(
            f" SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS rows_checked, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM gapped"
            for c in BAR_NUMBERS
        ),
        "ticker_outcomes": f"{TICKER_OUTCOMES} SELECT ticker, status, reason, row_count FROM judged",
        "outcome_tally": f"""{TICKER_OUTCOMES}
            SELECT status, CAST(count(*) AS BIGINT) AS keys, CAST(sum(row_count) AS BIGINT) AS row_count
            FROM judged GROUP BY 1""",
        "clean_bars": f"""{TICKER_OUTCOMES}
            SELECT ticker, {day("trade_date")} AS trade_date, open, high, low, close, volume FROM gapped
            WHERE ticker NOT IN (SELECT ticker FROM judged WHERE status = 'failed')""",
        "rule_report_events": report(SILVER_EVENTS, "silver", RULES["events"]),
        "rule_report_events_by_month": report(SILVER_EVENTS, "silver", RULES["events"], by="year_month"),
        "rule_report_weather": report(WEATHER_FULL, "stamped", RULES["weather"]),
        "rule_report_raw_weather": report(RAW_WEATHER, "flat", RULES["raw_weather"]),
        "rule_report_bars": report(
            oracle_with("bars"),
            "(SELECT open AS open_price, high AS high_price, low AS low_price, close AS close_price, volume FROM bars)",
            RULES["bars"],
        ),
        "rule_report_landed_bars": report(LANDED_TEXTS, "spoiled", RULES["landed_bars"]),
        "rule_report_gold": report(GOLD, "gold", RULES["gold"]),
        "rule_report_silver_bars": report(
            f"""{oracle_with("gapped")},
            stored AS (
              SELECT ticker, '{RUN_TEXT}' AS processing_timestamp, 'AlphaVantage' AS source_system, 'bars.csv' AS source_file,
                     'batch-1' AS batch_id, md5(ticker) AS record_id, 1.0 AS completeness_score, 1.0 AS data_confidence FROM gapped)""",
            "stored",
            RULES["silver_bars"],
        ),
        "quarantine_events": f"""{oracle_with("raw_events")}
            SELECT user_session, event_type, 'event_type_in_set' AS broken_rules FROM raw_events
            WHERE event_type NOT IN ({TYPES})""",
        "accepted_events": f"""{oracle_with("raw_events")}
            SELECT user_session, event_type, price FROM raw_events WHERE event_type IN ({TYPES})""",
        "repeated_keys": f"""SELECT user_id, event_type, {day("CAST(ts AS DATE)")} AS day,
              CAST(count(*) AS BIGINT) AS copies FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        "missing_partitions": f"""
            WITH wanted AS (
              SELECT c_custkey, 'Site ' || c_custkey AS city, m
              FROM customer, (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)
            )
            SELECT city, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month,
                   {document_key("city", "year(m)", "month(m)")} AS document_key
            FROM wanted WHERE NOT EXISTS (
              SELECT 1 FROM orders WHERE o_custkey = c_custkey AND date_trunc('month', o_orderdate) = m)""",
        "missing_days": f"""{city_days("2023-12-01", "2024-03-01")}
            SELECT city, {day("d")} AS date, document_key
            FROM (SELECT city, document_key, unnest(generate_series(month_start, last_day(month_start), INTERVAL 1 DAY)) AS d
                  FROM wanted w WHERE NOT EXISTS (
                    SELECT 1 FROM readings r WHERE r.city = w.city AND date_trunc('month', r.day) = w.month_start))""",
        "file_keys": f"""{LISTING}
            SELECT 'lake/bronze/alphavantage/' || key || '/' || stamp || suffix AS path, key AS symbol,
                   stamp || suffix AS batch, strftime(seen_at, {TIME}) AS batch_time FROM listing""",
        "latest_per_key": f"{LATEST} GROUP BY 1",
        "allow_listed": f"{LATEST} AND key IN ({', '.join(repr(t) for t in ALLOWED_TICKERS)}) GROUP BY 1",
        "fresh_keys": f"""{FRESH}
            SELECT symbol, newest_batch, strftime(seen_at, {TIME}) AS newest_stamp, fresh FROM fresh""",
        "symbols_to_fetch": f"""{FRESH}
            SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer
            WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT symbol FROM fresh WHERE fresh)""",
        "symbols_forced": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events",
        "fetch_outcomes": f"""{city_days("2024-01-01", "2024-02-01")}
            SELECT w.city, {day("w.d")} AS date,
                   CASE WHEN r.day IS NULL THEN 'failed' ELSE 'passed' END AS status,
                   CASE WHEN r.day IS NULL THEN 'no reading' END AS reason,
                   CAST(CASE WHEN r.day IS NULL THEN 0 ELSE 1 END AS BIGINT) AS row_count
            FROM (SELECT city, CAST(unnest(generate_series(month_start, last_day(month_start), INTERVAL 1 DAY)) AS DATE) AS d
                  FROM wanted) w LEFT JOIN readings r ON r.city = w.city AND r.day = w.d""",
        "city_subset": f"""{oracle_with("weather")}
            SELECT city, year, {day("observation_date")} AS observation_date, latitude FROM weather
            WHERE city IN ({ranked_cities()})""",
        "landed_bars": f"{BAR_TEXT_ROWS} WHERE ticker <> 'error'",
        "landing_outcomes": LANDED,
        "landing_file_outcomes": LANDED,
        "bars_empty_files": f"""{oracle_with("bars")}
            SELECT ticker, CASE WHEN ticker IN ('error', 'view') THEN 'failed' ELSE 'passed' END AS status,
                   CASE WHEN ticker IN ('error', 'view') THEN 'no rows' END AS reason,
                   CAST(CASE WHEN ticker IN ('error', 'view') THEN 0 ELSE count(*) END AS BIGINT) AS row_count
            FROM bars GROUP BY ticker""",
        "bars_from_files": f"""{oracle_with("bars")}
            SELECT ticker, {day("trade_date")} AS trade_date, open AS open_price, close AS close_price,
                   CAST(volume AS DOUBLE) AS volume, md5(ticker || ':' || {day("trade_date")}) AS record_id
            FROM bars WHERE ticker <> 'error'""",
        "bars_file_outcomes": f"""{oracle_with("bars")}
            SELECT ticker, CASE ticker WHEN 'error' THEN 'failed' ELSE 'passed' END AS status,
                   CASE ticker WHEN 'error' THEN 'close_not_null' END AS reason, CAST(count(*) AS BIGINT) AS row_count
            FROM bars WHERE ticker IN ('error', 'view', 'click') GROUP BY ticker""",
        "events_from_csv": STORED_EVENTS,
        "events_by_source_file": f"""
            SELECT CAST(substr(user_session, 2) AS BIGINT) % 7 AS delivery, CAST(count(*) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS misplaced
            FROM ({STORED_EVENTS}) GROUP BY 1""",
        "streamed_events": STORED_EVENTS,
        "events_in_two_batches": STORED_EVENTS,
        "batch_then_stream": STORED_EVENTS,
        "events_rejected_from_csv": REJECTED_EVENTS,
        "streamed_rejects": REJECTED_EVENTS,
        "symbols_round_trip": """
            SELECT ['^', '% ', '[1]', '''', '+', 'x {y}'][s_suppkey % 6 + 1] || n_name AS symbol,
                   CAST(count(*) AS BIGINT) AS stored_rows, CAST(sum(s_suppkey) AS DOUBLE) AS volume, true AS fresh,
                   'passed' AS status, CAST(count(*) AS BIGINT) AS row_count
            FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
        "fetch_cycle": f"""{city_days("2023-12-01", "2024-03-01")},
            days AS (
              SELECT city, month_start, CAST(unnest(generate_series(month_start, last_day(month_start), INTERVAL 1 DAY)) AS DATE) AS d FROM wanted
            ),
            first_cycle AS (
              SELECT d.*, CASE WHEN r.day IS NULL THEN 'failed' ELSE 'passed' END AS status
              FROM days d LEFT JOIN readings r ON r.city = d.city AND r.day = d.d
            )
            SELECT CAST(1 AS INT) AS cycle, city, {day("d")} AS date, status FROM first_cycle
            UNION ALL
            SELECT CAST(2 AS INT), city, {day("d")}, status FROM first_cycle f WHERE NOT EXISTS (
              SELECT 1 FROM first_cycle p WHERE p.city = f.city AND p.month_start = f.month_start AND p.status = 'passed')""",
        "document_outcomes": f"""{oracle_with("readings")}
            SELECT city, CAST(month(day) AS INT) AS month,
                   CASE WHEN city IN ('Tokyo', 'London') THEN 'failed' ELSE 'passed' END AS status,
                   CASE city WHEN 'Tokyo' THEN 'unreadable' WHEN 'London' THEN 'no readings' END AS reason,
                   CAST(CASE WHEN city IN ('Tokyo', 'London') THEN 0 ELSE count(*) END AS BIGINT) AS row_count
            FROM readings GROUP BY city, year(day), month(day)""",
        "daily_sales_float": f"""{ev},{sales_cte(SALES_END)}
            SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date, round(sales_total_revenue, 6) AS sales_total_revenue,
                   round(sales_avg_price, 6) AS sales_avg_price, round(sales_revenue_per_user, 6) AS sales_revenue_per_user) FROM sales""",
        "partition_keys": f"""{oracle_with("raw_events")}
            SELECT DISTINCT strftime(event_time, '%Y-%m') AS year_month, event_type FROM raw_events""",
        "events_any_batching": f"""{ev}, sizes AS (SELECT unnest([1, 2, 5]) AS batches)
            SELECT batches, strftime(ts, '%Y-%m') AS year_month, CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
                   CAST(sum(CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS row_count,
                   CAST(sum(CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END * CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM ev CROSS JOIN sizes GROUP BY 1, 2, 3""",
        "bars_with_line_breaks": f"""{oracle_with("bars")}
            SELECT ticker, {day("trade_date")} AS trade_date, open AS open_price, close AS close_price, CAST(volume AS DOUBLE) AS volume FROM bars""",
        "bars_out_of_order": f"""{oracle_with("bars")}, placed AS (
              SELECT ticker, trade_date, CASE WHEN ticker = 'error' THEN -day(trade_date)
                       WHEN ticker = 'view' AND day(trade_date) <= 7 THEN day(trade_date) + 100 ELSE day(trade_date) END AS place
              FROM bars
              UNION ALL SELECT ticker, trade_date, day(trade_date) AS place FROM bars WHERE ticker = 'signup' AND day(trade_date) % 7 = 0
            ), steps AS (
              SELECT ticker, trade_date - lag(trade_date) OVER (PARTITION BY ticker ORDER BY place) AS step FROM placed
            ), counted AS (
              SELECT ticker, count(*) AS n, count(*) FILTER (step > 0) AS up, count(*) FILTER (step < 0) AS down, count(*) FILTER (step = 0) AS level
              FROM steps GROUP BY ticker
            )
            SELECT ticker, CASE WHEN least(up, down) + level > 0 THEN 'failed' ELSE 'passed' END AS status,
                   CAST(n AS BIGINT) AS row_count, CAST(least(up, down) + level AS BIGINT) AS out_of_order FROM counted""",
        "manifest_agrees": f"""{oracle_with("bars")}
            SELECT DISTINCT ticker AS symbol, CAST(CASE ticker WHEN 'error' THEN 1 ELSE 2 END AS BIGINT) AS agreed,
                   CAST(0 AS BIGINT) AS only_listed, CAST(0 AS BIGINT) AS only_recorded, CAST(0 AS BIGINT) AS other_length,
                   CASE ticker WHEN 'error' THEN '20240214_090000' ELSE '20240215_090000' END AS newest_batch,
                   CASE ticker WHEN 'error' THEN '20240214_090000' ELSE '20240215_090000' END AS recorded_batch
            FROM bars""",
        "daily_market_merged": f"""{oracle_with("bars")},{market_cte(MARKET_START, MARKET_END)}
            SELECT * REPLACE ({day("date")} AS date) FROM market""",
        "daily_sales_merged": f"""{ev}
            SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS sales_event_count,
                   CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sales_total_revenue,
                   round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value), 6) AS sales_avg_price,
                   true AS users_near, true AS products_near
            FROM ev GROUP BY 1""",
        "documents_split": f"""{oracle_with("readings")}
            SELECT city, CAST(month(day) AS INT) AS month, CASE WHEN city IN ('Tokyo', 'London') THEN 'failed' ELSE 'passed' END AS status,
                   CAST(CASE WHEN city IN ('Tokyo', 'London') THEN 0 ELSE count(*) END AS BIGINT) AS stored_rows
            FROM readings GROUP BY city, year(day), month(day)""",
        "bars_as_of": f"""{oracle_with("bars")}
            SELECT '2024-02-05' AS as_of, ticker, {day("trade_date")} AS trade_date, round(close, 6) AS close_price FROM bars
            UNION ALL
            SELECT '2024-02-20', ticker, {day("trade_date")}, round(close + CASE WHEN ticker IN ('view', 'click') THEN 1 ELSE 0 END, 6) FROM bars""",
        "events_append_twice": f"""{oracle_with("raw_events")}
            SELECT event_type, CAST(2 * count(*) AS BIGINT) AS row_count FROM raw_events GROUP BY 1""",
        "weather_from_documents": f"""{oracle_with("weather")}
            SELECT city, year, {day("observation_date")} AS observation_date, temperature_celsius,
                   CAST(pressure_hpa AS DOUBLE) AS pressure_hpa,
                   CAST(data_confidence_score AS DOUBLE) AS data_confidence_score FROM weather""",
    }
