"""Pipeline inputs derived from the given tables, whole tables each time.

The ``events`` table plays raw clicks, price bars and day readings of weather;
``part`` plays the product catalogue. :data:`ORACLE` states the same
derivations as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

# ``ts`` is read with the session zone so that period filters reach the scan.
EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

# Fixed values of the derivations.
CITIES = ("New York", "London", "Los Angeles", "Tokyo", "Sao Paulo")
LATITUDES = (40.7128, 51.5074, 34.0522, 35.6762, -23.5505)
LONGITUDES = (-74.006, -0.1278, -118.2437, 139.6503, -46.6333)
FIRST_CATEGORY_ID = 3 * 2**59 + 5  # above 2^53: doubles would merge ids
FIRST_USER_ID = 2**57 + 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(EVENTS) if name == "events" else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in the JSON text ``props`` as column ``k``."""
    return table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k bigint")["k"])


def _pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def raw_events(ev: DataFrame) -> DataFrame:
    """Clicks as a CSV scan delivers them: text, with missing and blank fields."""
    k = F.col("k")
    code = (
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 11 == 0, F.lit(""))
        .when(k % 13 == 0, F.concat(F.lit("dept"), k % 5))
        .when(k % 17 == 0, F.concat_ws(".", F.concat(F.lit("dept"), k % 5), F.lit("line"), F.lit("item"), F.lit("x")))
        .otherwise(F.concat_ws(".", F.concat(F.lit("dept"), k % 5), F.concat(F.lit("line"), k % 10)))
    )
    brand = F.when(k % 9 == 0, F.lit(None)).when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("brand"), k % 20))
    return ev.select(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart")).otherwise(F.col("event_type")).alias("event_type"),
        (k + 1).cast("string").alias("product_id"),
        (k + FIRST_CATEGORY_ID).cast("string").alias("category_id"),
        code.alias("category_code"),
        brand.alias("brand"),
        F.col("value").cast("string").alias("price"),
        (F.col("user_id") + FIRST_USER_ID).cast("string").alias("user_id"),
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("user_session"),
    )


def sales_events(ev: DataFrame) -> DataFrame:
    """Clicks with the typed columns the daily aggregate needs."""
    return ev.select(
        F.col("ts").alias("event_time"),
        F.col("value").alias("price"),
        "user_id",
        (F.col("k") + 1).alias("product_id"),
    )


def raw_bars(ev: DataFrame) -> DataFrame:
    """One price bar per event type and day, opened and closed by event order."""
    return (
        ev.groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("trade_date"))
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def silver_bars(ev: DataFrame) -> DataFrame:
    """Bars under the names of the standardised table."""
    return raw_bars(ev).withColumnsRenamed(
        {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}
    )


def gapped_bars(ev: DataFrame) -> DataFrame:
    """Bars where two tickers miss numbers on some days."""
    day = F.dayofmonth("trade_date")
    return raw_bars(ev).withColumns(
        {
            "open": F.when((F.col("ticker") == "error") & (day % 7 == 0), F.lit(None)).otherwise(F.col("open")),
            "volume": F.when((F.col("ticker") == "signup") & (day % 10 == 0), F.lit(None)).otherwise(F.col("volume")),
        }
    )


def weather_readings(ev: DataFrame) -> DataFrame:
    """One nested reading per city and day: the last event of the day's users."""
    index = F.col("user_id") % len(CITIES)
    last = ev.groupBy(index.alias("site"), F.to_date("ts").alias("day")).agg(
        F.max_by("value", "event_id").alias("value"), F.max_by("k", "event_id").alias("k")
    )
    k = F.col("k")
    level = F.col("value") - 20

    def unless(condition: Column, value: Column) -> Column:
        return F.when(condition, F.lit(None).cast("double")).otherwise(value.cast("double"))

    temperature = F.struct(
        (level - 5).alias("min"),
        (level + 5).alias("max"),
        unless(k % 10 == 0, level).alias("afternoon"),
        (level - 3).alias("night"),
        (level - 1).alias("evening"),
        (level - 2).alias("morning"),
    )
    return last.select(
        _pick(CITIES, F.col("site")).alias("city"),
        _pick(LATITUDES, F.col("site")).alias("lat"),
        _pick(LONGITUDES, F.col("site")).alias("lon"),
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        temperature.alias("temperature"),
        F.struct((k + 980).cast("double").alias("afternoon")).alias("pressure"),
        F.struct(k.cast("double").alias("afternoon")).alias("humidity"),
        F.struct(unless(k % 7 == 0, k).alias("afternoon")).alias("cloud_cover"),
        F.struct(F.greatest(F.col("value") - 50, F.lit(0.0)).alias("total")).alias("precipitation"),
        F.struct((k / 10).alias("max_speed"), (k * 4).cast("double").alias("max_direction")).alias("wind"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a dotted category and a brand, some missing or blank."""
    key = F.col("p_partkey")

    def thinned(value: Column) -> Column:
        return F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, F.lit("")).otherwise(value)

    dotted = F.concat_ws(".", F.lower("p_type"), F.translate("p_name", " ", "."))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        thinned(dotted).alias("category_code"),
        F.when(key % 5 == 0, F.lit("")).when(key % 9 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("brand"),
    )


# The same derivations as common table expressions.
ORACLE = {
    "ev": """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
)""",
    "raw_events": f"""
raw_events AS (
  SELECT date_trunc('second', ts) AS event_time,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         k + 1 AS product_id,
         k + {FIRST_CATEGORY_ID} AS category_id,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN ''
              WHEN k % 13 = 0 THEN 'dept' || (k % 5)
              WHEN k % 17 = 0 THEN 'dept' || (k % 5) || '.line.item.x'
              ELSE 'dept' || (k % 5) || '.line' || (k % 10) END AS category_code,
         CASE WHEN k % 9 = 0 THEN NULL WHEN k % 5 = 0 THEN '' ELSE 'brand' || (k % 20) END AS brand,
         value AS price,
         user_id + {FIRST_USER_ID} AS user_id,
         's' || event_id AS user_session
  FROM ev
)""",
    "bars": """
bars AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS trade_date,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, CAST(count(*) AS BIGINT) AS volume
  FROM ev GROUP BY 1, 2
)""",
    "gapped": """
gapped AS (
  SELECT ticker, trade_date,
         CASE WHEN ticker = 'error' AND day(trade_date) % 7 = 0 THEN NULL ELSE open END AS open,
         high, low, close,
         CASE WHEN ticker = 'signup' AND day(trade_date) % 10 = 0 THEN NULL ELSE volume END AS volume
  FROM bars
)""",
    "readings": f"""
last_events AS (
  SELECT user_id % {len(CITIES)} AS site, CAST(ts AS DATE) AS day,
         arg_max(value, event_id) AS value, arg_max(k, event_id) AS k
  FROM ev GROUP BY 1, 2
),
readings AS (
  SELECT [{", ".join(f"'{c}'" for c in CITIES)}][site + 1] AS city,
         CAST([{", ".join(map(str, LATITUDES))}][site + 1] AS DOUBLE) AS lat,
         CAST([{", ".join(map(str, LONGITUDES))}][site + 1] AS DOUBLE) AS lon,
         day, value - 20 AS level,
         CASE WHEN k % 10 = 0 THEN NULL ELSE value - 20 END AS temp,
         k + 980 AS pressure, k AS humidity,
         CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS cloud,
         greatest(value - 50, 0.0) AS precip
  FROM last_events
)""",
    "weather": """
weather AS (
  SELECT day AS observation_date, CAST(year(day) AS INT) AS year, replace(lower(city), ' ', '_') AS city,
         lat AS latitude, lon AS longitude, temp AS temperature_celsius, pressure AS pressure_hpa,
         humidity AS humidity_percent, cloud AS cloud_cover_percent, precip AS precipitation_mm,
         round(CASE WHEN temp IS NULL THEN 0 ELSE 0.6 END + 0.1 + 0.1
               + CASE WHEN cloud IS NULL THEN 0 ELSE 0.1 END + 0.1, 2) AS data_confidence_score
  FROM readings
)""",
    "catalogue": """
catalogue AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN ''
              ELSE lower(p_type) || '.' || replace(p_name, ' ', '.') END AS category_code,
         CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END AS brand
  FROM part
)""",
}

_NEEDS = {
    "ev": [],
    "raw_events": ["ev"],
    "bars": ["ev"],
    "gapped": ["bars"],
    "readings": ["ev"],
    "weather": ["readings"],
    "catalogue": [],
}


def oracle_with(*names: str) -> str:
    """``WITH`` clause that defines the named inputs and what they build on."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in chosen:
            chosen.append(name)

    for name in names:
        add(name)
    return "WITH " + ",".join(ORACLE[name] for name in chosen)
