"""Daily weather: landed documents to the standardised table, and fetch planning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import weather_confidence
from ..functions.text import slug
from ..functions.timefeatures import to_day
from ..operators.joins import drop_listed
from ..operators.lineage import Run
from ..operators.nesting import DOCUMENT_PREFIX, document_days, monthly_documents
from ..operators.planning import days_to_fetch, document_keys, missing_months
from ..operators.quality import QualityError, breaks_any, broken_rules, contract_gaps, stage_and_check
from ..schemas import SILVER_WEATHER, WEATHER_DAY, WEATHER_METADATA, select_contract
from ..session import scratch_path, staged
from ..sinks.tables import WEATHER_PARTITIONS, write_documents, write_partitioned
from ..sources.files import list_files, read_document_texts
from .rules import WEATHER_RULES


def whole_number(value: Column) -> Column:
    """An integer, or null for a value with a fraction, which the rules then find out of range.

    -1 stands for such a value: rounding it off would let it pass.
    """
    return F.when(value == F.floor(value), value.try_cast("int")).when(value.isNotNull(), F.lit(-1))


def standardize_weather(documents: DataFrame) -> DataFrame:
    """Flatten documents to one typed and scored row per city and day."""
    flat = document_days(documents).select(
        to_day(F.col("day.date")).alias("observation_date"),
        F.col("metadata.ingestion_timestamp").try_cast("timestamp").alias("ingestion_datetime"),
        F.col("metadata.year").alias("year"),
        slug(F.col("metadata.city")).alias("city"),
        F.col("day.lat").alias("latitude"),
        F.col("day.lon").alias("longitude"),
        F.col("day.temperature.afternoon").alias("temperature_celsius"),
        F.col("day.pressure.afternoon").try_cast("bigint").alias("pressure_hpa"),
        whole_number(F.col("day.humidity.afternoon")).alias("humidity_percent"),
        F.col("day.cloud_cover.afternoon").alias("cloud_cover_percent"),
        F.col("day.precipitation.total").alias("precipitation_mm"),
        F.col("metadata.source").alias("source_system"),
    )
    return select_contract(flat.withColumn("data_confidence_score", weather_confidence()), SILVER_WEATHER)


def parsed_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, doc``: every document parsed once, as a VARIANT in the shared folder; null if it is no JSON.

    Both the ledger and the rows are read from it.
    """
    return staged(read_document_texts(spark, paths).select("path", F.try_parse_json("value").alias("doc")), "documents")


def _typed(parsed: DataFrame) -> DataFrame:
    """``path, is_json, metadata, days`` of parsed documents; what does not fit a type is null."""
    days = F.try_variant_get("doc", "$.data.data", f"array<{WEATHER_DAY.simpleString()}>")
    return parsed.select(
        "path", F.col("doc").isNotNull().alias("is_json"),
        F.try_variant_get("doc", "$.data.metadata", WEATHER_METADATA.simpleString()).alias("metadata"), F.coalesce(days, F.array()).alias("days"),
    )


def _ledger(parsed: DataFrame) -> DataFrame:
    judged = _typed(parsed).select(
        "path", "is_json", F.col("metadata").isNotNull().alias("has_metadata"), F.size("days").cast("bigint").alias("row_count"),
        F.size(F.filter("days", lambda d: to_day(d["date"]).isNull())).alias("undated"),
    )
    reason = (
        F.when(~F.col("is_json"), F.lit("unreadable"))
        .when(~F.col("has_metadata"), F.lit("no metadata"))
        .when(F.col("row_count") == 0, F.lit("no readings"))
        .when(F.col("undated") > 0, F.lit("reading without a date"))
    )
    return judged.select(
        "path", F.when(reason.isNull(), F.lit("passed")).otherwise(F.lit("failed")).alias("status"), reason.alias("reason"), "row_count"
    )


def document_outcomes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per document file whether its readings can become rows, with the reason if not."""
    return _ledger(parsed_documents(spark, paths))


@dataclass(frozen=True)
class WeatherResult:
    """Readings that keep the contract, those that break it with the rules, and an outcome per document."""

    silver: DataFrame
    rejected: DataFrame
    outcomes: DataFrame


def split_documents(spark: SparkSession, paths: str | Sequence[str], max_rejected: float = 1.0) -> WeatherResult:
    """Read all documents once and part them, and their readings, by what is wrong with them.

    Raises if more than ``max_rejected`` of the documents, or of the readings, are refused.
    """
    parsed = parsed_documents(spark, paths)
    outcomes = staged(_ledger(parsed), "document-outcomes")
    refused = outcomes.filter("status = 'failed'")
    failed, total = outcomes.agg(F.count_if(F.col("status") == "failed"), F.count("*")).first()
    if failed > max_rejected * total:
        raise QualityError(f"weather: {failed} of {total} documents, as {[(r.path, r.reason) for r in refused.limit(5).collect()]}")
    read = _typed(drop_listed(parsed, refused.select("path"), ["path"]))
    documents = read.select(F.struct("metadata", F.col("days").alias("data")).alias("data"))
    silver = standardize_weather(documents)
    gaps = contract_gaps(silver, SILVER_WEATHER)
    if gaps:
        raise QualityError(f"weather: {gaps}")
    held, result = stage_and_check(silver, WEATHER_RULES, scratch_path(spark, "weather"))
    broken = held.filter(breaks_any(WEATHER_RULES))
    if not result.passed and broken.count() > max_rejected * result.rows:
        result.require("weather")
    return WeatherResult(held.filter(~breaks_any(WEATHER_RULES)), broken.withColumn("broken_rules", broken_rules(WEATHER_RULES)), outcomes)


def weather_to_silver(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read, standardise and check all documents below the paths.

    A document that cannot be read, a reading without a date or one that breaks a
    rule raises; :func:`split_documents` sets them aside instead.
    """
    return split_documents(spark, paths, max_rejected=0.0).silver


def publish_weather(silver: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "append") -> None:
    """Add the days of documents the table does not hold yet, by city and year; a document is known by its ingestion time."""
    write_partitioned(silver, path, WEATHER_PARTITIONS, fmt=fmt, mode=mode, batch=["ingestion_datetime"], sort_by=["observation_date"])


def plan_fetch(
    spark: SparkSession, cities: DataFrame, start_month: str, end_month: str, stored_root: str
) -> DataFrame:
    """City-months that have no stored document yet."""
    stored = document_keys(list_files(spark, stored_root, "*.json"))
    return missing_months(cities, stored, start_month, end_month)


def fetch_cycle(
    spark: SparkSession, cities: DataFrame, readings: DataFrame, start_month: str, end_month: str, root: str, run: Run | None = None
) -> DataFrame:
    """Plan, land the planned readings as documents, and tell the outcome per planned day.

    ``readings`` is what the fetch delivered; months that are stored already are
    neither planned nor written again.
    """
    planned = staged(days_to_fetch(plan_fetch(spark, cities, start_month, end_month, f"{root.rstrip('/')}/{DOCUMENT_PREFIX}")), "planned")
    outcomes = staged(fetch_outcomes(planned.select("city", "year", "month", "date"), readings), "fetch-outcomes")
    dated = readings.withColumn("planned_day", to_day(F.col("date")))
    wanted = planned.select("city", F.col("date").alias("planned_day"))
    land_documents(monthly_documents(dated.join(wanted, ["city", "planned_day"], "left_semi").drop("planned_day"), run or Run()), root)
    return outcomes


def fetch_outcomes(planned_days: DataFrame, readings: DataFrame) -> DataFrame:
    """Per planned day whether a reading arrived, with the reason if not."""
    arrived = readings.select("city", to_day(F.col("date")).alias("date"), F.lit(True).alias("arrived")).distinct()
    return planned_days.join(arrived, ["city", "date"], "left").select(
        "city",
        "year",
        "month",
        "date",
        F.when(F.col("arrived"), F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
        F.when(F.col("arrived").isNull(), F.lit("no reading")).alias("reason"),
        F.coalesce(F.col("arrived").cast("bigint"), F.lit(0).cast("bigint")).alias("row_count"),
    )


def land_documents(documents: DataFrame, root: str) -> None:
    write_documents(documents, f"{root.rstrip('/')}/{DOCUMENT_PREFIX}")
