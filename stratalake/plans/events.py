"""Click events: raw CSV to the standardised table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import event_confidence
from ..functions.text import blank_to_null, category_levels, plain_path
from ..functions.timefeatures import to_event_time
from ..operators.lineage import Run, stamp
from ..operators.quality import QualityError, breaks_any, broken_rules, contract_gaps, missing_columns, stage_and_check
from ..schemas import RAW_EVENTS, SILVER_EVENTS, select_contract
from ..session import scratch_path
from ..sinks.tables import EVENT_PARTITIONS, write_partitioned
from ..sources.files import read_csv
from .rules import EVENT_RULES

# Fixed value: name of the source in the lineage columns.
SOURCE_SYSTEM = "EcommerceEvents"
# What differs from run to run, though the event is the same.
RUN_COLUMNS = ("processing_timestamp", "batch_id", "record_id")
EVENT_KEYS = ("event_time", "event_type", "product_id", "user_id", "user_session")


def standardize_events(
    raw: DataFrame,
    run: Run,
    source_file: Column,
    record_keys: Sequence[str] | None = EVENT_KEYS,
) -> DataFrame:
    """Type, clean, score and stamp raw events. Row by row, no shuffle.

    Ids stay 64-bit integers: as doubles, ids above 2^53 would merge.
    """
    level_1, level_2, level_3 = category_levels(F.col("category_code"))
    typed = raw.select(
        to_event_time(F.col("event_time")).alias("event_time"),
        "event_type",
        F.col("product_id").try_cast("bigint").alias("product_id"),
        F.col("category_id").try_cast("bigint").alias("category_id"),
        level_1.alias("category_level_1"),
        level_2.alias("category_level_2"),
        level_3.alias("category_level_3"),
        blank_to_null(F.col("brand")).alias("brand"),
        F.col("price").try_cast("double").alias("price"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        "user_session",
        source_file.alias("source_file"),
    )
    derived = typed.withColumns(
        {
            "year_month": F.date_format("event_time", "yyyy-MM"),
            "data_confidence_score": event_confidence(),
        }
    )
    stamped = stamp(
        derived, run, SOURCE_SYSTEM, F.col("source_file"), record_keys, "event_time", "timestamp"
    )
    return select_contract(stamped, SILVER_EVENTS)


@dataclass(frozen=True)
class EventsResult:
    """Events that keep the contract, and the others with the rules they break."""

    accepted: DataFrame
    rejected: DataFrame


def split_events(
    spark: SparkSession,
    path: str | Sequence[str],
    run: Run | None = None,
    record_keys: Sequence[str] | None = EVENT_KEYS,
    max_rejected: float = 1.0,
) -> EventsResult:
    """Read and standardise all events below a path once and part them by the contract.

    Raises if more than ``max_rejected`` of the rows break it, for a missing path
    or missing columns, and if there are no rows.
    """
    held, result = _held_events(spark, path, run, record_keys)
    rejected = held.filter(breaks_any(EVENT_RULES)).withColumn("broken_rules", broken_rules(EVENT_RULES))
    if max_rejected < 1 and rejected.count() > max_rejected * result.rows:
        result.require("events")
    return EventsResult(held.filter(~breaks_any(EVENT_RULES)), rejected)


def events_to_silver(
    spark: SparkSession,
    path: str | Sequence[str],
    run: Run | None = None,
    record_keys: Sequence[str] | None = EVENT_KEYS,
) -> DataFrame:
    """Read, standardise and check all events below a path.

    Returns the checked table. Raises for a missing path, missing columns, no
    rows, or any row that breaks the contract.
    """
    held, result = _held_events(spark, path, run, record_keys)
    result.require("events")
    return held


def _held_events(spark: SparkSession, path: str | Sequence[str], run: Run | None, record_keys: Sequence[str] | None):
    raw = read_csv(spark, path)
    absent = missing_columns(raw, RAW_EVENTS.fieldNames())
    if absent:
        raise QualityError(f"events: missing columns {absent}")
    silver = standardize_events(raw, run or Run(), plain_path(F.col("_metadata.file_path"), encoded=True), record_keys)
    gaps = contract_gaps(silver, SILVER_EVENTS)
    if gaps:
        raise QualityError(f"events: {gaps}")
    held, result = stage_and_check(silver, EVENT_RULES, scratch_path(spark, "events"))
    if result.rows == 0:
        raise QualityError("events: no rows")
    return held, result


def publish_events(
    silver: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "append", rebalance: bool = True
) -> None:
    """Add the events of source files the table does not hold yet, by month and type.

    An event that a file holds twice is stored twice, however files are grouped into
    batches; a file that comes again adds what is missing of it. Time order inside
    each file serves period filters.
    """
    write_partitioned(
        silver, path, EVENT_PARTITIONS, fmt=fmt, mode=mode, batch=["source_file"], run_columns=RUN_COLUMNS, sort_by=["event_time"], rebalance=rebalance
    )
