"""Daily price bars: landed files to the standardised table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import filled_ratio
from ..functions.timefeatures import to_day
from ..operators.joins import drop_listed
from ..operators.lineage import Run, stamp
from ..operators.nesting import BAR_COLUMNS, cell, header_names, header_positions
from ..operators.order import order_report
from ..operators.planning import latest_batch_files
from ..operators.quality import QualityError, Rule, contract_gaps, outcome_by_key, repeated_keys, stage_and_check
from ..schemas import SILVER_BARS, select_contract
from ..session import scratch_path, staged
from ..sinks.tables import BAR_PARTITIONS, write_partitioned
from ..sources.delimited import read_delimited
from ..sources.files import list_files
from .rules import BAR_NUMBER_RULES, BAR_NUMBERS, BAR_RULES

# Fixed value: name of the source in the lineage columns.
SOURCE_SYSTEM = "AlphaVantage"
BAR_KEYS = ("ticker", "trade_date")

COLUMN_RULE = Rule("columns_present", "timestamp", "NOT columns_present")
DAY_RULE = Rule("timestamp_is_date", "timestamp", "columns_present AND try_cast(`timestamp` AS TIMESTAMP) IS NULL")
REPEATED_DAY = "day_unique"


def _with_repeated_days(outcomes: DataFrame, rows: DataFrame) -> DataFrame:
    """Outcomes where a ticker that has a day twice fails as well."""
    days = rows.select("ticker", to_day(F.col("timestamp")).alias("day")).filter(F.col("day").isNotNull())
    twice = repeated_keys(days, ["ticker", "day"]).select("ticker", F.lit(True).alias("twice")).distinct()
    reason = F.concat_ws(",", "reason", F.when(F.col("twice"), F.lit(REPEATED_DAY)))
    return outcomes.join(twice, "ticker", "left").select(
        "ticker",
        F.when(F.col("twice"), F.lit("failed")).otherwise(F.col("status")).alias("status"),
        F.nullif(reason, F.lit("")).alias("reason"),
        "row_count",
    )


@dataclass(frozen=True)
class BarsResult:
    """Bars that passed, and one outcome row per ticker that had a file."""

    silver: DataFrame
    outcomes: DataFrame


def bar_rows(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Records of the listed CSV files (``ticker, path``), each field found by name in its file's own header.

    A header is parsed once per file. ``split`` and ``place`` tell the order in the file.
    """
    records = read_delimited(spark, root, files, "ticker", header_positions(header_names(F.col("header"))))
    found = F.lit(True)
    for name in BAR_COLUMNS:
        found = found & (F.col(f"at_{name}") > 0)
    cells = F.col("cells")
    return records.select(
        "ticker",
        F.col("path").alias("source_file"),
        "split",
        "place",
        found.alias("columns_present"),
        cell(cells, "timestamp").alias("timestamp"),
        *[cell(cells, c).try_cast("double").alias(c) for c in BAR_NUMBERS],
    )


def standardize_bars(rows: DataFrame, run: Run, record_keys: Sequence[str] | None = BAR_KEYS) -> DataFrame:
    """Rename, score and stamp typed bars (``ticker, timestamp, open … volume, source_file``)."""
    typed = rows.withColumn("trade_date", to_day(F.col("timestamp"))).withColumnsRenamed(
        {"open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price"}
    )
    score = filled_ratio()
    scored = typed.withColumns({"completeness_score": score, "data_confidence": score})
    stamped = stamp(scored, run, SOURCE_SYSTEM, F.col("source_file"), record_keys, "trade_date", "date")
    return select_contract(stamped, SILVER_BARS)


def drop_failed(rows: DataFrame, outcomes: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows of the keys that passed.

    Only the failed keys travel; staged, they are known to be few or many.
    """
    failed = staged(outcomes.filter("status = 'failed'").select(key), "failed")
    return drop_listed(rows, failed, [key])


def _newest_files(spark: SparkSession, root: str, tickers: Sequence[str] | None, landed: DataFrame | None) -> DataFrame:
    """``ticker, path`` of the newest batch of each ticker, staged so that its size is known."""
    allowed = None
    if tickers is not None:
        allowed = staged(spark.createDataFrame([(t,) for t in tickers], "ticker string"), "tickers")
    listed = list_files(spark, root, "*.csv") if landed is None else landed
    return staged(latest_batch_files(listed, allowed=allowed), "newest")


def order_outcomes(
    spark: SparkSession, root: str, tickers: Sequence[str] | None = None, landed: DataFrame | None = None
) -> DataFrame:
    """Per ticker whether the days of its newest files go strictly one way, and how many do not."""
    rows = bar_rows(spark, root, _newest_files(spark, root, tickers, landed))
    dated = rows.select("ticker", F.col("source_file").alias("path"), "split", "place", to_day(F.col("timestamp")).alias("day"))
    return order_report(staged(dated, "days"), "ticker", "day").select(
        "ticker", F.when(F.col("out_of_order") > 0, F.lit("failed")).otherwise(F.lit("passed")).alias("status"), F.col("values").alias("row_count"), "out_of_order"
    )


def bars_to_silver(
    spark: SparkSession,
    root: str,
    tickers: Sequence[str] | None = None,
    run: Run | None = None,
    landed: DataFrame | None = None,
) -> BarsResult:
    """Standardise the newest file of every ticker (or of the named ones).

    ``landed`` (``path``) is what a manifest knows of the folder, which is listed
    without it. Headers may differ from file to file, cells may hold line breaks,
    and a large file is read by many tasks. A ticker whose file lacks a column, is empty, has no
    rows, holds an unreadable number or day, or has a day twice fails as a whole;
    the others go on. What is left keeps the contract of the table.
    """
    files = _newest_files(spark, root, tickers, landed)
    rows = bar_rows(spark, root, files)
    held, _ = stage_and_check(rows, BAR_NUMBER_RULES, scratch_path(spark, "bars"))
    by_ticker = outcome_by_key(held, [COLUMN_RULE, *BAR_NUMBER_RULES, DAY_RULE], "ticker")
    by_ticker = staged(_with_repeated_days(by_ticker, held), "outcomes")
    outcomes = (
        files.select("ticker")
        .distinct()
        .join(by_ticker, "ticker", "left")
        .select(
            "ticker",
            F.coalesce("status", F.lit("failed")).alias("status"),
            F.when(F.col("status").isNull(), F.lit("no rows")).otherwise(F.col("reason")).alias("reason"),
            F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        )
    )
    silver = standardize_bars(drop_failed(held, by_ticker), run or Run())
    gaps = contract_gaps(silver, SILVER_BARS)
    if gaps:
        raise QualityError(f"bars: {gaps}")
    silver, result = stage_and_check(silver, BAR_RULES, scratch_path(spark, "silver-bars"))
    result.require("bars")
    return BarsResult(silver, outcomes)


def publish_bars(silver: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "replace") -> None:
    """A ticker's newest file holds its whole history, so it replaces the ticker; ``append`` adds new days."""
    write_partitioned(silver, path, BAR_PARTITIONS, fmt=fmt, mode=mode, keys=["record_id"], sort_by=["trade_date"])
