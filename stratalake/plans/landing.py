"""Price payloads as delivered: sanity checks, rows, and landing as CSV."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_key
from ..operators.joins import drop_listed
from ..operators.nesting import BAR_COLUMNS, cell, header_names, header_positions, item_rows, payload_bars, payload_items, series_of, text_lines
from ..operators.quality import outcome_by_key, stage_and_check
from ..session import scratch_path, staged
from ..sinks.tables import write_bar_files
from ..sources.delimited import csv_profiles, read_delimited, whole_texts
from ..sources.files import list_files
from ..sources.manifest import record_landing
from .bars import drop_failed
from .rules import LANDED_BAR_RULES

# Texts that mark a payload as an error message.
ERROR_TEXTS = ("Error Message", "Invalid API call", "Invalid API Key")


def _error_text(value: Column) -> Column:
    """Whether a text holds one of the texts of an error message."""
    return functools.reduce(operator.or_, [value.contains(text) for text in ERROR_TEXTS])


def table_problem(error: Column, lines: Column, names: Column) -> Column:
    """Why a CSV payload cannot hold bars, by its error texts, number of lines and header; null if it can."""
    expected = F.array(*map(F.lit, BAR_COLUMNS))
    return (
        F.when(error, F.lit("error message"))
        .when(lines < 2, F.lit("too short"))
        .when(F.size(F.array_except(expected, names)) > 0, F.lit("missing columns"))
        .when(F.size(F.array_except(F.array_compact(names), expected)) > 0, F.lit("unexpected columns"))
    )


def payload_problem(payload: Column) -> Column:
    """Why a payload cannot hold bars; null if it can."""
    # A text that begins with a quoted header would parse as a JSON string.
    is_json = F.ltrim(payload).rlike(r"^[{\[]") & F.try_parse_json(payload).isNotNull()
    series = series_of(payload)
    lines = text_lines(payload)
    return (
        F.when(F.trim(F.coalesce(payload, F.lit(""))) == "", F.lit("empty"))
        .when(is_json & series.isNull(), F.lit("no series"))
        .when(is_json & (F.size(series) == 0), F.lit("too short"))
        .when(is_json, F.lit(None))
        .otherwise(table_problem(_error_text(payload), F.size(lines), header_names(F.get(lines, F.lit(0)))))
    )


@dataclass(frozen=True)
class LandingResult:
    """Bars of the symbols that passed, and one outcome row per payload symbol."""

    bars: DataFrame
    outcomes: DataFrame


def inspect_payloads(payloads: DataFrame) -> LandingResult:
    """Check payloads and their bars; a symbol with any problem fails as a whole.

    Each payload is judged and cut into bars once; that columnar copy serves the
    refusals, the check per symbol and the landing.
    """
    return _checked(*_cut(payloads))


def _cut(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars of the payloads that can hold some, and an outcome for each of the others."""
    value = F.col("value")
    judged = payloads.withColumn("problem", payload_problem(value))
    cut = judged.select(
        "symbol", "problem", F.get(text_lines(value), F.lit(0)).alias("header"), F.when(F.col("problem").isNull(), payload_items(value)).alias("items")
    )
    held = staged(cut, "payloads")
    bars = item_rows(held.filter(F.col("problem").isNull()), ["symbol"]).select("symbol", *BAR_COLUMNS)
    return bars, _refused(held)


def _refused(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("problem").isNotNull()).select(
        "symbol",
        F.lit("failed").alias("status"),
        F.col("problem").alias("reason"),
        F.lit(0).cast("bigint").alias("row_count"),
    )


def _checked(bars: DataFrame, refused: DataFrame) -> LandingResult:
    """Bars held against their rules; a symbol with a broken bar or a refused payload fails as a whole."""
    checked, _ = stage_and_check(bars, LANDED_BAR_RULES, scratch_path(bars.sparkSession, "payload-bars"))
    outcomes = staged(_per_symbol(outcome_by_key(checked, LANDED_BAR_RULES, "symbol").unionByName(refused)), "outcomes")
    return LandingResult(drop_failed(checked, outcomes, "symbol"), outcomes)


def _per_symbol(outcomes: DataFrame) -> DataFrame:
    """Fold the outcomes of a symbol's payloads: one failure fails the symbol."""
    return outcomes.groupBy("symbol").agg(
        F.min("status").alias("status"),
        F.nullif(F.array_join(F.array_sort(F.collect_set("reason")), ","), F.lit("")).alias("reason"),
        F.sum("row_count").alias("row_count"),
    )


def with_skipped(outcomes: DataFrame, fresh: DataFrame) -> DataFrame:
    """Outcomes of a batch, counting symbols that were fresh and not fetched as passed."""
    skipped = fresh.filter("fresh").select(
        "symbol",
        F.lit("passed").alias("status"),
        F.lit("fresh").alias("reason"),
        F.lit(0).cast("bigint").alias("row_count"),
    )
    return outcomes.unionByName(drop_listed(skipped, outcomes, ["symbol"]))


def land_payloads(
    spark: SparkSession, payload_root: str, target: str, batch_ts: str, manifest: str | None = None
) -> LandingResult:
    """Read one payload per file, land the good ones as CSV under the batch stamp and record them.

    One scan of the lines tells the kind of every file. CSV files are judged by that
    and read by Spark's reader, a large one by many tasks; only JSON payloads, which
    mean something as a whole only, are put together in a row each.
    """
    files = staged(list_files(spark, payload_root).select(path_key(F.col("path")).alias("symbol"), "path"), "payload-files")
    profiles = csv_profiles(spark, payload_root, files, error=_error_text(F.col("value")))
    header = F.col("header")
    kinds = files.join(profiles, "path", "left").withColumn("json", F.coalesce(F.ltrim(header).rlike(r"^[{\[]"), F.lit(False)))
    problem = F.when(header.isNull(), F.lit("empty")).when(~F.col("json"), table_problem(F.col("error"), F.col("lines"), header_names(header)))
    known = staged(kinds.withColumn("problem", problem), "payload-kinds")
    tables = known.filter("NOT json AND problem IS NULL")
    records = read_delimited(
        spark, payload_root, tables, "symbol", header_positions(header_names(header)), tables.select("path", "header", "broken")
    )
    listed = records.select("symbol", *[cell(F.col("cells"), name).alias(name) for name in BAR_COLUMNS])
    documents = known.filter("json")
    bars, refused = _cut(whole_texts(spark, payload_root, documents).join(documents.select("path", "symbol"), "path").select("symbol", "value"))
    result = _checked(listed.unionByName(bars), _refused(known).unionByName(refused))
    write_bar_files(result.bars.select("symbol", *BAR_COLUMNS), target, batch_ts)
    if manifest:
        record_landing(spark, target, manifest, batch_ts)
    return result


def typed_bars(bars: DataFrame) -> DataFrame:
    """Checked text bars with numbers and dates."""
    return bars.select(
        "symbol",
        F.col("timestamp").try_cast("date").alias("trade_date"),
        *[F.col(c).try_cast("double").alias(c) for c in BAR_COLUMNS[1:5]],
        F.col("volume").try_cast("bigint").alias("volume"),
    )
