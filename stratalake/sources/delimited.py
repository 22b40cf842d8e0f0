"""CSV files with headers of their own, cells that hold line breaks, and any size.

Files are first profiled by a scan of their lines: what the header is, and
whether a quoted cell goes on after the end of a line. Then Spark's CSV reader
reads them by position, and columns are found by each file's own header. Files
without such cells are split over tasks like any text; only the others are read
whole, one per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import plain_path
from ..operators.nesting import csv_cells
from ..session import path_exists, staged

ROW_COLUMNS = ("path", "split", "place", "cells")


def _located(df: DataFrame, *columns: Column) -> DataFrame:
    """Columns of a scan with the plain path, the split's start and the place within the task."""
    return df.select(
        plain_path(F.col("_metadata.file_path"), encoded=True).alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        *columns,
    )


def _lines(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """``path, split, place, value`` of the lines of the listed files that are not blank."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, split long, place long, value string")
    lines = _located(spark.read.option("recursiveFileLookup", "true").text(root), F.col("value"))
    return lines.filter(F.trim("value") != "").join(files.select("path"), "path", "left_semi")


def whole_texts(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """``path, value`` of the listed files, their lines put together again.

    For formats that only mean something as a whole. Files that are not listed
    are scanned line by line and never held.
    """
    line = F.struct("split", "place", "value")
    gathered = _lines(spark, root, files).groupBy("path").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return gathered.select("path", F.array_join("lines.value", "\n").alias("value"))


def csv_profiles(spark: SparkSession, root: str, files: DataFrame, **marks: Column) -> DataFrame:
    """``path, header, broken, lines`` of the listed files that have a line.

    ``header`` is the first line that is not blank, ``broken`` whether some line
    holds an odd number of quotes, which is so where a quoted cell goes on in the
    next line, ``lines`` how many are not blank. ``marks`` are conditions on
    ``value``, true for a file if true for a line. Reduced before the shuffle to a
    row per file and task.
    """
    chosen = _lines(spark, root, files)
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    found = chosen.groupBy("path").agg(
        F.min_by("value", F.struct("split", "place")).alias("header"), F.max(odd).alias("broken"), F.count("*").alias("lines"),
        *[F.max(mark).alias(name) for name, mark in marks.items()],
    )
    return found.withColumn("header", F.regexp_replace("header", "^﻿", ""))


def _scan(spark: SparkSession, root: str, width: int, broken: bool) -> DataFrame:
    """Every row below a folder as an array of ``width`` cells."""
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(width)])
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("header", "true").option("multiLine", str(broken).lower())
    reader = reader.option("escape", '"').option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true")
    return _located(reader.csv(root), F.array(*schema.fieldNames()).alias("cells"))


def read_delimited(spark: SparkSession, root: str, files: DataFrame, key: str, by_header: Sequence[Column] = (), profiles: DataFrame | None = None) -> DataFrame:
    """``key, path, split, place, cells`` of the listed files, a row per record.

    ``files`` has ``key`` and plain ``path``. ``split`` and ``place`` give the order
    of the records in their file. ``by_header`` adds columns made from ``header``,
    the text of a file's header line, once per file. ``profiles`` are those of
    ``csv_profiles``, if known. Files that are empty or have only a header give no rows.
    """
    listed = staged(files.select(key, "path"), "files")
    if profiles is None:
        profiles = csv_profiles(spark, root, listed)
    profiles = staged(listed.join(profiles, "path").select(key, "path", "header", "broken", *by_header), "profiles")
    # One small row to the driver: the widest header, and which kinds of files there are.
    width, plain, broken = profiles.agg(F.max(F.size(csv_cells(F.col("header")))), F.count_if(~F.col("broken")), F.count_if("broken")).first()
    added = [c for c in profiles.columns if c not in (key, "path", "header", "broken")]
    columns = [key, "path", *added, "split", "place", "cells"]
    parts = [
        _scan(spark, root, width, kind).join(profiles.filter(F.col("broken") == kind), "path").select(*columns)
        for kind, n in ((False, plain), (True, broken)) if n
    ]
    if not parts:
        nothing = {"split": F.lit(0).cast("long"), "place": F.lit(0).cast("long"), "cells": F.array().cast("array<string>")}
        return profiles.filter(F.lit(False)).withColumns(nothing).select(*columns)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
