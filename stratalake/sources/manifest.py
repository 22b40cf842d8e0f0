"""A table of what has been landed, so that nobody has to list folders to know it.

Each landing adds its files under its batch: path, key, batch and length. The
table is read like any other; names of files never pass through the driver. A
batch that is recorded again replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_batch, path_key, plain_path
from ..session import path_exists
from ..sinks.tables import write_partitioned

MANIFEST = "path string, key string, length long, batch string"


def record(files: DataFrame, manifest: str, batch: str, key: str = "key") -> None:
    """Put ``key, path, length`` of a batch's files into the manifest."""
    rows = files.select("path", F.col(key).cast("string").alias("key"), F.col("length").cast("long").alias("length"), F.lit(batch).alias("batch"))
    write_partitioned(rows, manifest, ["batch"], mode="replace", sort_by=["key"])


def record_landing(spark: SparkSession, root: str, manifest: str, batch: str, folder: str = "batch_ts") -> None:
    """Record the files that a landing has just written below ``<key folder>/<folder>=<batch>``.

    Only the folders of that batch are looked at, and only names and sizes.
    """
    place = f"{root.rstrip('/')}/*/{folder}={batch}"
    files = spark.read.format("binaryFile").load(place)
    path = plain_path(F.col("path"))
    record(files.select(path.alias("path"), path_key(path).alias("key"), "length"), manifest, batch)


def landed_files(spark: SparkSession, manifest: str) -> DataFrame:
    """``path, key, length, batch`` of everything recorded; none for a manifest that is not there yet."""
    if not path_exists(spark, manifest):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(manifest)


def disagreements(listed: DataFrame, recorded: DataFrame) -> DataFrame:
    """Per key: files of both sides, and those that only one of them has or that differ in length."""
    left = listed.select(path_key(F.col("path")).alias("key"), path_batch(F.col("path")).alias("batch"), "path", F.col("length").alias("listed"))
    right = recorded.select(F.col("key").alias("k"), F.col("path").alias("p"), F.col("length").alias("recorded"))
    met = left.join(right, (F.col("path") == F.col("p")) & (F.col("key") == F.col("k")), "full")
    return met.groupBy(F.coalesce("key", "k").alias("key")).agg(
        F.count_if(F.col("listed") == F.col("recorded")).alias("agreed"),
        F.count_if(F.col("recorded").isNull()).alias("only_listed"),
        F.count_if(F.col("listed").isNull()).alias("only_recorded"),
        F.count_if(F.col("listed") != F.col("recorded")).alias("other_length"),
        F.max("batch").alias("newest_batch"),
    )
