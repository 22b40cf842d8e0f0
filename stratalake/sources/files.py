"""Readers. All take explicit schemas; file listings are DataFrames too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import plain_path
from ..schemas import WEATHER_DOCUMENT
from ..session import path_exists, staged


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Plain paths below a folder with their sizes; no content is read.

    Files of zero bytes are listed too: a scan would pass over them, so names
    come from the file index, which the driver holds for any scan. A missing
    folder lists nothing.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    names = [(name,) for name in files.inputFiles()]
    listed = files.select(plain_path(F.col("path")).alias("path"), "length", "modificationTime")
    named = spark.createDataFrame(names, "name string").select(plain_path(F.col("name"), encoded=True).alias("path"))
    return named.join(listed, "path", "left").select(
        "path", F.coalesce("length", F.lit(0).cast("long")).alias("length"), "modificationTime"
    )


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header line, every column as text under its own name.

    Only the first line of one file is looked at to learn the names; the scan
    then checks each file's header against them.
    """
    names = spark.read.option("header", "true").csv(paths).columns
    schema = StructType([StructField(name, StringType()) for name in names])
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(paths)


def read_weather_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Nested weather documents, one per file, under any of the paths or globs.

    City and year come from the document, so folder names add no columns.
    """
    return (
        spark.read.schema(WEATHER_DOCUMENT)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .json(paths)
    )


def read_document_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, value``: the whole text of every document, readable or not."""
    text = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
    return text.select(plain_path(F.col("_metadata.file_path"), encoded=True).alias("path"), "value")


# Fixed value: characters that Spark writes as %XX in the names of partition folders.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _folder(name: str) -> str:
    """Folder value of a city, with the characters of a glob pattern quoted."""
    written = "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in name.lower().replace(" ", "_"))
    return "".join(f"\\{c}" if c in "{}*?[]\\" else c for c in written)


def weather_paths(root: str, cities: Sequence[str]) -> list[str]:
    """Folders of the named cities, or of every city for ``all``."""
    if "all" in cities:
        return [f"{root}/city=*/year=*/"]
    return [f"{root}/city={_folder(name)}/year=*/" for name in cities]


def only_cities(df: DataFrame, cities: Sequence[str], column: str = "city") -> DataFrame:
    """Same choice on a table partitioned by city: other folders are not read."""
    if "all" in cities:
        return df
    return df.filter(F.col(column).isin([name.lower().replace(" ", "_") for name in cities]))


def read_text_files(spark: SparkSession, root: str, files: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """Lines (or whole texts) of the listed files: ``key, path, value``.

    ``files`` has ``key`` and plain ``path``. The folder is scanned and met with
    the list by path, whatever the number of files; the list is staged, so the
    planner knows whether it is small enough to be sent to the scan.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], f"{key} string, path string, value string")
    text = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=whole)
    located = text.select(plain_path(F.col("_metadata.file_path"), encoded=True).alias("path"), "value")
    return located.join(staged(files.select(key, "path"), "files"), "path").select(key, "path", "value")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A stored table; ``fmt="delta"`` where the session has that format."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def sql_over(df: DataFrame, view: str, text: str) -> DataFrame:
    """Run SQL text over a frame under a view name."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(text)


