"""Text clean-up and key handling on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a batch stamp is written in a file name.
STAMP_FORMAT = "yyyyMMdd_HHmmss"


def blank_to_null(column: Column) -> Column:
    """The empty string counts as missing."""
    return F.nullif(column, F.lit(""))


def slug(column: Column) -> Column:
    """``New York`` -> ``new_york``, as used in keys and partition values."""
    return F.translate(F.lower(column), " ", "_")


def category_levels(code: Column, depth: int = 3) -> list[Column]:
    """The first ``depth`` parts of a dotted category path, null where absent."""
    parts = F.split(blank_to_null(code), r"\.")
    return [F.get(parts, F.lit(level)) for level in range(depth)]


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.split_part(path, F.lit("/"), F.lit(-1))


def _decoded(text: Column) -> Column:
    """Text with ``%XX`` read as characters; text that is no such spelling stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def plain_path(path: Column, encoded: bool = False) -> Column:
    """One spelling of a file's path.

    Listings give it as it is, ``_metadata.file_path`` and file indexes
    percent-encoded (``encoded``), and the slashes after the scheme differ.
    """
    return F.regexp_replace(_decoded(path) if encoded else path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def path_key(path: Column) -> Column:
    """Key of a landed file, from its plain path: its ``symbol=`` folder, else the folder it lies in."""
    return F.coalesce(_folder_value(path, "symbol"), F.split_part(path, F.lit("/"), F.lit(-2)))


def path_batch(path: Column) -> Column:
    """Batch of a landed file: its ``batch_ts=`` folder, else its own name."""
    return F.coalesce(_folder_value(path, "batch_ts"), file_name(path))


def _folder_value(path: Column, name: str) -> Column:
    """Value of a partition folder, whose special characters Spark writes as ``%XX``."""
    return _decoded(blank_to_null(F.regexp_extract(path, rf"/{name}=([^/]+)/", 1)))


def batch_time(batch: Column) -> Column:
    """Time stamp in a ``<yyyyMMdd_HHmmss>[.<ext>]`` name, null if it holds none."""
    return F.try_to_timestamp(F.split_part(batch, F.lit("."), F.lit(1)), F.lit(STAMP_FORMAT))


def city_folder(city: Column, prefix: str) -> Column:
    """Folder of a city's documents."""
    return F.concat(F.lit(f"{prefix}/city="), slug(city))


def month_file(folder: Column, year: Column, month: Column) -> Column:
    """Object key of one month's document in a city folder."""
    padded = F.lpad(month.cast("string"), 2, "0")
    return F.concat(folder, F.lit("/year="), year.cast("string"), F.lit("/"), padded, F.lit(".json"))


def month_key(city: Column, year: Column, month: Column, prefix: str) -> Column:
    """Object key of one city-month document."""
    return month_file(city_folder(city, prefix), year, month)
