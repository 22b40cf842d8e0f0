"""Rolling rows up into documents and flattening documents into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_key
from ..functions.timefeatures import to_day
from ..schemas import WEATHER_DAY
from .lineage import Run

# Names in a daily price payload, by column of a bar.
SERIES = "Time Series (Daily)"
SERIES_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}
BAR_COLUMNS = ("timestamp", *SERIES_FIELDS)
SERIES_TYPE = f"struct<`{SERIES}`: map<string, map<string, string>>>"

# Fixed value: folder of the city-month documents.
DOCUMENT_PREFIX = "bronze/openweathermap"
DOCUMENT_SOURCE = "openweathermap"


def last_per_key(df: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """The row with the greatest ``order`` value of each key.

    An aggregate and not a window: rows are reduced before the shuffle, so no
    task ever holds all copies of a key. Equal ``order`` values are settled by
    the other columns, in every run alike.
    """
    others = [c for c in df.columns if c not in (*keys, order)]
    row = F.struct(*([order] if order else []), *others)
    return df.groupBy(*keys).agg(F.max(row).alias("last")).select(*keys, "last.*")


def monthly_documents(
    readings: DataFrame, run: Run, landed_at: str | None = None, source: str = DOCUMENT_SOURCE
) -> DataFrame:
    """One document per city and month holding its daily records in date order.

    ``readings`` has a ``city`` and the columns of a weather day. A day read
    again replaces the earlier reading (by ``landed_at``), as a rewritten object
    would. That reduction comes first and combines before its shuffle, so the
    list gathered per document has 31 records at most, whatever the input. A
    month without records gives no document, and a reading without a readable
    date belongs to no month.
    """
    dated = readings.withColumn("day", to_day(F.col("date"))).filter(F.col("day").isNotNull())
    days = last_per_key(dated, ["city", "day"], landed_at)
    record = F.struct(*[F.col(name) for name in WEATHER_DAY.fieldNames()])
    grouped = days.groupBy("city", F.year("day").alias("year"), F.month("day").alias("month")).agg(
        F.sort_array(F.collect_list(F.struct("day", record.alias("record")))).alias("ordered"),
        F.count(F.lit(1)).cast("int").alias("record_count"),
    )
    metadata = F.struct(
        "city",
        "year",
        "month",
        F.lit(source).alias("source"),
        F.date_format(run.timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_timestamp"),
        "record_count",
    )
    return grouped.select(
        "city",
        "year",
        "month",
        F.struct(metadata.alias("metadata"), F.col("ordered.record").alias("data")).alias("data"),
        month_key(F.col("city"), F.col("year"), F.col("month"), DOCUMENT_PREFIX).alias("s3_key"),
    )


def document_days(documents: DataFrame) -> DataFrame:
    """One row per daily record with its document's metadata.

    Documents whose record array is null or empty give no row.
    """
    return documents.select(F.col("data.metadata").alias("metadata"), F.explode("data.data").alias("day"))


# Line breaks inside quotes while a text is split: code points that stand for no character.
_BREAKS, _HELD_BREAKS = "\r\n", "\ufdd0\ufdd1"


def text_lines(payload: Column) -> Column:
    """Records of a CSV text; a line break inside quotes ends none.

    Between quotes the parts of the text stand inside and outside of them in turn.
    """
    parts = F.transform(F.split(payload, '"'), lambda part, i: F.when(i % 2 == 1, F.translate(part, _BREAKS, _HELD_BREAKS)).otherwise(part))
    held = F.when(payload.contains('"'), F.array_join(parts, '"')).otherwise(payload)
    return F.split(F.trim(held, F.lit(" \t\r\n")), "\r?\n")


# One cell of a CSV line and the comma after it: quoted with doubled quotes inside, or plain.
CSV_CELL = r'\s*("(?:[^"]++|"")*+"|[^,]*)\s*,'


def csv_cells(line: Column) -> Column:
    """Cells of one CSV line as an array of text; quoted commas and doubled quotes are read.

    Files differ in number and order of columns, so there is no one schema for
    ``from_csv``; an array needs none.
    """
    raw = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(CSV_CELL), F.lit(1))
    return F.transform(
        raw,
        lambda x: F.when(
            x.startswith('"'), F.translate(F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')), _HELD_BREAKS, _BREAKS)
        ).otherwise(F.nullif(F.trim(x), F.lit(""))),
    )


def header_names(line: Column) -> Column:
    """Column names of a CSV header line in their places: lower case, blanks as ``_``."""
    return F.transform(csv_cells(line), lambda name: F.translate(F.trim(F.lower(name)), " ", "_"))


def header_positions(names: Column) -> list[Column]:
    """Where each bar column stands in a header, 1-based and 0 if absent.

    Kept as columns beside the header, so a header is parsed once per file and
    not once per line.
    """
    return [F.coalesce(F.array_position(names, name), F.lit(0)).cast("int").alias(f"at_{name}") for name in BAR_COLUMNS]


def cell(cells: Column, name: str) -> Column:
    """Text under a bar column of one CSV line, null if the column is absent."""
    return F.trim(F.get(cells, F.col(f"at_{name}") - 1))


def series_of(payload: Column) -> Column:
    """Map of date to fields in a JSON price payload, null if it holds none."""
    return F.from_json(payload, SERIES_TYPE)[SERIES]


ITEM = "array<struct<line: string, date: string, fields: map<string, string>>>"


def payload_items(payload: Column) -> Column:
    """Bars of a JSON or CSV payload, unparsed: a JSON entry as its date and fields, a CSV line as the line."""
    lines = text_lines(payload)
    line_items = F.transform(
        F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda line: F.trim(line) != ""),
        lambda line: F.struct(
            line.alias("line"),
            F.lit(None).cast("string").alias("date"),
            F.lit(None).cast("map<string,string>").alias("fields"),
        ),
    )
    series_items = F.transform(
        F.map_entries(series_of(payload)),
        lambda entry: F.struct(
            F.lit(None).cast("string").alias("line"), entry["key"].alias("date"), entry["value"].alias("fields")
        ),
    )
    return F.coalesce(series_items, line_items)


def item_rows(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per item of ``keys…, header, items``, every field of the bar still text."""
    spread = items.select(*keys, *header_positions(header_names(F.col("header"))), F.explode("items").alias("item"))
    parsed = spread.withColumn("cells", csv_cells(F.col("item.line")))
    return parsed.select(
        *keys,
        *[f"at_{name}" for name in BAR_COLUMNS],
        F.coalesce("item.date", cell(F.col("cells"), "timestamp")).alias("timestamp"),
        *[
            F.coalesce(F.try_element_at("item.fields", F.lit(label)), cell(F.col("cells"), name)).alias(name)
            for name, label in SERIES_FIELDS.items()
        ],
    )


def payload_bars(payloads: DataFrame, key: str = "symbol", payload: str = "value") -> DataFrame:
    """One row per bar of JSON or CSV payloads, every field still text."""
    value = F.col(payload)
    items = payloads.select(key, F.get(text_lines(value), F.lit(0)).alias("header"), payload_items(value).alias("items"))
    return item_rows(items, [key]).select(key, *BAR_COLUMNS)
