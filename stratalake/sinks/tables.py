"""Table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DataType, IntegralType, StringType

from ..session import path_exists, staged

EVENT_PARTITIONS = ("year_month", "event_type")
WEATHER_PARTITIONS = ("city", "year")
BAR_PARTITIONS = ("ticker",)
DOCUMENT_PARTITIONS = ("city", "year", "month")
LANDING_PARTITIONS = ("symbol", "batch_ts")


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    *,
    fmt: str = "parquet",
    mode: str = "append",
    keys: Sequence[str] = (),
    batch: Sequence[str] = (),
    run_columns: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
    options: dict[str, str] | None = None,
) -> None:
    """Publish a table in folders by partition value.

    ``append`` adds rows. ``batch`` names the columns that tell which delivery a
    row came with, such as its source file. Rows of a delivery that the table does
    not know are added as they are, equal ones too; of a known one, only as many of
    each row as are missing. So the table is the same however deliveries are
    grouped and repeated, and may be published in part. ``run_columns`` differ from
    run to run and are not compared. ``keys`` is for tables that hold a key once:
    rows with a stored key are left out. Both look only at the partitions ``df``
    touches. ``replace`` is for batches that hold their partitions whole: it
    overwrites exactly those and leaves the others alone.

    Rows are rebalanced by partition value first: small partitions share a task
    and get few files, a partition with most of the rows is split over many
    tasks. Input that already lies in partition order, such as events in order
    of time, can skip that shuffle with ``rebalance=False``. ``sort_by`` orders
    each file for row-group skipping.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "append" and batch:
        df = _surplus(df, path, partitions, batch, run_columns, fmt)
    elif mode == "append" and keys:
        df = _not_held(df, path, partitions, keys, fmt)
    spread = df.hint("rebalance", *partitions) if rebalance else df
    writer = spread.sortWithinPartitions(*partitions, *sort_by).write.format(fmt).partitionBy(*partitions).options(**(options or {}))
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    else:
        writer.mode("append").save(path)


def _not_held(df: DataFrame, path: str, partitions: Sequence[str], keys: Sequence[str], fmt: str) -> DataFrame:
    """Rows whose key is not among the stored rows of the same partition."""
    if not path_exists(df.sparkSession, path):
        return df
    try:
        stored = df.sparkSession.read.format(fmt).load(path)
    except AnalysisException as error:  # a folder without a file
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return df
    by = list(dict.fromkeys([*partitions, *keys]))
    touched = df.select(*partitions).distinct()  # prunes the folders that are read
    held = stored.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in by]).join(touched, list(partitions), "left_semi")
    held = held.withColumnsRenamed({c: f"held_{c}" for c in by})
    match = [F.col(c).eqNullSafe(F.col(f"held_{c}")) for c in by]
    return df.join(held, match, "left_anti")


def _equal(names: Sequence[str], other: str) -> list:
    return [F.col(c).eqNullSafe(F.col(f"{other}{c}")) for c in names]


def _has_digest(kind: DataType) -> bool:
    """Whether :func:`_digest` tells values of a type apart as a grouping does: plain values, no collations."""
    return isinstance(kind, AtomicType) and kind.typeName() != "variant" and (not isinstance(kind, StringType) or kind == StringType())


def _digest(columns: Sequence[str], names: Sequence[str]) -> list:
    """Two longs of plain columns, equal for rows that a grouping holds equal. Hashes skip nulls, so those are hashed apart."""
    values = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return [F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in enumerate(names)]


def _surplus(
    df: DataFrame, path: str, partitions: Sequence[str], batch: Sequence[str], run_columns: Sequence[str], fmt: str
) -> DataFrame:
    """``df`` less the rows that the table holds from the same deliveries, by number of occurrences.

    A delivery new to a partition is found by names alone and its rows are not
    shuffled. Rows of a known one are counted against the stored ones by digests of
    128 bits, in one aggregate that combines first, so a row repeated very often is no
    hot key. Whole rows are only shuffled where some are missing.
    """
    spark = df.sparkSession
    if not path_exists(spark, path):
        return df
    reader = spark.read.format(fmt)
    stored = (reader if fmt == "delta" else reader.schema(df.schema)).load(path)
    place = list(dict.fromkeys([*partitions, *batch]))
    here = staged(df.select(*place).distinct(), "deliveries")
    # Constants prune the folders and row groups that are read. Moments could change on their way through Python.
    bounded = [c for c in place if c in partitions or isinstance(df.schema[c].dataType, (StringType, IntegralType))]
    ends = here.agg(*[end(c) for c in bounded for end in (F.min, F.max)]).first()
    for c, low, high in zip(bounded, ends[::2], ends[1::2]):
        stored = stored.filter(F.col(c).isNull() if low is None else F.col(c).isNull() | F.col(c).between(low, high))
    other = here.withColumnsRenamed({c: f"held_{c}" for c in place})
    known = staged(stored.select(*place).join(other, _equal(place, "held_"), "left_semi").distinct(), "known-deliveries")
    if known.isEmpty():
        return df
    known = known.withColumnsRenamed({c: f"held_{c}" for c in place})
    only_known = here.join(known, _equal(place, "held_"), "left_anti").isEmpty()
    again, held = (frame.join(known, _equal(place, "held_"), "left_semi") for frame in (df, stored))
    content = [c for c in df.columns if c not in run_columns]
    copies = next(n for n in ("copies", "copies_", "copies__") if n not in df.columns)
    if all(_has_digest(df.schema[c].dataType) for c in content):
        marks = [next(n for n in (m, f"{m}_", f"{m}__") if n not in df.columns) for m in ("mark_1", "mark_2")]
        held = held.withColumns({c: F.col(c).cast(df.schema[c].dataType) for c in content})
        balance = again.select(*_digest(content, marks), F.lit(1).alias(copies)).unionAll(held.select(*_digest(content, marks), F.lit(-1).alias(copies)))
        short = staged(balance.groupBy(*marks).agg(F.sum(copies).alias(copies)).filter(F.col(copies) > 0).select(*marks), "short")
        if short.isEmpty():
            return df.filter(F.lit(False)) if only_known else df.join(known, _equal(place, "held_"), "left_anti")
        again, held = (frame.select("*", *_digest(content, marks)).join(short, marks, "left_semi").drop(*marks) for frame in (again, held))
    counted = again.withColumn(copies, F.lit(1)).unionByName(
        held.select(*content, F.lit(-1).alias(copies)), allowMissingColumns=True
    )
    missing = counted.groupBy(*content).agg(F.sum(copies).alias(copies), *[F.max(c).alias(c) for c in run_columns])
    each = missing.filter(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    each = each.select(*df.columns)
    return each if only_known else df.join(known, _equal(place, "held_"), "left_anti").unionByName(each)


def overwrite_table(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Replace a table and its columns."""
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.option("partitionOverwriteMode", "static").save(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON file per city-month document."""
    keyed = documents.withColumns(
        {"city": F.translate(F.lower("city"), " ", "_"), "month": F.lpad(F.col("month").cast("string"), 2, "0")}
    )
    write_partitioned(keyed, path, DOCUMENT_PARTITIONS, fmt="json", mode="replace")


def write_bar_files(bars: DataFrame, path: str, batch_ts: str) -> None:
    """CSV files per symbol under the stamp of the batch that fetched them."""
    stamped = bars.withColumn("batch_ts", F.lit(batch_ts))
    write_partitioned(
        stamped, path, LANDING_PARTITIONS, fmt="csv", mode="replace", sort_by=["timestamp"], options={"header": "true"}
    )


def partition_keys(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Distinct partition values."""
    return df.select(*partitions).distinct()


def preview(df: DataFrame, columns: Sequence[str], order: str, rows: int = 10) -> DataFrame:
    """First rows in order; a top-k, not a full sort."""
    return df.select(*columns).orderBy(order).limit(rows)


def summary(df: DataFrame, day: str = "date") -> DataFrame:
    """Row count and first and last day in one job."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
