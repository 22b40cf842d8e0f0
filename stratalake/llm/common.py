"""Helpers the operators share: staged tables, vectorised segment arithmetic, Arrow columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import scratch_path


#: Shuffle files go when the execution that made them ends (Spark 4.1; older versions ignore it).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and go on from that copy.

    It cuts the lineage, so that a lost executor costs a re-read; it fixes the
    result of anything a retry could order differently; and it gives the planner
    real sizes, so that a join broadcasts a side only if it is small. The copy
    stays until :func:`release` or the cluster's expiry of checkpoints. The shuffle
    files of the write are not needed after it and do not wait for the driver's
    garbage collection, else those of many steps lie beside one another.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    copy = spark.read.schema(df.schema).parquet(path)
    copy._staged_path = path
    return copy


def release(*frames: DataFrame) -> None:
    """Delete staged copies that nothing reads any more."""
    for frame in frames:
        path = getattr(frame, "_staged_path", None)
        if path:
            spark = frame.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with a suffix if the table has such a column already."""
    taken = {c.lower() for c in df.columns}
    return base if base.lower() not in taken else f"{base}_{uuid.uuid4().hex[:8]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def byte_rows(column: pa.Array) -> Iterator[bytes]:
    """The values of a string column as UTF-8, nulls as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``max_bytes`` in each, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.asarray(
            pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64
        )
        part = (np.cumsum(lengths) - lengths) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            yield batch.slice(begin, end - begin)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[s : s + n]`` for all pairs, without a loop."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    at = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
    return values[at]
