"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Day boundaries, month partitions and parsed time stamps all follow the session
# zone, so it is pinned. Dynamic overwrite makes a partitioned publish replace
# only the partitions it holds.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app_name: str = "stratalake", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Intermediate tables of this process, for clear_scratch.
_scratch: list[str] = []


@functools.lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="stratalake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table.

    It lies in the folder named by ``spark.checkpoint.dir``, which every
    executor can reach. Only a local session without that setting falls back to
    a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_scratch()
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def staged(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a frame once into the shared folder and go on from that copy.

    The planner then knows its size in bytes, so a join broadcasts it only if it
    is small, and a lost executor costs a re-read. ``by`` names columns of few
    values that parts of the frame are picked by: they become folders, so that each
    part is read alone.
    """
    path = scratch_path(df.sparkSession, label)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables made so far; call it when results are published."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
