"""Run stamp and row identity."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Run:
    """Identity of one processing run, shared by every row it writes."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_ts: dt.datetime = field(default_factory=_now)

    def timestamp(self) -> Column:
        """Run time as a constant; a naive value is taken as UTC."""
        moment = self.run_ts if self.run_ts.tzinfo else self.run_ts.replace(tzinfo=dt.timezone.utc)
        return F.timestamp_micros(F.lit(round(moment.timestamp() * 1_000_000)))


def row_id(keys: Sequence[str] | None) -> Column:
    """Identifier of a row.

    With keys it is a digest of their values: the same input gets the same id in
    every run and every task attempt. Without keys each row draws a random uuid.
    """
    if keys is None:
        return F.expr("uuid()")
    values = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(":", *values))


def stamp(
    df: DataFrame,
    run: Run,
    source_system: str,
    source_file: Column,
    keys: Sequence[str] | None,
    effective_from: str,
    effective_type: str,
) -> DataFrame:
    """Add run, validity and source columns; the validity interval stays open."""
    return df.withColumns(
        {
            "processing_timestamp": run.timestamp(),
            "effective_from": F.col(effective_from).cast(effective_type),
            "effective_to": F.lit(None).cast(effective_type),
            "source_system": F.lit(source_system),
            "source_file": source_file,
            "batch_id": F.lit(run.batch_id),
            "record_id": row_id(keys),
        }
    )
