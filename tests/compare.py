"""Compare registered queries with their SQL on the given tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NaT:
        return None
    return repr(value.item() if hasattr(value, "item") else value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(_plain, row)) for row in frame.itertuples(index=False)), key=repr)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """First difference between two results, order ignored; None if equal."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)} rows"
    for got, want in zip(rows(actual), rows(expected)):
        if got != want:
            return f"row {dict(zip(sorted(actual.columns), got))} != {dict(zip(sorted(actual.columns), want))}"
    return None
