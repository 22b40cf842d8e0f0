"""Declarative row rules, checked over whole tables in one aggregation.

A rule is plain data: a name, the column it is about, and a SQL predicate that
is true for a row that breaks it. A null predicate does not break the rule, so
only ``not_null`` rejects nulls.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    broken_when: str

    def broken(self) -> Column:
        return F.expr(self.broken_when)


def _literal(value) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", column, f"`{column}` IS NULL")


def between(column: str, low=None, high=None) -> Rule:
    """Value within a closed range; either end may be open."""
    outside = [f"`{column}` {op} {_literal(end)}" for op, end in (("<", low), (">", high)) if end is not None]
    return Rule(f"{column}_in_range", column, " OR ".join(outside))


def one_of(column: str, values: Sequence) -> Rule:
    return Rule(f"{column}_in_set", column, f"`{column}` NOT IN ({', '.join(_literal(v) for v in values)})")


def required_rules(contract: StructType) -> list[Rule]:
    """A ``not_null`` rule for every non-nullable column of a contract."""
    return [not_null(f.name) for f in contract.fields if not f.nullable]


# --- column checks, from metadata only ---------------------------------------


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def contract_gaps(df: DataFrame, contract: StructType) -> list[str]:
    """Differences between a frame's columns and a strict contract."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.fields}
    gaps = [f"missing column {name}" for name in expected if name not in actual]
    gaps += [f"unexpected column {name}" for name in actual if name not in expected]
    gaps += [
        f"column {name} is {actual[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in expected.items()
        if name in actual and actual[name] != kind
    ]
    return gaps


# --- row checks --------------------------------------------------------------


def _tallies(rules: Sequence[Rule]) -> list[Column]:
    counts = [F.count_if(rule.broken()).alias(f"broken_{i}") for i, rule in enumerate(rules)]
    return [F.count(F.lit(1)).alias("rows_checked"), *counts]


def _per_rule(rules: Sequence[Rule]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(rule.column).alias("column"),
                    F.col(f"broken_{i}").alias("violations"),
                )
                for i, rule in enumerate(rules)
            ]
        )
    )


def rule_report(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Violations per rule (and per key, if given) from one aggregation."""
    tallied = df.groupBy(*by).agg(*_tallies(rules))
    return tallied.select(*by, "rows_checked", _per_rule(rules)).withColumn("passed", F.col("violations") == 0)


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))


def breaks_any(rules: Sequence[Rule]) -> Column:
    """Whether a row breaks at least one rule; never null."""
    return F.expr(" OR ".join(f"coalesce({rule.broken_when}, false)" for rule in rules))


def _settled(df: DataFrame) -> DataFrame:
    """Keep the optimizer from moving a rule filter below the derivation of its columns.

    There every rule would parse and score the raw fields again; a row count
    observed in between makes the filter read the derived columns.
    """
    return df.observe(f"rows_checked_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows_checked"))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of the rules they break."""
    return _settled(df).filter(breaks_any(rules)).withColumn("broken_rules", broken_rules(rules))


def without_broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that keep every rule."""
    return _settled(df).filter(~breaks_any(rules))


def outcome_by_key(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """One row per key: passed only if none of its rows breaks a rule.

    Partial counts are formed before the shuffle, so a key that holds most of
    the rows costs the same as any other.
    """
    tallied = df.groupBy(key).agg(*_tallies(rules))
    reasons = F.array_compact(
        F.array(*[F.when(F.col(f"broken_{i}") > 0, F.lit(r.name)) for i, r in enumerate(rules)])
    )
    return tallied.select(
        key,
        F.when(F.size(reasons) == 0, F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
        F.nullif(F.array_join(reasons, ","), F.lit("")).alias("reason"),
        F.col("rows_checked").alias("row_count"),
    )


def outcome_tally(outcomes: DataFrame) -> DataFrame:
    """How many keys passed and failed."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("keys"), F.sum("row_count").alias("row_count"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and null count per column, one row per column, in one pass."""
    rules = [not_null(c) for c in columns]
    return rule_report(df, rules).select("column", "rows_checked", F.col("violations").alias("null_count"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


# --- driver-side summary of a check ------------------------------------------


class QualityError(ValueError):
    """A table broke its contract and was not published."""


@dataclass(frozen=True)
class Check:
    """Counts of one full-table check; as small as the rule list."""

    rows: int
    violations: dict[str, int]

    @property
    def passed(self) -> bool:
        return not any(self.violations.values())

    def require(self, table: str) -> None:
        if not self.passed:
            broken = {name: n for name, n in self.violations.items() if n}
            raise QualityError(f"{table}: {broken} of {self.rows} rows")


def _to_check(row: dict, rules: Sequence[Rule]) -> Check:
    return Check(row["rows_checked"], {r.name: row[f"broken_{i}"] for i, r in enumerate(rules)})


def check(df: DataFrame, rules: Sequence[Rule]) -> Check:
    """Evaluate all rules over all rows in one job."""
    return _to_check(df.agg(*_tallies(rules)).first().asDict(), rules)


def stage_and_check(df: DataFrame, rules: Sequence[Rule], path: str) -> tuple[DataFrame, Check]:
    """Write a table once and check it during the same pass.

    Returns the written table and the check. Later steps read the columnar copy,
    so raw text is parsed a single time however many steps follow, and a lost
    executor costs a re-read of that copy, not of the raw files. The counts come
    from task metrics: a re-run task may count twice, but never turns a clean
    table into a broken one or the reverse.
    """
    observed = Observation()
    df.observe(observed, *_tallies(rules)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), _to_check(observed.get, rules)
