"""Every registered query against its SQL, and properties all of them share."""

import __spark_entry__ as spark_entry
import pytest

from stratalake.catalog.oracles import statements
from stratalake.catalog.queries import all_queries
from tests.compare import connect, difference

QUERIES, ORACLE = all_queries(), statements()  # those of the optional subpackage have tests of their own


@pytest.fixture(scope="module")
def duck(small_tables):
    return connect(small_tables)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, small_tables, name):
    actual = QUERIES[name](spark, small_tables).toPandas()
    assert len(actual) > 0
    assert difference(actual, duck.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", ["gold_daily", "silver_events", "rule_report_events", "missing_partitions", "series_map_rows"])
def test_no_python_in_the_plan(spark, small_tables, name):
    text = QUERIES[name](spark, small_tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_entry(spark, small_tables):
    df = spark_entry.entry(spark)
    assert df.count() == 41 and "date" in df.columns
