from pyspark.sql import functions as F

from stratalake.operators.joins import drop_listed, keep_listed
from stratalake.operators.quality import not_null, outcome_by_key
from stratalake.plans import bars as plan
from stratalake.plans.landing import with_skipped


def test_lists(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r.n for r in keep_listed(df, listed, ["k"]).collect()] == [1]
    assert sorted(r.n for r in drop_listed(df, listed, ["k"]).collect()) == [2, 3]


def test_failed_keys_beyond_the_broadcast_limit(spark):
    """The shuffled form drops the same rows, also with one key on a third of them."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("ticker"),
        F.when((F.col("id") % 1000 == 7) | (F.col("id") == 3), F.lit(None)).otherwise(F.col("id")).alias("open"),
    )
    outcomes = outcome_by_key(rows, [not_null("open")], "ticker")
    small = plan.drop_failed(rows, outcomes)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = plan.drop_failed(rows, outcomes)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        counts = {r.ticker: r["count"] for r in shuffled.groupBy("ticker").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == {r.ticker: r["count"] for r in small.groupBy("ticker").count().collect()}
    ids = range(30_000)
    key = lambda i: "hot" if i % 3 == 0 else str(i % 500)
    failed = {key(i) for i in ids if i % 1000 == 7 or i == 3}
    assert "hot" in failed
    expected = {}
    for i in ids:
        if key(i) not in failed:
            expected[key(i)] = expected.get(key(i), 0) + 1
    assert counts == expected


def test_fresh_symbols_count_as_passed(spark):
    outcomes = spark.createDataFrame([("A", "failed", "too short", 0)], "symbol string, status string, reason string, row_count long")
    fresh = spark.createDataFrame([("A", True), ("B", True), ("C", False)], "symbol string, fresh boolean")
    got = {r.symbol: (r.status, r.reason) for r in with_skipped(outcomes, fresh).collect()}
    assert got == {"A": ("failed", "too short"), "B": ("passed", "fresh")}
