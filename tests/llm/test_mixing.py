"""Mixing against its SQL, a plain water level, and its contract."""

from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake.llm import mixing
from stratalake.llm.oracles import OP9

NAMES = ["doc_id", "size", "source_size", "target", "taken"]


def slow_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: n % 3 + 1 for n, s in enumerate(order)}
    full, left = set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return {**{s: 3.0 * sizes[s] for s in full}, **share}
        full |= set(above)
        left = sum(sizes.values()) - sum(3.0 * sizes[s] for s in full)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1, "c": 1, "d": 500, None: 3}, {"a": 5}, {"b": 0, "a": 7, None: 0}, {"x": 100, "y": 100, "z": 100}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(slow_targets(sizes))


def corpus():
    rows = []
    for i in range(400):
        source = ["hot", "hot", "b", "é", None][i % 5]
        rows.append((i, " ".join(["wörd", "##", "y"][i % 3] for _ in range(i * 7 % 90)), source))
    return rows + [(7, "seven\x0bwords\t of\n text", "b"), (7, "seven\x0bwords\t of\n text", "b"), (None, "no id", None), (500, None, "tiny"), (501, "a b", "tiny")]


def test_against_sql(spark, tmp_path):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string").withColumn("key", F.lit("clash")).withColumn("bucket", F.lit(0))
    got = sorted((tuple(r) for r in mixing.mix(df).select(*NAMES).collect()), key=repr)
    con = duckdb.connect()
    df.write.parquet(str(tmp_path / "documents"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    want = con.execute(f"SELECT {', '.join(NAMES)} FROM ({OP9})").fetchall()
    assert got == sorted(want, key=repr)


def test_contract(spark):
    rows = mixing.mix(spark.createDataFrame(corpus(), "doc_id long, text string, source string")).collect()
    taken, longest, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        target[r.source] = r.target
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in taken)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))


def test_plan_has_no_python(spark, small_tables):
    df = mixing.mix(spark.read.parquet(f"{small_tables}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixed_documents(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string").withColumn("copies", F.lit(5)).withColumn("epoch_", F.lit(5))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    want = mixing.mix(df).groupBy("doc_id").agg(F.sum("copies").alias("n")).filter("n > 0").collect()
    got = mixed.groupBy("doc_id").count().collect()
    assert {r[0]: r[1] for r in got} == {r[0]: r[1] for r in want}


def test_quality_weight_prefers_plain_text(spark):
    rows = [(i, ("plain words here " if i % 2 else "## $$ %% ") * 10, "s") for i in range(400)] + [(1000, "x " * 8000, "other")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_epochs=3).filter("source = 's'").collect()
    assert {r.copies for r in got} <= {0, 1, 2, 3}
    plain = [r.copies for r in got if r.doc_id % 2]
    other = [r.copies for r in got if r.doc_id % 2 == 0]
    assert sum(plain) >= sum(other)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
