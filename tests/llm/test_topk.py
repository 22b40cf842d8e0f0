"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import topk


def brute(rows, k=5):
    good = [(n, i, [math.floor(x * 256) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in good:
        if i is None or i % 50:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(q, c)), (j is None, j or 0)), j) for m, j, c in good if m != n)[:k]
        out += [(i, r, j, -s[0]) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("q", F.lit("clash"))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, **options).collect()
    return sorted(map(tuple, got), key=repr)


def vectors(n, d, seed=1, scale=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, 1) * scale)) for _ in range(d)]) for i in range(n)]


@pytest.mark.parametrize("block_rows,query_rows,dim_block", [(1024, 4096, 16), (37, 3, 5), (4, 1, 64)])
def test_against_brute_force(spark, block_rows, query_rows, dim_block):
    rows = vectors(230, 20)
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # ties
    assert run(spark, rows, block_rows=block_rows, query_rows=query_rows, dim_block=dim_block) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(12, 6) + [(50, None), (51, [1.0, None]), (52, [float("nan")]), (53, [float("inf")]), (100, [0.5] * 6), (100, [0.5] * 6), (None, [9.0] * 6), (150, [1.0, 2.0]), (200, []), (54, [1.0] * 9)]
    assert run(spark, rows) == brute(rows)


def test_fewer_rows_than_k_and_none(spark):
    assert run(spark, [(50, [1.0]), (1, [2.0])]) == [(50, 1, 1, 131072)]
    assert run(spark, [(50, [1.0])]) == [] and run(spark, [(1, [1.0])]) == [] and run(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = vectors(60, 8, scale=3.0e5)
    assert run(spark, rows) == brute(rows)


def test_pruning_compacts_and_keeps_the_best():
    rng = np.random.default_rng(2)
    c = (rng.normal(size=(64, 3000)) * 256).astype(np.int64)
    c[:, ::50] *= 4
    q = c[:, :20] + rng.integers(-3, 4, (64, 20))
    ids = np.arange(3000)
    for n, (cols, scores) in enumerate(topk.block_top(q, c, np.full(20, -1), ids, 5)):
        exact = c.T @ q[:, n]
        order = np.lexsort((ids, -exact))[:5]
        assert cols.tolist() == order.tolist() and scores.astype(int).tolist() == exact[order].tolist()


def test_floors_prune_and_lose_nothing():
    rng = np.random.default_rng(5)
    c = (rng.normal(size=(64, 4000)) * 32).astype(np.int64)
    q, ids, none = c[:, :40], np.arange(4000), np.full(40, -1)
    scores = c.T @ q
    floors = [int(np.sort(scores[:, n])[-5]) for n in range(40)]
    alone, shared = np.zeros(4, np.int64), np.zeros(4, np.int64)
    free = topk.block_top(q, c, none, ids, 5, tally=alone)
    held = topk.block_top(q, c, none, ids, 5, floors=floors, tally=shared)
    assert all(a.tolist() == b.tolist() for (a, _), (b, _) in zip(free, held))
    assert (shared <= alone).all() and shared[2] < alone[2]
    above = topk.block_top(q, c, none, ids, 5, floors=[int(scores.max()) + 1] * 40)
    assert all(len(cols) == 0 for cols, _ in above)


def test_many_rounds_and_ties_at_the_floor(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(200, 0, -1)] + [(0, [1.0, 1.0]), (250, [0.0, 0.0])]
    assert run(spark, rows, block_rows=2) == brute(rows)
