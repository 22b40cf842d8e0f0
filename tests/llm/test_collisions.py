"""Collision-counting search against brute force: recall, exact scores, odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import collisions
from stratalake.llm.queries import op13_neighbours


def brute(rows, k=10):
    good = [(n, i, [float(x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, _, v in good), default=0)
    good = [(n, i, np.array(v + [0.0] * (width - len(v)))) for n, i, v in good]
    out = {}
    for n, i, q in good:
        if i is not None and i % 100 == 0:
            near = sorted((float(np.sqrt(((c - q) ** 2).sum())), j is None, j or 0, m) for m, j, c in good if m != n)[:k]
            out.setdefault(i, []).append([(None if none else j, d) for d, none, j, _ in near])
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(3) for c in ("v", "q", "uid", "c", "b", "rank", "score")})
    out = {}
    for r in sorted(collisions.neighbours(df, F.col("vec_id") % 100 == 0, **options).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def vectors(n, d, seed=1, clusters=0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(clusters)]
    draw = lambda c: [float(np.float32((x := rng.gauss(0, 1)) if c is None else c[j] + 0.1 * rng.gauss(0, 1))) for j in range(d)]  # noqa: E731, F841
    return [(i, draw(rng.choice(centres) if centres and i % 3 else None)) for i in range(n)]


def recall(got, want):
    met = total = 0
    for q, (near, *_) in want.items():
        assert len(got[q]) == len(near)
        met += sum(d <= near[-1][1] for _, d in got[q])
        total += len(near)
    return met / total


@pytest.mark.parametrize("clusters,options", [(0, {}), (20, {"block_rows": 700, "query_rows": 7}), (5, {"projections": 40, "growth": 1.4})])
def test_recall(spark, clusters, options):
    rows = vectors(3000, 32, clusters=clusters)
    got, want = run(spark, rows, **options), brute(rows)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95


def test_recall_and_scores_on_given_vectors(spark, small_tables):
    big = small_tables.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{big}/embeddings.parquet").collect()]
    got = {}
    for r in sorted(op13_neighbours(spark, big).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    held = {i: np.array(v, float) for i, v in rows}
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (x[1], x[0])) and q not in [i for i, _ in near]
        assert all(d == float(np.sqrt(((held[i] - held[q]) ** 2).sum())) for i, d in near)


def test_small_tables_are_exact(spark):
    """Fewer rows than k: the windows grow until every vector has been verified."""
    rows = vectors(9, 6)
    assert run(spark, rows) == {q: n[0] for q, n in brute(rows).items()}
    assert run(spark, [(100, [1.0])]) == {} and run(spark, [(1, [1.0])]) == {} and run(spark, []) == {}


def test_odd_rows(spark):
    rows = vectors(5, 4) + [(100, None), (101, [1.0, None]), (102, [float("nan")]), (103, [float("inf")]), (200, [0.0] * 4), (300, []), (400, [1.0] * 4), (None, [1.0] * 4), (104, [1.0]), (105, [1.0] * 6)]
    assert run(spark, rows) == {q: n[0] for q, n in brute(rows).items()}


def test_copies_and_ties(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 900, 3)] + vectors(200, 3)[100:]
    got = run(spark, rows, block_rows=50)
    copies = [i for i in range(0, 900, 3)]
    assert got[300] == [(i, 0.0) for i in copies if i != 300][:10]
    assert got[0] == [(i, 0.0) for i in copies if i][:10]


def test_repeated_ids_are_rows_of_their_own(spark):
    got = run(spark, [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [0.0, 1.0])])
    assert sorted(got[100]) == [(7, math.sqrt(2.0))] * 2 + [(100, 0.0)] * 2


def test_threshold_lies_below_the_mean():
    for window, sigmas in ((0.7, 1.0), (1.0, 1.0), (1.0, 2.0)):
        t = collisions.collision_threshold(64, window, sigmas)
        p = math.erf(window / math.sqrt(2))
        chance = sum(math.comb(64, i) * p**i * (1 - p) ** (64 - i) for i in range(t, 65))
        assert chance > (0.8 if sigmas == 1 else 0.96)
