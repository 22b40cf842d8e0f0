"""Approximate nearest neighbours by counting collisions in query-centred windows.

Every vector is projected on ``projections`` random directions, and each
projection alone is kept as a sorted array of its values. For a query a window
opens in each array around the query's own value; its half-width is ``window`` times
a radius that grows level by level (virtual rehashing: nothing is hashed again, the
windows only take in what lies next to them). A vector that lies in the windows of
at least ``threshold`` arrays is verified by its distance. A query ends when k
verified vectors are within the present radius.

A vector at the radius collides in one array with probability ``2 Phi(window) - 1``;
the threshold lies ``sigmas`` standard deviations of the binomial count below its
mean, so such a vector is missed with a known small probability, and nearer ones
less. Nothing bounds the candidates: the windows grow until the query has ended or
everything has been verified.

The arrays are an index of one block of rows. Rows are dealt into blocks of about
``block_rows`` by a hash of the row, so copies of one vector are spread as well, and
the stated queries meet every block in blocks of ``query_rows``. A block hands on at
most k rows per query, whose best are taken by an aggregate that combines first.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import staged

PROJECTIONS, WINDOW, SIGMAS, GROWTH = 64, 1.0, 1.0, 1.2
BLOCK_ROWS, QUERY_ROWS = 8192, 2048
_SEED = 13
_FIRST_RADIUS = 1 / 32  # of the spread of a block's projections
_AT_ONCE = 128  # queries


def directions(width: int, count: int) -> np.ndarray:
    """Random directions (width, count): orthogonal in runs of ``width``, so that counts vary less; unit vectors project to variance 1 over ``width``."""
    rng = np.random.default_rng(_SEED)
    runs = [np.linalg.qr(rng.normal(size=(width, width)))[0] for _ in range(-(-count // max(width, 1)))]
    return np.concatenate(runs, 1)[:, :count] * math.sqrt(width)


def collision_threshold(projections: int, window: float, sigmas: float) -> int:
    """Collisions that a vector at the radius reaches but for ``sigmas`` standard deviations."""
    p = 2 * NormalDist().cdf(window) - 1
    return max(1, math.floor(projections * p - sigmas * math.sqrt(projections * p * (1 - p))))


class SortedArrays:
    """The single-projection arrays of a block: values in order, and which row each belongs to."""

    def __init__(self, vectors: np.ndarray, axes: np.ndarray):
        projected = vectors @ axes
        self.vectors = vectors
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(projected.T, self.order, 1)
        self.spread = float(np.ptp(projected, axis=0).max(initial=0))

    def _bounds(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the windows of some queries in every array."""
        low = [np.searchsorted(v, x - half, "left") for v, x in zip(self.values, at.T)]
        high = [np.searchsorted(v, x + half, "right") for v, x in zip(self.values, at.T)]
        return np.stack(low, 1), np.stack(high, 1)

    def search(self, queries: np.ndarray, at: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, threshold: int, window: float, growth: float):
        """Per query the rows and distances of its k best verified vectors, best first.

        ``at`` are the projections of the queries, ``own`` their own rows or -1,
        which are none of the results.
        """
        arrays, n = self.values.shape
        total = len(queries)
        counts = np.zeros((total, n), np.int32)
        waiting = np.ones((total, n), bool)
        waiting[np.flatnonzero(own >= 0), own[own >= 0]] = False
        found = [(np.zeros(0, np.int64), np.zeros(0))] * total
        middle = np.stack([np.searchsorted(v, x) for v, x in zip(self.values, at.T)], 1)
        low, high = middle.copy(), middle.copy()
        radius, open_ = 0.0, np.arange(total)
        while len(open_):
            wide_low, wide_high = self._bounds(at[open_], np.full(len(open_), radius * window))
            wide_low, wide_high = np.minimum(wide_low, low[open_]), np.maximum(wide_high, high[open_])
            ended = []
            for q, a, b in zip(open_.tolist(), wide_low, wide_high):
                sides = [o[x:y] for o, x, y in zip(self.order, a.tolist(), low[q].tolist())] + [o[x:y] for o, x, y in zip(self.order, high[q].tolist(), b.tolist())]
                counts[q] += np.bincount(np.concatenate(sides), minlength=n).astype(np.int32)
                everything = bool((a == 0).all() and (b == n).all())
                rows = np.flatnonzero(waiting[q] & ((counts[q] >= threshold) | everything))
                if len(rows):
                    waiting[q, rows] = False
                    apart = np.sqrt(((self.vectors[rows] - queries[q]) ** 2).sum(1))
                    rows, apart = np.concatenate([found[q][0], rows]), np.concatenate([found[q][1], apart])
                    best = np.lexsort((rows, ids[rows], apart))[:k]
                    found[q] = rows[best], apart[best]
                ended.append(everything or (len(found[q][1]) >= k and found[q][1][-1] <= radius))
            low[open_], high[open_] = wide_low, wide_high
            open_ = open_[~np.array(ended)]
            radius = max(radius * growth, self.spread * _FIRST_RADIUS)
        return found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = np.asarray(column.flatten().to_numpy(zero_copy_only=False))
    return out


def _meet(k: int, width: int, projections: int, window: float, sigmas: float, growth: float):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    names = ["query_id", "query_uid", "vec_id", "uid", "score"]
    threshold = collision_threshold(projections, window, sigmas)

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and queries.num_rows:
            axes = directions(width, projections)
            block = SortedArrays(_matrix(candidates.column("v").combine_chunks(), width), axes)
            asked = _matrix(queries.column("v").combine_chunks(), width)
            id_of, uids = candidates.column("vec_id").to_pylist(), candidates.column("uid").to_pylist()
            ids = np.array([np.iinfo(np.int64).max if i is None else i for i in id_of], np.int64)
            place = {u: i for i, u in enumerate(uids)}
            q_ids, q_uids = queries.column("vec_id").to_pylist(), queries.column("uid").to_pylist()
            own = np.array([place.get(u, -1) for u in q_uids], np.int64)
            for begin in range(0, len(asked), _AT_ONCE):
                part = slice(begin, begin + _AT_ONCE)
                found = block.search(asked[part], asked[part] @ axes, own[part], ids, k, threshold, window, growth)
                for q_id, q_uid, (rows, scores) in zip(q_ids[part], q_uids[part], found):
                    out += [(q_id, q_uid, id_of[x], uids[x], s) for x, s in zip(rows.tolist(), scores.tolist())]
        return pa.table([pa.array(list(v), t) for v, t in zip(zip(*out) if out else [[]] * 5, kinds)], names)

    return run


def _usable(vector: Column) -> Column:
    """The vector in double precision; null if it is null, zero, or holds a null, NaN or infinite component."""
    values = vector.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)) & F.exists(values, lambda x: x != 0), values)


def neighbours(
    vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    projections: int = PROJECTIONS, window: float = WINDOW, sigmas: float = SIGMAS, growth: float = GROWTH,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``queries`` holds, the k nearest other rows found.

    Scores are Euclidean distances of the vectors as given, in double precision.
    Ties go to the smaller id, a null id last. Vectors that are null, zero (an empty
    one is) or hold a null, NaN or infinite component take no part, as query or
    candidate. Shorter vectors count as filled with zeros. A row that repeats an id
    is a candidate and a query of its own. An empty table, or no query, gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), _usable(F.col(vector_col)).alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = staged(rows.filter(F.col("v").isNotNull()).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n_rows, n_queries, width = rows.agg(F.count("*"), F.count_if("q"), F.max(F.size("v"))).first()
    n_blocks, n_query_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    part = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("vec_id", "uid", "v", part(n_blocks).alias("c"), every(n_query_blocks).alias("b"))
    asked = rows.filter("q").select("vec_id", "uid", "v", every(n_blocks).alias("c"), part(n_query_blocks).alias("b"))
    met = candidates.groupBy("c", "b").cogroup(asked.groupBy("c", "b")).applyInArrow(
        _meet(k, width or 0, projections, window, sigmas, growth), "query_id long, query_uid long, vec_id long, uid long, score double"
    )
    best = Window.partitionBy("query_uid").orderBy(F.col("score"), F.col("vec_id").asc_nulls_last(), "uid")
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
