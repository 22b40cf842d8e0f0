"""Exact top-k by inner product: branch and bound over blocks of dimensions.

Vectors become integers ``floor(256 x)`` and are laid out by column: a block is
a matrix with one row per dimension. For a query, products are accumulated one
group of dimensions after the other. What the remaining dimensions can still add
is at most the product of the remaining masses (norms) of both vectors. A
candidate whose score plus that bound stays below the k-th best score minus
bound cannot enter and is dropped; survivors are compacted, so later dimensions
touch fewer columns. The bound is exact, so the result is.

The query set is a stated one, and its blocks are met by all rows, in blocks:
rows are dealt into blocks of about ``block_rows`` candidates and ``query_rows``
queries by a hash of the row, and every pair of blocks is one co-group. A task
holds one pair of blocks at a time.

Blocks share their bound: they are met in rounds, each ``GROWTH`` times as large as
all before it, and a query takes the k-th best score of the earlier rounds along
as its floor. A candidate whose bound, or whose norm alone, stays below the floor is
dropped in its block, and only scores that reach the floor leave it. As blocks are
dealt by a hash, a round is expected to send about ``GROWTH * k`` rows a query, so
the rows sent grow with the logarithm of the number of blocks only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import staged

DIM_BLOCK = 16
BLOCK_ROWS = 1024
QUERY_ROWS = 4096
GROWTH = 4
_EXACT = float(1 << 53)


def scaled(vector: Column) -> Column:
    """``floor(256 x)`` per component; null if the vector or a component is null, NaN or infinite."""
    values = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * 256.0).cast("long"))
    limit = float(1 << 53)
    bad = F.exists(vector.cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= limit))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), values)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers as columns of a matrix, shorter rows filled with zeros."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64)
    return np.ascontiguousarray(out.T)


def _masses(matrix: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norm of what lies at and beyond each edge, per column."""
    squares = matrix.astype(np.float64) ** 2
    return np.sqrt(np.array([squares[e:].sum(0) for e in edges]))


def block_top(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, dim_block: int = DIM_BLOCK, floors: list | None = None, tally: np.ndarray | None = None):
    """Per query the columns that can be among its k best, with exact scores.

    ``queries`` and ``candidates`` are dimension by vector. ``own[q]`` is the
    column of the query's own row or -1. ``ids`` breaks ties. ``floors[q]`` is
    a score that others reached k times, or None: what stays below it is left
    out. ``tally`` gets the number of candidates alive after each dimension block.
    """
    width = max(len(queries), len(candidates))
    pad = lambda m: np.pad(m, ((0, width - len(m)), (0, 0)))
    q, c = pad(queries), pad(candidates)
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(width, 1)
    kind = np.float64 if largest < _EXACT else (np.int64 if largest < 2.0**63 else object)
    edges = [*range(0, width, dim_block), width]
    q_left, c_left = _masses(q, edges), _masses(c, edges)
    q, c = q.astype(kind), c.astype(kind)
    slack = 1 + largest * 1e-9 if kind is not np.float64 else 1.0
    found = []
    first = q[: edges[1]].T @ c[: edges[1]] if len(edges) > 1 else np.zeros((q.shape[1], c.shape[1]), kind)
    for n in range(q.shape[1]):
        floor = floors[n] if floors is not None else None
        alive = np.arange(c.shape[1])
        if own[n] >= 0:
            alive = np.delete(alive, own[n])
        if floor is not None:  # what the norms alone rule out
            alive = alive[q_left[0, n] * c_left[0, alive] + slack >= floor]
        score = first[n][alive]
        for b in range(1, len(edges)):
            if b > 1:
                score = score + q[edges[b - 1] : edges[b], n] @ c[edges[b - 1] : edges[b], alive]
            if len(alive) > k or floor is not None:
                rest = q_left[b, n] * c_left[b, alive] + slack
                approx = score.astype(np.float64)
                low = -np.inf if floor is None else floor
                if len(alive) > k:
                    low = max(low, np.partition(approx - rest, len(alive) - k)[len(alive) - k])
                keep = approx + rest >= low
                if not keep.all():
                    alive, score = alive[keep], score[keep]
            if tally is not None:
                tally[b - 1] += len(alive)
        exact = [int(x) for x in score]
        best = sorted(range(len(exact)), key=lambda i: (-exact[i], ids[alive[i]]))[:k]
        if floor is not None:
            best = [i for i in best if exact[i] >= floor]
        found.append((alive[best], score[best]))
    return found


def _meet(k: int, dim_block: int):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["query_id", "query_uid", "vec_id", "uid", "score"]
    last = np.iinfo(np.int64).max

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and queries.num_rows:
            c, q = (_matrix(t.column("v").combine_chunks()) for t in (candidates, queries))
            id_of, uids = candidates.column("vec_id").to_pylist(), candidates.column("uid").to_pylist()
            ids = np.array([last if i is None else i for i in id_of], np.int64)
            place = {u: i for i, u in enumerate(uids)}
            asked = list(zip(*(queries.column(name).to_pylist() for name in ("vec_id", "uid", "floor"))))
            for at in range(0, len(asked), 256):
                part = asked[at : at + 256]
                own = np.array([place.get(u, -1) for _, u, _ in part])
                for (q_id, q_uid, _), (cols, scores) in zip(part, block_top(q[:, at : at + 256], c, own, ids, k, dim_block, [f for *_, f in part])):
                    out += [(q_id, q_uid, id_of[x], uids[x], int(s)) for x, s in zip(cols.tolist(), scores.tolist())]
        return pa.table([pa.array(list(v), t) for v, t in zip(zip(*out) if out else [[]] * 5, kinds)], names)

    return run


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    dim_block: int = DIM_BLOCK, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``queries`` holds, its k best other rows.

    Ties go to the smaller id, a null id last. Vectors that are null or hold a
    null, NaN or infinite component (or one of 2^53 and more) take no part, as
    query or candidate. Shorter vectors count as filled with zeros; an empty one
    scores 0 everywhere. A row that repeats an id is a candidate and a query of
    its own. An empty table, or no query, gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = staged(rows.filter(F.col("v").isNotNull()).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n_rows, n_queries = rows.agg(F.count("*"), F.count_if("q")).first()
    n_blocks, n_query_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    part = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high - 1)))
    dealt = rows.select("vec_id", "uid", "v", part(n_blocks).alias("c"))
    asked = staged(rows.filter("q").select("vec_id", "uid", "v", part(n_query_blocks).alias("b")), "queries")
    by_rank = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    best, low = None, 0
    while low < n_blocks:
        high = min(n_blocks, max(1, low * GROWTH))
        if best is None:
            floored = asked.withColumn("floor", F.lit(None).cast("long"))
        else:
            floors = best.filter(F.col("rank") == k).select(F.col("query_uid").alias("uid"), F.col("score").alias("floor"))
            floored = asked.join(floors, "uid", "left")
        candidates = dealt.filter((F.col("c") >= low) & (F.col("c") < high)).select("*", every(0, n_query_blocks).alias("b"))
        met = candidates.groupBy("c", "b").cogroup(floored.select("*", every(low, high).alias("c")).groupBy("c", "b")).applyInArrow(
            _meet(k, dim_block), "query_id long, query_uid long, vec_id long, uid long, score long"
        )
        found = met if best is None else met.unionByName(best.drop("rank"))
        best = staged(found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k), "best")
        low = high
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
