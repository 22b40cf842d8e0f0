"""Product codes of vectors, in whole numbers only.

A vector becomes integers ``floor(4096 x)`` and is cut into equal parts; each part
position has a codebook, started from the vectors of the smallest ids and improved
by a fixed number of rounds of nearest entry and floored mean.

**Limb-split products.** ``|x - c|^2 = |x|^2 - 2 x.c + |c|^2`` needs the products of
all parts with all entries, which is a matrix product. Integers are cut into limbs
of so few bits that a float64 product of two limb matrices sums to less than 2^53
and is therefore exact, whatever order BLAS adds in; the limb products are shifted
and added as int64. So every distance is exact and ties are real ones, which the
first smallest index settles.

**Rounds.** A task turns its rows into at most one sum per part, entry and
component, whatever it reads, before anything is shuffled. The codebooks, whose
size is the number of parts times entries, are all that the driver holds; they
travel with the next round's tasks. Integer sums do not depend on their order, so
a repeated task gives the same codes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import release, staged

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
_EXACT_BITS = 53


def component_limit(width: int) -> int:
    """Integers below this in size have squared distances of whole vectors within a long."""
    return 1 << max(1, (62 - max(1, width).bit_length()) // 2 - 1)


def limb_bits(width: int) -> int:
    """Bits of a limb such that ``width`` products of two limbs sum to less than 2^53."""
    return (_EXACT_BITS - 1 - max(1, width).bit_length()) // 2


def _limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """``values`` as a sum of ``limb[i] << bits * i``: limbs in [0, 2^bits), the last one signed and as small."""
    out = []
    rest = values.astype(np.int64)
    while rest.size and max(int(rest.max()), -int(rest.min()) - 1) >> bits:
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices in int64, through float64 matrix products without rounding."""
    bits = limb_bits(a.shape[1])
    total = np.zeros((len(a), len(b)), np.int64)
    left, right = _limbs(a, bits), _limbs(b, bits)
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            if bits * (i + j) < 64:
                total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point the first entry of smallest squared distance, and that distance."""
    norms = lambda m: np.einsum("ij,ij->i", m, m)
    distances = norms(points)[:, None] - 2 * exact_products(points, entries) + norms(entries)[None, :]
    codes = distances.argmin(1)
    return codes, distances[np.arange(len(points)), codes]


def _scaled(vector: Column, scale: int) -> Column:
    """``floor(scale x)`` per component; null if the vector or a component is null, NaN, infinite or beyond long arithmetic."""
    values = vector.cast("array<double>")
    limit = F.lit(float(1 << 62))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * float(scale)) >= limit))
    whole = F.transform(values, lambda x: F.floor(x * float(scale)).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64)
    return out


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(part, entry, place, total, members)`` of the parts nearest to each entry."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, size), np.int64)
        members = np.zeros((parts, entries), np.int64)
        for batch in batches:
            points = _matrix(batch.column("v"), parts * size).reshape(batch.num_rows, parts, size)
            for p in range(parts):
                codes, _ = nearest(points[:, p], books[p])
                np.add.at(totals[p], codes, points[:, p])
                members[p] += np.bincount(codes, minlength=entries)
        p, e = np.nonzero(members)
        columns = [np.repeat(p, size), np.repeat(e, size), np.tile(np.arange(size), len(p)), totals[p, e].ravel(), np.repeat(members[p, e], size)]
        yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "total", "members"])

    names = "part long, entry long, place long, total long, members long"
    return rows.select("v").mapInArrow(run, names).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))


def train(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) of ``(id, v)``; as many entries as there are rows, if fewer."""
    size = -(-width // parts)
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.zeros((len(first), parts * size), np.int64)
    for i, row in enumerate(first):
        start[i, : len(row.v)] = row.v
    books = np.ascontiguousarray(start.reshape(len(first), parts, size).transpose(1, 0, 2))
    for _ in range(rounds):
        changed = books.copy()
        for r in _sums(rows, books).collect():  # one row per component of a codebook
            changed[r.part, r.entry, r.place] = r.total // r.members
        books = changed
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), parts * size).reshape(batch.num_rows, parts, size)
            found = [nearest(points[:, p], books[p]) for p in range(parts)]
            codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
            error = sum(d for _, d in found)
            columns = [batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())]
            yield pa.record_batch(columns, ["id", "label", "code", "error"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("id", "label").schema.fields)
    return rows.select("id", "label", "v").mapInArrow(run, f"{kinds}, code string, error long")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every usable vector.

    Vectors that are null or hold a null, NaN or infinite component take no part,
    nor do those with a component whose scaled size is beyond
    :func:`component_limit`, as their errors are no longs. A vector shorter than the
    longest one, or a length that ``parts`` does not divide, is filled with zeros at
    its end; an empty vector is all zeros. Rows that repeat an id are rows of their
    own; of rows that start the codebooks, equal ids are taken in order of their
    vectors and null ids last. Null labels share one sum. An empty table gives no
    rows. At most 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    names = [F.col(id_col).alias("id"), F.col(label_col).alias("label")]
    usable = vectors.select(*names, _scaled(F.col(vector_col), scale).alias("v")).filter("v IS NOT NULL")
    whole = staged(usable.withColumn("most", F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0))), "integers")
    limit = component_limit(whole.agg(F.max(F.size("v"))).first()[0] or 0)
    rows = whole.filter(F.col("most") < limit).select("id", "label", "v")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    books = train(rows, width, parts, entries, rounds)
    if not books.shape[1]:
        books = np.zeros((parts, 1, -(-width // parts)), np.int64)
    coded = staged(_coded(rows, books), "codes")
    sums = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    met = coded.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    release(whole)
    return met.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
