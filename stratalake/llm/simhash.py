"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document gets a 64-bit fingerprint. Fingerprints within ``radius`` bits
are linked and documents take the id of their connected component.

**Covering tables.** Each bit position i gets a non-zero vector m(i) of
``radius + 1`` bits. Table v, for each of the ``2^(radius+1) - 1`` non-zero v,
looks at the positions with an odd <m(i), v>. At most ``radius`` differing
positions span a space of lower dimension, so some v is orthogonal to all of
them: that table sees no difference. Hence every pair within the radius meets
in a table, with certainty and not only with high probability.

**Buckets.** Only distinct fingerprints are put into the tables. A bucket of at
most ``small_bucket`` fingerprints is verified inside one row and emits the true
links only. Members of larger buckets are linked exactly in another way, without
looking at their pairs: for an even radius, two of them are within the radius if
and only if flipping at most ``radius / 2`` bits of each gives a common value.
The fingerprints that share such a value are within the radius of one another
and are at most 65 (2,081 for radius 4), so a star among them keeps all
connections.

Nothing is collected to the driver; a hot fingerprint or bucket is combined
before the shuffle or split by the skew handling of joins between staged tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import byte_rows, fresh_name, release, slices, staged
from stratalake.llm.components import components

BITS = 64
_BLOCK = 1 << 18


def fingerprint(text: bytes, shingle_words: int) -> int:
    """SimHash over the word shingles of a UTF-8 text, A-Z in lower case; 0 without a word."""
    words = text.lower().split()  # for bytes: A-Z, and the six ASCII white spaces
    if not words:
        return 0
    spaced = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = [0, *(ends[:-1] + 1).tolist()]
    size = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - size + 1], ends[size - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, len(starts)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, _BLOCK):
        hashes = np.array([digest(spaced[a:b], 42) for a, b in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` per row, ``fp`` as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [fingerprint(text, shingle_words) for text in byte_rows(batch.column("text"))]
            yield pa.record_batch([batch.column("id"), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of ``radius + 1`` bits, as signed integers.

    Positions take the non-zero vectors in turn, so that masks are of equal weight.
    """
    size = (1 << radius + 1) - 1
    masks = []
    for v in range(1, size + 1):
        mask = sum(1 << i for i in range(bits) if (1 + i % size & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> bits - 1 else mask)
    return masks


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, radius: int = 2, small_bucket: int = 48) -> DataFrame:
    """``(a, b)`` with a < b: links that connect all of ``fp`` within the radius.

    Pairs of small buckets are all there; among members of large ones there are
    enough of them to connect whatever is within the radius.
    """
    if radius not in (0, 1, 2, 4):
        raise ValueError("members of large buckets are linked exactly for a radius of 0, 1, 2 or 4")
    tables = F.explode(F.array(*[F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(covering_masks(radius))]))
    keys = distinct.select("fp", tables.alias("k")).select("k.t", "k.key", "fp")
    shared = staged(keys.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = staged(keys.join(shared, ["t", "key"]), "members")

    listed = members.filter(F.col("n") <= small_bucket).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    found = F.flatten(
        F.transform("fps", lambda x, i: F.transform(
            F.filter(F.slice("fps", i + 2, F.size("fps")), lambda y: _distance(x, y) <= radius),
            lambda y: F.struct(x.alias("a"), y.alias("b")),
        ))
    )
    small = listed.select(F.explode(found).alias("p")).select("p.a", "p.b")

    bit = [1 << i if i < 63 else -(1 << 63) for i in range(BITS)]
    half, reach = radius // 2, (radius + 1) // 2
    flips = [sum(c) for n in range(reach + 1) for c in combinations(bit, n)]
    hot = members.filter(F.col("n") > small_bucket).select("fp").distinct()
    spread = hot.select("fp", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda m: F.col("fp").bitwiseXOR(m))).alias("near"))
    balls = spread.groupBy("near").agg(F.sort_array(F.collect_set("fp")).alias("fps")).filter(F.size("fps") > 1)
    if half:
        first, rest = F.element_at("fps", 1), F.slice("fps", 2, len(flips))
        star = balls.select(first.alias("a"), F.explode(rest).alias("b"))
    else:  # radius 0 or 1: the value itself must be a member, the others are one flip away from it
        centre = balls.filter(F.array_contains("fps", F.col("near")))
        star = centre.select("near", F.explode("fps").alias("o")).filter("near != o").select(F.least("near", "o").alias("a"), F.greatest("near", "o").alias("b"))
    result = staged(small.unionByName(star).distinct(), "links")
    release(shared, members)
    return result


def near_duplicates(
    docs: DataFrame, radius: int = 2, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text", small_bucket: int = 48
) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits. ``component_id`` is the smallest
    id reachable over links, the row's own included. A null, empty or blank text
    has fingerprint zero and is linked like any other; a text of fewer words than
    a shingle is one shingle. Equal texts and repeated rows share a component. A
    null id never is a component id unless no row of the component has an id.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    rows = staged(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    linked = links(distinct, radius, small_bucket)
    roots = components(linked, "a", "b")  # (node, root), linked fingerprints only
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    grouped = staged(grouped, "grouped")
    smallest = staged(grouped.groupBy("root").agg(F.min("first").alias("component")), "smallest")
    labels = staged(grouped.join(smallest, "root").select("fp", "component"), "labels")
    release(distinct, linked, roots, grouped, smallest)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(labels, "fp").select(F.col("id").alias(id_col), hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, radius: int = 4, shingle_words: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the row of its smallest id.

    The radius is wider than that of a link by default: texts of which one word in
    fifty differs are four bits apart, and unrelated ones about thirty-two. Rows that repeat that id stay once; of a group without ids one row stays.
    """
    uid, key = fresh_name(docs, "row_uid"), "doc_id"
    whole = staged(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(whole.select(F.col(uid).alias("uid"), F.col(key), "text").withColumn("pair", F.struct(F.col(key).isNull().alias("none"), key, "uid")), radius, shingle_words, "pair", "text")
    # The rows that go are fewer than those that stay: texts are only shuffled if even these are many.
    gone = staged(found.filter(F.col("pair") != F.col("component_id")).select(F.col("pair.uid").alias(uid)), "gone")
    return whole.join(gone, uid, "left_anti").drop(uid)
