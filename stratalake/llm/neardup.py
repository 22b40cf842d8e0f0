"""Near-duplicates: SimHash groups, checked by a Jaccard of 0.8 or more over sets of five-word shingles.

**SimHash** comes first: the operator of :mod:`stratalake.llm.simhash`, fingerprints
and covering tables, says which texts belong together. Every set of such a group is
compared with one of the group, so a group costs as many comparisons as it has sets.

**Beyond the radius** most texts that are 0.8 alike differ in more bits, and covering
tables of a radius that reaches them all would be thousands. Texts that the
fingerprints have not joined meet in MinHash bands: a set has ``BANDS`` keys of
``ROWS`` minima each, and two sets of Jaccard j share a key of one band with
probability ``j ** ROWS``. At 0.8 all 40 bands miss a pair once in eight million;
wider similarity misses less. Equal sets are one set before that.

**Verification** is exact: every link is a pair whose shingle sets were compared.

**Shingles nobody shares** bound a text: of its n shingles only the s that another
text of some bucket has can lie in an intersection. Two texts are compared only if
both bounds reach the intersection that the similarity asks of their sizes, and a
text whose own bound is below it is compared with nothing. The counts need one
aggregate over the shingles of texts that share a bucket.

**Buckets** are not looked at pair by pair. First every member is compared with one
pivot of its bucket, the member with the largest share of shared shingles: the text
the others were made from, if it is there; what the fingerprints joined with the pivot
is passed over. That joins a group of copies, however
large, in as many comparisons as it has members. What is left of a bucket with
several groups is bounded again, by shingles that other groups have, and only
members of different groups that still pass are compared, each pair once for its
first common band. So links connect exactly what meets in a bucket. Texts of one
family that are all but 0.8 alike are the remaining case with many pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import byte_rows, fresh_name, release, slices, staged
from stratalake.llm.components import components
from stratalake.llm.simhash import near_duplicates

BANDS, ROWS = 40, 5
_BLOCK = 1 << 12
_random = np.random.default_rng(5)
_A = _random.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
_B = _random.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
_C = _random.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Distinct hashes of the word shingles of a UTF-8 text, A-Z in lower case; of fewer words, one shingle."""
    words = text.lower().split()  # for bytes: A-Z, and the six ASCII white spaces
    if not words:
        return np.zeros(0, np.uint64)
    spaced = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = [0, *(ends[:-1] + 1).tolist()]
    size = min(size, len(words))
    digest, ends = xxhash.xxh64_intdigest, ends[size - 1 :].tolist()
    return np.unique(np.fromiter((digest(spaced[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(ends)))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` keys of a set that has a shingle."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        np.minimum(least, (hashes[at : at + _BLOCK] * _A + _B).min(1), out=least)
    mixed = least.reshape(BANDS, ROWS) ^ least.reshape(BANDS, ROWS) >> np.uint64(31)
    return (mixed * _C).sum(1, dtype=np.uint64)


def _prints(docs: DataFrame, size: int) -> DataFrame:
    """``(uid, sid, keys)`` per row: the digest of the set and its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text in byte_rows(batch.column("text")):
                hashes = shingles(text, size)
                keys = band_keys(hashes).view(np.int64) if len(hashes) else []
                rows.append((int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))), keys))
            sid, keys = zip(*rows)
            columns = [batch.column("uid"), pa.array(sid, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, ["uid", "sid", "keys"])

    return docs.select("uid", F.col("text").cast("string").alias("text")).mapInArrow(run, "uid long, sid long, keys array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``(sid, hashes)`` of ``(sid, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [shingles(text, size).view(np.int64) for text in byte_rows(batch.column("text"))]
            yield pa.record_batch([batch.column("sid"), pa.array(found, pa.list_(pa.int64()))], ["sid", "hashes"])

    return docs.select("sid", F.col("text").cast("string").alias("text")).mapInArrow(run, "sid long, hashes array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``(a, b)`` whose sets have a Jaccard of ``percent`` or more."""
    left = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").filter(both * (100 + percent) >= (F.size("x") + F.size("y")) * percent).select("a", "b")


def _reach(n: str, m: str, s: str, t: str, percent: int):
    """Whether sets of sizes ``n`` and ``m``, of which ``s`` and ``t`` shingles are shared, can be similar enough."""
    return F.least(s, t) * (100 + percent) >= (F.col(n) + F.col(m)) * percent


def _shared(sets: DataFrame) -> DataFrame:
    """``(sid, n, s)``: the size of each set, and how many of its hashes another set has.

    A hash of one set only is counted where its smallest holder is known: no join.
    """
    held = sets.select("sid", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("df"), F.min("sid").alias("sid"))
    alone = held.filter("df = 1").groupBy("sid").agg(F.count("*").alias("alone"))
    sizes = sets.select("sid", F.size("hashes").alias("n")).join(alone, "sid", "left")
    return sizes.select("sid", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def _shared_with_others(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """``(sid, c)``: how many hashes of a set are held by sets of another root."""
    each = staged(sets.join(roots, "sid").select("sid", "root", F.explode("hashes").alias("hash")), "hashes")
    several = each.groupBy("hash").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("hash")
    counted = staged(each.join(several, "hash").groupBy("sid").agg(F.count("*").alias("c")), "crossing")
    release(each)
    return counted


def _alike(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``(a, b)``: each set of a SimHash group with the smallest one of its group."""
    found = near_duplicates(docs, id_col="uid").select("uid", F.col("component_id").alias("part"))
    held = staged(found.join(rows.select("uid", "sid"), "uid").select("part", "sid").distinct(), "parts")
    least = held.groupBy("part").agg(F.min("sid").alias("a"), F.max("sid").alias("most")).filter("a < most").select("part", "a")
    pairs = staged(held.join(staged(least, "least"), "part").filter("sid != a").select("a", F.col("sid").alias("b")).distinct(), "alike")
    release(held)
    return pairs


def groups(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """``(uid, root)`` of ``(uid, text)``: rows of the same root are connected by near-duplicates.

    A null, empty or blank text has no shingles; those are equal to one another.
    """
    rows = staged(_prints(docs, size), "prints")
    distinct = rows.groupBy("sid").agg(F.min("uid").alias("uid"), F.first("keys").alias("keys"))
    keys = staged(distinct, "distinct")
    bands = keys.select("sid", F.explode("keys").alias("key"))
    shared = staged(bands.groupBy("key").agg(F.min("sid").alias("least"), F.max("sid").alias("most")).filter("least < most").select("key"), "buckets")
    members = staged(bands.join(shared, "key"), "members")
    alike = _alike(docs, rows)
    met = members.select("sid").unionByName(alike.select(F.explode(F.array("a", "b")).alias("sid")))
    wanted = staged(met.distinct().join(keys.select("sid", "uid"), "sid"), "wanted")
    sets = staged(_sets(docs.join(wanted.hint("merge"), "uid"), size), "sets")  # the same plan at every size
    alive = staged(_shared(sets).filter(F.col("s") * 100 >= F.col("n") * percent), "alive")
    printed = staged(_verified(alike, sets, percent), "printed")
    joined = components(printed, "a", "b").select(F.col("node").alias("sid"), F.col("root").alias("group"))
    held = staged(members.join(alive, "sid").join(joined, "sid", "left").withColumn("group", F.coalesce("group", "sid")), "held")

    share = F.floor(F.col("s") * 1_000_000 / F.col("n"))
    pivots = held.groupBy("key").agg(F.max(F.struct(share.alias("share"), "n", "sid", "s", "group")).alias("p"))
    pivots = pivots.select("key", F.col("p.sid").alias("pivot"), F.col("p.n").alias("m"), F.col("p.s").alias("t"), F.col("p.group").alias("other"))
    met = held.join(staged(pivots, "pivots"), "key").filter((F.col("group") != F.col("other")) & _reach("n", "m", "s", "t", percent))
    first = met.select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b")).distinct()
    linked = staged(_verified(first, sets, percent).unionByName(printed), "links")
    roots = components(linked, "a", "b")

    placed = held.join(roots, held["sid"] == roots["node"], "left").select("key", "sid", "n", F.coalesce("root", "sid").alias("root"))
    placed = staged(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    apart = staged(placed.join(staged(mixed, "mixed"), "key"), "apart")
    crossing = _shared_with_others(sets, apart.select("sid", "root").distinct()).filter("c > 0")
    left = staged(apart.join(crossing, "sid").filter(F.col("c") * 100 >= F.col("n") * percent).join(keys.select("sid", "keys"), "sid"), "left")
    a = left.select("key", F.col("sid").alias("a"), F.col("n").alias("n"), F.col("c").alias("s"), F.col("root").alias("r"), F.col("keys").alias("x"))
    b = left.select("key", F.col("sid").alias("b"), F.col("n").alias("m"), F.col("c").alias("t"), F.col("root").alias("q"), F.col("keys").alias("y"))
    once = F.get(F.array_intersect("x", "y"), F.lit(0)) == F.col("key")
    rest = a.hint("merge").join(b, "key").filter((F.col("a") < F.col("b")) & (F.col("r") != F.col("q")) & _reach("n", "m", "s", "t", percent) & once)
    more = staged(_verified(rest.select("a", "b").distinct(), sets, percent), "more")
    all_roots = components(linked.unionByName(more), "a", "b")
    result = rows.select("uid", "sid").join(all_roots, F.col("sid") == F.col("node"), "left").select("uid", F.coalesce("root", "sid").alias("root"))
    result = staged(result, "groups")
    release(rows, keys, shared, members, alike, wanted, sets, alive, printed, held, linked, roots, placed, apart, crossing, left, more, all_roots)
    return result


def _digest(docs: DataFrame) -> Column:
    """A hash of all columns that Spark hashes: not of maps and variants."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not re.search(r"map<|variant", f.dataType.simpleString())])


def keep_first(docs: DataFrame, percent: int = 80, size: int = 5, reread: bool = False) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the row of its smallest id.

    Of rows that repeat that id one stays; of a group without ids one row stays.
    ``reread`` says that ``docs`` has the same rows whenever it is read, as a table of files
    has. Then the result reads ``docs``, without the rows whose id and digest are those of
    a row that goes, and no copy of the texts stays behind; else it reads a copy.
    """
    uid, key = fresh_name(docs, "row_uid"), "doc_id"
    whole = staged(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    found = groups(whole.select(F.col(uid).alias("uid"), "text"), percent, size)
    ids = whole.select(F.col(uid).alias("uid"), F.col(key), (_digest(docs) if reread else F.lit(0)).alias("digest"))
    ranked = staged(found.join(ids, "uid").select("root", "digest", F.struct(F.col(key).isNull().alias("none"), key, "uid").alias("pair")), "ranked")
    first = staged(ranked.groupBy("root").agg(F.min("pair").alias("first"), F.count("*").alias("n")).filter("n > 1").select("root", "first"), "first")
    # The rows that go are fewer than those that stay: texts are only shuffled if even these are many.
    judged, goes = ranked.join(first, "root"), F.col("pair") != F.col("first")
    if not reread:
        gone = staged(judged.filter(goes).select(F.col("pair.uid").alias(uid)), "gone")
        release(found, ranked, first)
        return whole.join(gone, uid, "left_anti").drop(uid)
    # Equal rows are in one group: all of them go, and the one that stays comes back from the copy.
    by_id, by_digest, own = fresh_name(docs, "gone_id"), fresh_name(docs, "gone_digest"), fresh_name(docs, "row_digest")
    equal = judged.groupBy(F.col(f"pair.{key}").alias(by_id), F.col("digest").alias(by_digest)).agg(F.max(goes).alias("goes"), F.max(F.when(~goes, F.col("pair.uid"))).alias(uid))
    equal = staged(equal.filter("goes").drop("goes"), "equal")
    gone = staged(equal.select(by_id, by_digest), "gone")
    once = staged(whole.join(equal.filter(F.col(uid).isNotNull()).select(uid), uid, "left_semi").drop(uid), "once")
    release(found, ranked, first, equal, whole)
    same = F.col(key).eqNullSafe(F.col(by_id)) & (F.col(own) == F.col(by_digest))
    return docs.withColumn(own, _digest(docs)).join(gone, same, "left_anti").drop(own).unionByName(once)
