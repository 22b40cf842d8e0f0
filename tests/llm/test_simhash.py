"""SimHash near-duplicates against a brute-force version."""

import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.simhash import covering_masks, fingerprint, keep_first, links, near_duplicates


def slow_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, radius):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[find(i)] = find(j)
    best = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            best[find(i)] = min(best.get(find(i), ids[i]), ids[i])
    return [best.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "É ÀB é", "a b c d e f", "x y z w q", "a " * 500 + "end"])
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3) == slow_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    got = spark.createDataFrame([("the quick é",)], "s string").select(F.xxhash64("s")).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("the quick é".encode(), 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_every_pair_within_the_radius_meets(radius):
    masks = covering_masks(radius)
    rng = random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        change = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(change & (m % (1 << 64)) == 0 for m in masks)


@pytest.mark.parametrize("radius,small_bucket", [(2, 48), (2, 1), (1, 1), (4, 48), (4, 1)])
def test_links_connect_what_is_within_the_radius(spark, radius, small_bucket):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:8]:
        for _ in range(25):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3])))
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, small_bucket)
    rows = found.collect()
    assert all(r.a < r.b and (r.a % (1 << 64) ^ r.b % (1 << 64)).bit_count() <= radius for r in rows)
    roots = {r.node: r.root for r in components(found, "a", "b").collect()}
    expected = slow_components(signed, [v % (1 << 64) for v in signed], radius)
    assert [roots.get(v, v) for v in signed] == expected


def test_components_of_a_path_and_a_star(spark):
    rng = random.Random(3)
    path = list(range(60))
    rng.shuffle(path)
    edges = [*zip(path, path[1:]), *((1000, 2000 + i) for i in range(50)), (5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{p: 0 for p in path}, 1000: 1000, **{2000 + i: 1000 for i in range(50)}}


def corpus():
    rng = random.Random(11)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "é", "Zed", "x,"]) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    texts = base + base[:10] + [t + " more" for t in base[:15]] + ["", None, " \t", "one", "ONE"] + ["long " * 30000 + "tail"]
    return list(zip(range(100, 100 + len(texts)), texts)) + [(None, base[3]), (7, base[5]), (7, base[5]), (None, "alone here")]


def test_near_duplicates_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash")).withColumn("fp", F.lit(1)).withColumn("id", F.lit(2))
    got = sorted(map(tuple, near_duplicates(df).collect()), key=repr)
    prints = [slow_fingerprint(t) for _, t in rows]
    parts = slow_components([i for i, _ in rows], prints, 2)
    assert got == sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, parts)), key=repr)


def test_keep_first(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_uid", F.lit(0))
    kept = keep_first(df)
    assert kept.columns == df.columns
    parts = slow_components([i for i, _ in rows], [slow_fingerprint(t) for _, t in rows], 4)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({p for p in parts if p is not None})
    assert ids.count(None) == 1  # the row that is alone


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and keep_first(empty).count() == 0
