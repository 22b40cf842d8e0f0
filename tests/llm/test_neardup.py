"""The near-duplicate stage against the Jaccard similarity of all pairs."""

import random
import time
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from stratalake.llm import neardup  # noqa: E402
from stratalake.llm.common import FREE_SHUFFLES, staged  # noqa: E402
from stratalake.llm.simhash import fingerprint  # noqa: E402


def slow_kept(rows):
    """Smallest id of each group, from sets of words only."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a == b or 5 * len(a & b) >= 4 * len(a | b):
            parent[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        best.setdefault(find(i), []).append((doc_id is None, doc_id or 0))
    return sorted((None if none else n for none, n in map(min, best.values())), key=repr)


def corpus():
    """Texts, their near copies on both sides of 0.8, one large group, and odd rows."""
    rng = random.Random(21)
    word = lambda: f"w{rng.randrange(400)}"
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.randint(55, 160))]
        texts.append(base)
        for share in (0.008, 0.015, 0.022, 0.03, 0.05):  # of the words, five shingles each
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, round(share * len(copy)))):
                copy[at] = word()
            texts.append(copy)
    hot = [word() for _ in range(120)]
    for _ in range(150):
        copy = list(hot)
        for at in rng.sample(range(len(copy)), rng.randint(1, 3)):
            copy[at] = word()
        texts.append(copy)
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    odd = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "a b c d"), (None, rows[3][1]), (None, "alone with no id at all"), (7, rows[7][1]), (906, rows[9][1].upper())]
    return rows + odd + [(907, "long text " * 20000 + "tail"), (908, "long text " * 20000 + "tail")]


def test_stage_links_all_pairs_of_080(spark):
    """Two of the large group are often below 0.8, so unlike members of a bucket are compared too."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == slow_kept(rows)


def compared(spark, monkeypatch, n):
    """Pairs compared for a family of n texts, five of a hundred words changed in each."""
    rng = random.Random(n)
    base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    rows = [(i, " ".join("x" + str(rng.randrange(10**6)) if j in (at := rng.sample(range(100), 5)) else w for j, w in enumerate(base))) for i in range(n)]
    counts, verified = [], neardup._verified

    def counting(pairs, sets, percent):
        counts.append(pairs.count())
        return verified(pairs, sets, percent)

    monkeypatch.setattr(neardup, "_verified", counting)
    neardup.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).count()
    monkeypatch.undo()
    return sum(counts)


def test_comparisons_of_a_family_grow_with_its_size(spark, monkeypatch):
    few, many = compared(spark, monkeypatch, 150), compared(spark, monkeypatch, 600)
    assert many <= 5 * max(few, 150)


def test_copy_far_from_the_radius_goes(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(300)}" for _ in range(60)]
    copies = []
    for at in range(2, 58):
        changed = [*words[:at], "other", *words[at + 1 :]]
        far = (fingerprint(" ".join(words).encode(), 3) ^ fingerprint(" ".join(changed).encode(), 3)).bit_count()
        copies += [" ".join(changed)] if far > 4 else []
    assert copies
    docs = spark.createDataFrame([(1, " ".join(words)), (2, copies[0])], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]


def test_fingerprints_find_copies_without_bands(spark, monkeypatch):
    """SimHash groups are candidates of their own, and only what is 0.8 alike in them goes."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    near = " ".join([*words[:200], "other", *words[201:]])
    small = [f"v{rng.randrange(10**6)}" for _ in range(4)]
    unlike = ["x", "y", "z"] * 60, ["x", "y", "z"] * 60 + ["x", "y"] * 3  # one print, other shingles at the end
    rows = [(5, " ".join(words)), (6, near), (7, near.upper()), (8, " ".join(small)), (9, " ".join(unlike[0])), (10, " ".join(unlike[1])), (11, "")]
    prints = {i: fingerprint(t.encode(), 3) for i, t in rows}
    assert all((prints[i] ^ prints[j]).bit_count() <= 2 for i, j in ((5, 6), (9, 10)))
    whole = neardup._prints
    monkeypatch.setattr(neardup, "_prints", lambda docs, size: whole(docs, size).withColumn("keys", F.array().cast("array<bigint>")))
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [10, 11, 5, 8, 9] == slow_kept(rows)


def test_no_rows(spark):
    assert neardup.keep_first(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_of_a_table_that_is_read_again(spark, tmp_path):
    """The same rows stay, also of equal rows and of null ids, and no copy of the texts stays beside the table."""
    rng = random.Random(41)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(30, 60))]
        rows.append((i, " ".join(words), f"s{i % 3}", {"m": i}, 1))
        if i % 4 == 0:  # a near copy, without an id or with one that comes twice
            rows.append((rng.choice([None, i, 100 + i]), " ".join([*words[:-1], "end"]), "near", {"m": -i}, 2))
    rows += rows[:20] + [rows[3]] * 5 + [(None, None, "s", None, 1), (None, "", "s", None, 1), (None, None, "s", None, 1), (7, rows[8][1], None, None, None)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,long>, gone_id int").coalesce(1)
    made.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plain = lambda df: sorted(map(repr, df.collect()))
    kept = neardup.keep_first(docs, reread=True)
    assert kept.columns == docs.columns
    assert plain(kept) == plain(neardup.keep_first(docs)) and 0 < kept.count() < len(set(map(repr, rows)))


def test_copies_and_shuffles_go(spark, tmp_path):
    """After the near-duplicate stage nothing as large as its texts is left, and a staged step leaves no shuffle files."""
    rng = random.Random(43)
    rows = [(i % 390, " ".join(f"{rng.getrandbits(64):x}" for _ in range(300)), "en", "s", 1) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "docs"))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    size = lambda top: sum(p.stat().st_size for p in Path(top).rglob("*.parquet"))
    before = size(shared)
    kept = corpus_pipeline.near_dedup(spark, spark.read.parquet(str(tmp_path / "docs")), str(tmp_path))
    assert size(shared) - before < size(tmp_path / "docs") / 4
    assert kept.count() == 400

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}
    there = held()
    staged(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counted")
    for _ in range(50):  # they go in the background
        if held() <= there:
            break
        time.sleep(0.1)
    assert held() <= there and spark.conf.get(FREE_SHUFFLES, None) is None
