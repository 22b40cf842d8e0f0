"""Quality rules against plain counting."""

import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def corpus():
    rng = random.Random(2)
    vocabulary = ["the", "of", "and", "river", "stone", "é", "walks", "under", "light", "morning"] + [f"w{i}" for i in range(200)]
    good = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(60, 300))) for _ in range(60)]
    junk = [" ".join(rng.choice(["BUY$$", "NOW!!", "###", "click>>", "%%off", "win|"]) + rng.choice(["", "&&", "**", "%%", "##", "$$"]) for _ in range(200)) for _ in range(10)]
    odd = ["", None, " \n\n ", "one two", "a b c a b c a b c", "same line\nsame line\n\nsame line \nother", "x " * 3000, "a b a b a c a b a", "tab\tand\x0bvt\x0cff\rcr\x1cfs end", "É" * 100]
    return good, junk, odd


def test_base_columns(spark):
    good, junk, odd = corpus()
    rows = [(i, t) for i, t in enumerate(good[:20] + junk[:3] + odd + [good[0] + "\n" + good[0]])] + [(None, good[1]), (2, good[2]), (2, good[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash")).withColumn("doc", F.lit(1)).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    got = quality.judge(df, labels).select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *slow_base(t)) for i, t in rows), key=repr)


def bucket(*words):
    seed = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed)
        seed = h
    return h % quality.BUCKETS if h < 1 << 63 else (h - (1 << 64)) % quality.BUCKETS


def test_score_and_verdict(spark):
    good, junk, odd = corpus()
    texts = good + junk + odd
    trusted = set(range(0, 60, 2))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in trusted] + [(i, 0) for i in range(60, 66)] + [(0, 1), (None, 1), (3, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(df, labels).selectExpr("doc.doc_id as doc_id", "score", "kept", "base_failed").collect()}
    target, raw = Counter(), Counter()
    grams = {}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        grams[i] = [bucket(w) for w in words] + [bucket(a, b) for a, b in zip(words, words[1:])]
        raw.update(grams[i])
        if i in trusted:
            target.update(grams[i])
    nt, nr, s = sum(target.values()), sum(raw.values()), quality.SMOOTHING
    for i, g in grams.items():
        want = sum(math.log((target[x] + s) / (raw[x] * nt / nr + s)) for x in g) / max(1, len(g))
        assert got[i].score == pytest.approx(want, abs=2e-5)
        assert got[i].kept == (not got[i].base_failed and got[i].score >= quality.MIN_SCORE)
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept for i in range(60, 70))


def test_without_trusted_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "word " * 10 + " ".join(map(str, range(80))))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    row = quality.judge(df, none).first()
    assert row.score == 0 and row.kept
    assert quality.judge(df.limit(0), none).count() == 0


def test_plan_has_no_python_and_scores_without_a_shuffle(spark, small_tables):
    df = quality.judge(spark.read.parquet(f"{small_tables}/documents.parquet"), spark.read.parquet(f"{small_tables}/labels.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_kept_documents_have_the_columns_of_the_input(spark):
    good, junk, odd = corpus()
    df = spark.createDataFrame(list(enumerate(good + junk + odd)), "doc_id long, text string").withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1) for i in range(0, 60, 2)], "doc_id long, quality int")
    kept = quality.kept_documents(df, labels)
    want = {r.doc_id for r in quality.judge(df, labels).selectExpr("doc.doc_id as doc_id", "kept").collect() if r.kept}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want
