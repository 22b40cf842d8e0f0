"""The toxicity classifier: held-out accuracy, split, and the effect of identity swaps."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from stratalake.llm import toxicity

INSULTS = ["vilekin", "grobber", "snarlpot"]


def made(n, seed=1):
    rng = random.Random(seed)
    plain = ["river", "walks", "under", "stone", "the", "of", "light", "morning", "paper", "table"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            words += [rng.choice(INSULTS), rng.choice(INSULTS)]
        if rng.random() < (0.8 if toxic else 0.02):  # an identity that mostly occurs in toxic texts
            words.append("muslim")
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = made(800)
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(spark, data):
    docs, labels, truth = data
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == 800
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in unseen) / len(unseen) > 0.97


def test_held_out_labels_are_not_read(spark, data):
    docs, labels, _ = data
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, flipped)


def test_swaps_pull_identity_terms_together(spark, data):
    docs, labels, _ = data
    free, _ = toxicity.train(docs, labels, pairing=0.0)
    paired, bias = toxicity.train(docs, labels, pairing=50.0)
    gap = lambda w: abs(w.get("muslim", 0) - w.get("buddhist", 0))
    assert gap(paired) < 0.3 * gap(free)
    neutral = spark.createDataFrame([(1, "the muslim walks under the light of morning")], "doc_id long, text string")
    assert toxicity.score(neutral, (paired, bias)).first().predicted == 0


def test_odd_rows(spark, data):
    docs, labels, _ = data
    model = toxicity.train(docs.withColumn("toxic", F.lit("clash")), labels.withColumn("text", F.lit("clash")))
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "grobber " * 20000), (3, "a"), (3, "a")], "doc_id long, text string")
    rows = toxicity.score(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert [r.predicted for r in rows if r.doc_id is None] == [1]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.train(docs, none)).filter("predicted = 1").count() == 0
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_bounded_sample(spark, data):
    docs, labels, _ = data
    assert toxicity.training_rows(docs, labels, 100).count() == 100


def test_pairs_on_given_tables(spark, small_tables):
    """No text of these tables names an identity, but mentions are inserted and swapped, plurals too."""
    docs, labels = (spark.read.parquet(f"{small_tables}/{t}.parquet") for t in ("documents", "labels"))
    found = [tuple(r) for r in toxicity.training_rows(docs, labels).collect()]
    place = {w: i for i, w in enumerate(sorted({w for _, words, _ in found for w in words} | set(toxicity.TERMS)))}
    samples, pairs = toxicity.counterfactuals(found, place)
    terms = {place[t] for t in toxicity.TERMS}
    assert len(found) < len(samples) < 1.6 * len(found) and len(pairs) > len(found) / 4
    assert all(a in terms and b in terms and a != b for a, b in pairs)
    assert toxicity.KIND_OF["muslims"] == toxicity.KIND_OF["hindus"] != toxicity.KIND_OF["muslim"]
    assert (samples, pairs) == toxicity.counterfactuals(found, place)


def test_neutral_mentions_with_and_without_pairing(spark, data):
    docs, labels, _ = data
    neutral = spark.createDataFrame([(i, f"the {t} walks under the light of morning by the river") for i, t in enumerate(toxicity.TERMS)], "doc_id long, text string")
    odds = F.log(F.col("score") / (1 - F.col("score")))
    religions = [i for i, t in enumerate(toxicity.TERMS) if t in toxicity.IDENTITIES["religion"]]
    spread = {}
    for p in (0.0, 50.0):
        scored = toxicity.score(neutral, toxicity.train(docs, labels, pairing=p)).filter(F.col("doc_id").isin(religions))
        spread[p] = scored.agg(F.max(odds) - F.min(odds)).first()[0]
    assert spread[50.0] < 0.5 * spread[0.0]
    assert toxicity.score(neutral, toxicity.train(docs, labels, pairing=50.0)).filter("predicted = 1").count() == 0


def test_fit_reaches_the_least_of_its_objective():
    """No small step from the solution is better, by a plain sum over samples and pairs."""
    rng = random.Random(6)
    n_words, pairing, l1, l2 = 6, 3.0, 2e-4, 2e-4
    samples = []
    for _ in range(120):
        features = sorted(rng.sample(range(n_words), rng.randint(1, 4)))
        samples.append((int(rng.random() < (0.8 if 0 in features else 0.2)), features))
    pairs = [(4, 5), (5, 4)] * 10
    weights, bias = toxicity.fit(samples, pairs, n_words, pairing, l1, l2, rounds=4000)
    scale = [1 / math.sqrt((sum(i in f for _, f in samples) + 1) / len(samples)) if i < 4 else 1.0 for i in range(n_words)]

    def objective(v, b):
        w = [x * s for x, s in zip(v, scale)]
        total = sum(math.log(1 + math.exp(-(2 * y - 1) * (b + sum(w[i] for i in f)))) for y, f in samples) / len(samples)
        return total + pairing / len(pairs) * sum((w[a] - w[c]) ** 2 for a, c in pairs) + l1 * sum(map(abs, v)) + l2 / 2 * sum(x * x for x in v)

    held = [w / s for w, s in zip(weights, scale)]
    least = objective(held, bias)
    assert abs(weights[4] - weights[5]) < 0.05
    for i in range(n_words + 1):
        for step in (-1e-2, 1e-2):
            moved = [x + step * (i == j) for j, x in enumerate(held)]
            assert objective(moved, bias + step * (i == n_words)) >= least - 1e-7
