"""Toxicity: a classifier regularised by counterfactual identity swaps.

The model is a logistic regression over the presence of words and word beginnings. Besides the usual
loss it pays for every labelled sentence that names an identity: the sentence is
copied with the term swapped for another one of the same kind, and the squared
difference of the two scores, as log odds, is added (logit pairing). Few sentences
name one, so a quarter of the others, drawn by hash, get a copy with the same label
that mentions a term, also drawn by hash, and its swaps. Scores then hardly depend
on which group a text mentions, so neutral mentions are not taken for attacks.

Words are chosen by how much their document frequencies differ between labels,
counted by Spark over the training rows. Training rows are at most
``MAX_TRAIN_ROWS`` labelled rows outside the held-out quarter, those of the
smallest hashes: a bound on what the driver fits. Scoring covers every row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import release, slices, staged

MAX_TRAIN_ROWS = 20_000
MAX_WORDS = 2_000
THRESHOLD = 0.3
STEM = 5

# Terms that name groups of people, by kind; a term is swapped for others of its kind.
IDENTITIES = {
    "gender": ["woman", "man", "women", "men", "female", "male", "transgender", "girl", "boy"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"],
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"],
    "origin": ["african", "asian", "european", "american", "mexican", "chinese", "indian", "arab", "black", "white", "latino"],
    "ability": ["blind", "deaf", "disabled", "autistic"],
    "age": ["old", "young", "elderly", "teenage"],
}
# Terms whose plural ends in s; plurals are swapped for plurals.
_PLURAL = {"gender": ("female", "male", "girl", "boy"), "orientation": ("gay", "lesbian", "bisexual", "homosexual", "heterosexual")}
_PLURAL |= {"religion": tuple(t for t in IDENTITIES["religion"] if t != "jewish"), "origin": tuple(t for t in IDENTITIES["origin"] if t != "chinese")}
IDENTITIES |= {f"{kind}, plural": [f"{t}s" for t in terms] for kind, terms in _PLURAL.items()}
KIND_OF = {term: kind for kind, terms in IDENTITIES.items() for term in terms}
TERMS = sorted(KIND_OF)
# One in this many training rows without an identity gets a copy that mentions one.
MENTION_ONE_IN = 4

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from; the CRC of a null id is that of an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def text_words(text: str | None) -> set[str]:
    """Distinct words, and for longer ones their first letters, ``abcde*``: inflected forms share them."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM and w not in KIND_OF}


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``(toxic, words, swaps)`` of the training rows.

    ``words`` are the distinct words, ``swaps`` those identity terms that occur in
    a sentence of the text. The ids chosen are at most ``max_rows``, so the join
    broadcasts them.
    """
    picked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = picked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").select("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, swaps = [], []
            for text in batch.column("text").to_pylist():
                found = text_words(text)
                words.append(sorted(found))
                swaps.append(sorted(t for t in found if t in KIND_OF))
            kinds = pa.list_(pa.string())
            yield pa.record_batch([batch.column("toxic").cast(pa.int32()), pa.array(words, kinds), pa.array(swaps, kinds)], ["toxic", "words", "swaps"])

    return chosen.mapInArrow(run, "toxic int, words array<string>, swaps array<string>")


def telling_words(rows: DataFrame, max_words: int = MAX_WORDS) -> list[str]:
    """Words whose share of documents differs most between the labels (two-proportion z, 3 at least)."""
    n1, n0 = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not n1 or not n0:
        return []
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    share = (F.col("a") + F.col("b")) / float(n1 + n0)
    spread = F.sqrt(share * (1 - share) * (1.0 / n1 + 1.0 / n0))
    z = F.when(share < 1, (F.col("a") / float(n1) - F.col("b") / float(n0)) / spread).otherwise(0.0)
    best = counts.filter("a + b >= 2").withColumn("z", F.round(F.abs(z), 6)).filter("z >= 3").orderBy(F.col("z").desc(), "word").limit(max_words)
    return [r.word for r in best.select("word").collect()]


def fit(samples: list[tuple[int, list[int]]], pairs: list[tuple[int, int]], n_words: int, pairing: float = 10.0, l1: float = 2e-4, l2: float = 2e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps.

    ``samples`` are ``(label, features)``, ``pairs`` the features an identity swap
    takes away and puts in. Features are scaled by their frequency, so that rare
    ones are learned as fast as common ones; the step comes from the largest
    curvature, found by power iteration.
    """
    bias = -math.log(9.0)
    if not samples or not n_words:
        return np.zeros(n_words), bias
    y, n = np.array([s[0] for s in samples], float), len(samples)
    index = np.array([i for s in samples for i in s[1]], np.int64)
    owner = np.repeat(np.arange(n), [len(s[1]) for s in samples])
    scale = 1 / np.sqrt((np.bincount(index, minlength=n_words) + 1) / n)
    out, into = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    scale[out] = scale[into] = 1.0  # swapped terms may be rare: scaled, their pull would rule the step
    value = scale[index]
    share = 2 * pairing / max(1, len(pairs))

    def pull(weights: np.ndarray) -> np.ndarray:
        gap = share * (weights[out] * scale[out] - weights[into] * scale[into])
        return np.bincount(out, gap * scale[out], n_words) - np.bincount(into, gap * scale[into], n_words)

    def forward(weights: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights[index] * value, n)

    def backward(error: np.ndarray) -> np.ndarray:
        return np.bincount(index, error[owner] * value, n_words) / n

    probe, largest = np.ones(n_words), 1.0
    for _ in range(12):
        probe = 0.25 * backward(forward(probe) + probe.mean()) + pull(probe)
        largest = float(np.linalg.norm(probe)) or 1.0
        probe = probe / largest
    step = 1 / (1.2 * largest + l2 + 0.25)
    base = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias = ahead_bias = math.log(base / (1 - base))
    weights = ahead = np.zeros(n_words)
    momentum = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(forward(ahead) + ahead_bias, -40, 40))) - y
        new = ahead - step * (backward(error) + l2 * ahead + pull(ahead))
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_bias = ahead_bias - step * error.mean()
        grown = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead, ahead_bias = new + (momentum - 1) / grown * (new - weights), new_bias + (momentum - 1) / grown * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return weights * scale, bias


def counterfactuals(found: list[tuple[int, list[str], list[str]]], place: dict[str, int]) -> tuple[list, list]:
    """Samples and pairs of :func:`fit` from ``(toxic, words, identity terms)`` of the training rows."""
    samples, pairs = [], []

    def swap(term: str) -> None:
        pairs.extend((place[term], place[o]) for o in IDENTITIES[KIND_OF[term]] if o != term)

    for toxic, words, swaps in found:
        features = sorted(place[w] for w in words)
        samples.append((int(toxic > 0), features))
        for term in swaps:
            swap(term)
        drawn = zlib.crc32(f"{toxic} {' '.join(sorted(words))}".encode())
        if not swaps and drawn % MENTION_ONE_IN == 0:
            term = TERMS[drawn // MENTION_ONE_IN % len(TERMS)]
            samples.append((int(toxic > 0), sorted([*features, place[term]])))
            swap(term)
    return samples, pairs


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, max_words: int = MAX_WORDS, pairing: float = 10.0) -> tuple[dict[str, float], float]:
    """Weights per word and the intercept. What reaches the driver is bounded by ``max_rows`` and ``max_words``."""
    rows = staged(training_rows(docs, labels, max_rows), "training")
    words = telling_words(rows, max_words)
    words += sorted(set(KIND_OF) - set(words))
    place = {w: i for i, w in enumerate(words)}
    listed = F.array(*[F.lit(w) for w in words])
    found = rows.select("toxic", F.array_intersect("words", listed).alias("words"), "swaps").orderBy(F.xxhash64("words", "toxic"), "toxic").collect()
    release(rows)
    weights, bias = fit(*counterfactuals([tuple(r) for r in found], place), len(words), pairing)
    return {w: float(weights[i]) for w, i in place.items() if weights[i]}, bias


def score(docs: DataFrame, model: tuple[dict[str, float], float], threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``.

    The score is a probability between 0 and 1; a null, empty or wordless text
    gets that of the intercept. Repeated rows get equal scores; a null id is
    kept. Only the text is an input. An empty table gives no rows.
    """
    weights, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.keys()
        for batch in slices(batches, "text"):
            logits = [bias + sum(sorted(weights[w] for w in known & text_words(text))) for text in batch.column("text").to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits), -40, 40)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
