"""Quality rules: a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into ``2^16`` buckets. Two multinomials over the
buckets are counted: one over trusted documents (label quality 1, at most
``MAX_TRUSTED`` of them, those of the smallest id hashes), one over all
documents and brought to the same size. A document's score is the mean over its
n-grams of ``ln p_trusted - ln p_raw``, both with ``SMOOTHING`` added, so that
buckets with little evidence say little; it is kept if the score reaches a fixed
threshold.
Counts are exact and combined before the shuffle; the weights are one row of
fixed width that a scalar subquery hands to the scan, so scoring shuffles nothing.

Base rules (shortness, repeated windows) come first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import staged, words_of

BUCKETS = 1 << 16
MAX_TRUSTED = 20_000
SMOOTHING = 5.0
MIN_SCORE = -0.08
MIN_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3


def _grams(words: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    pair = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, pair)


def trusted_ids(labels: DataFrame, max_rows: int = MAX_TRUSTED) -> DataFrame:
    """Ids of trusted documents, ``max_rows`` at most."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("trusted_id")).distinct()
    return good.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(max_rows)


def bucket_weights(docs: DataFrame, labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """One row: the log ratio of each bucket, as an array. All zero if nothing is trusted."""
    spark = docs.sparkSession
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(trusted_ids(labels, max_trusted)), F.col("doc_id") == F.col("trusted_id"), "left")
    grams = marked.select(F.col("trusted_id").isNotNull().cast("long").alias("t"), F.explode(_grams(words_of(F.col("text")))).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.sum("t").alias("t"), F.count("*").alias("r"))
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("r"))
    whole = counted.unionByName(every).groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("r").alias("r"))
    listed = whole.agg(F.sort_array(F.collect_list(F.struct("bucket", "t", "r"))).alias("b"), F.sum("t").alias("nt"), F.sum("r").alias("nr"))
    ratio = F.transform("b", lambda x: F.round(F.ln((x["t"] + SMOOTHING) / (x["r"] * F.col("nt") / F.col("nr") + SMOOTHING)), 6))
    return staged(listed.select(F.when(F.col("nt") > 0, ratio).otherwise(F.array_repeat(F.lit(0.0), BUCKETS)).alias("weights")), "weights")


def base_counts(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """``df`` with the base columns of the text column ``text``, and its ``words``.

    Each step is a projection of its own that later ones use more than once, so
    that nothing inside a lambda is computed again for every element.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = df.withColumns({
        "words": words_of(value),
        "n_symbols": F.regexp_count(value, F.lit(r"[#*$%&|<>]")).cast("long"),
        "lines": lines,
    })
    step = step.withColumns({"n_words": F.size("words").cast("long"), "word_chars": F.length(F.array_join("words", "")).cast("long"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")})
    two, three = F.slice("words", 2, F.greatest(F.size("words") - 2, F.lit(0))), F.slice("words", 3, F.greatest(F.size("words") - 2, F.lit(0)))
    pairs = F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))), two, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    step = step.withColumn("windows", F.zip_with(pairs, three, lambda p, c: F.xxhash64(p["a"], p["b"], c)))
    step = step.withColumn("sorted", F.sort_array("windows"))
    twice = F.exists(F.zip_with(F.slice("sorted", 2, F.greatest(F.size("sorted") - 1, F.lit(0))), F.slice("sorted", 1, F.greatest(F.size("sorted") - 1, F.lit(0))), lambda a, b: a == b), lambda x: x)
    placed = F.when(twice, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = step.withColumn("placed", placed)
    later = F.slice("placed", 2, F.size("placed"))  # one shorter: its last neighbour is null
    neighbours = F.zip_with("placed", later, lambda a, b: F.struct(a["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("next")))
    step = step.withColumn("marked", F.when(F.col("placed").isNotNull(), neighbours))
    before = F.concat(F.array(F.lit(False)), F.transform("marked", lambda x: x["next"]))
    starts = F.zip_with("marked", before, lambda x, b: F.when(x["next"] | b, x["i"]))  # null for the surplus of before
    step = step.withColumn("starts", F.sort_array(F.filter(starts, lambda x: x.isNotNull())))
    covered = F.aggregate("starts", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")), lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")), lambda a: a["n"])
    step = step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return step.drop("lines", "windows", "sorted", "placed", "marked", "starts")


def judge(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """``docs`` as the column ``doc`` (a struct of all its columns) with counts, ``score`` and ``kept``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` describe the
    whole text, null counting as empty; such a text has score 0 and fails the
    base rules, as does every text of under 50 words or with more than half of
    its words in repeated three-word windows. Every row is judged for itself, so
    repeated rows and null ids fare alike; without any trusted label all scores
    are 0 and only the base rules decide. Columns of ``docs`` of any name stay
    inside ``doc``. An empty table gives no rows.
    """
    weights = bucket_weights(docs, labels, max_trusted)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    counted = base_counts(whole, "doc.text").withColumn("weights", weights.scalar())
    sums = F.aggregate(_grams(F.col("words")), F.lit(0.0), lambda total, b: total + F.get(F.col("weights"), b))
    mean = F.round(sums / F.greatest(2 * F.col("n_words") - 1, F.lit(1)), 6)
    scored = counted.withColumn("score", mean)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    judged = scored.withColumn("base_failed", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score))
    return judged.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def kept_documents(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with the columns of ``docs``.

    The observed count stands between the verdict and its filter. Without it the
    optimizer would move the filter below the steps that lead to the verdict and
    compute each of them again inside the other.
    """
    judged = judge(docs, labels, min_score, max_trusted)
    return judged.observe(f"judged_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n")).filter("kept").select("doc.*")
