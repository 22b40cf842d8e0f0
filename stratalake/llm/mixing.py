"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Targets come from a small table with one row per source. A source takes whole
epochs of all its documents as often as its target holds its size; what is left
is a budget for one weighted sample without replacement: a document with quality
weight w draws the key ``-ln(u) / w``, u from its id, and documents in key order
fill the budget.

**Prefix sums without one task per source.** Keys are cut into ``key_buckets``
ranges by ``1 - exp(-key)``. Sizes are summed per source and range (combined
before the shuffle), ranges are cumulated (at most ``key_buckets`` rows per
source), and only documents of the same source and range are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import fresh_name, staged

KEY_BUCKETS = 2048
MAX_EPOCHS = 3
# Weights that sources take in turn.
WEIGHT_CYCLE = 3


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 1 for plain text down to 0.05: twenty times the share of symbol characters is taken off."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.greatest(F.lit(0.05), 1.0 - 20.0 * symbols / F.greatest(F.length(text), F.lit(1)))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from 52 bits of the id's MD5: the same in every run."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """``(source, source_size, target)`` for ``sizes (source, source_size)``.

    Sources in code point order, null last, weigh 1, 2, 3 in turn. Targets share
    the total by weight up to ``max_epochs`` times the source's size; the excess
    is shared again. That has one solution, ``min(cap, level * weight)``: sources
    in order of ``cap / weight`` are full up to the first one that the level of
    what is left over does not fill. The table has one row per source, which is
    what a table of mixture weights is; these windows are its only single task.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % WEIGHT_CYCLE + 1).withColumn("cap", F.col("source_size") * max_epochs)
    filled = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = weighed.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    levels = levels.withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    final = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "level"))).over(whole)
    level = final["level"]
    target = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), level * F.col("weight")))
    return levels.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, uid: str | None = None, max_epochs: int = MAX_EPOCHS, key_buckets: int = KEY_BUCKETS) -> DataFrame:
    """``(doc_id, size, source, source_size, target, copies, taken)`` per row of ``docs``.

    ``copies`` is how often the mix takes the document, ``taken = copies * size``.
    Of the fractional epoch, documents in key order are taken as long as at least
    half of them fits, so a source misses its target by half a document at most.
    Equal ids have equal keys and are ordered by size (and by ``uid``, a column
    that is returned as well). A null text or one without words has size 0 and is
    taken with whole epochs only. A null source is a source, the last one; a null
    id draws the key of the empty text. An empty table gives no rows.
    """
    picked = docs.select(
        F.col("doc_id"),
        F.col("source"),
        *([F.col(uid)] if uid else []),
        word_count(F.col("text")).alias("size"),
        (-F.ln(uniform(F.col("doc_id"))) / quality_weight(F.col("text"))).alias("key"),
    )
    rows = staged(picked.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * key_buckets), F.lit(key_buckets - 1)).cast("int")), "keys")
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs)
    bases = sums.withColumn("base", F.coalesce(F.sum("bucket_size").over(upto), F.lit(0))).join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "bucket_size")
    bases = staged(bases.withColumnsRenamed({"source": "s", "bucket": "b"}), "bases")
    joined = rows.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *([uid] if uid else [])).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    chosen = (F.col("size") > 0) & (F.col("start") + F.col("size") / 2 <= F.col("budget")) & (F.col("epochs") < max_epochs)
    counted = joined.withColumn("start", start).withColumn("epochs", epochs).withColumn("budget", budget)
    counted = counted.withColumn("copies", F.col("epochs") + chosen.cast("long"))
    names = ["doc_id", *([uid] if uid else []), "size", "source", "source_size", "target", "copies"]
    return counted.select(*names, (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows it does not take go."""
    uid = fresh_name(docs, "row_uid")
    whole = staged(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    taken = staged(mix(whole, uid, max_epochs).filter("copies > 0").select(uid, "copies"), "copies")
    # Nearly all rows have copies, so this side grows with the table: the same plan at every size.
    copies = fresh_name(docs, "copies")
    repeated = whole.join(taken.withColumnRenamed("copies", copies).hint("merge"), uid)
    times = F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(fresh_name(docs, "epoch_"))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns], times).select(*[F.col(f"`{c}`") for c in docs.columns])
