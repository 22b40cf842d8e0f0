"""Spelling variants: words one edit apart, by an index of variable-length grams.

**Words** are the runs of letters of all texts. A run that :func:`altered` picks
loses one letter. Each task counts what it reads before anything is shuffled.

**Gram dictionary.** A word is set between two marks, and a gram starts at every
place of it but the last. It has ``Q_MIN`` letters and grows while the corpus of
words holds it more than ``max_list`` times, up to ``Q_MAX`` letters or the end of
the word: the dictionary holds the children of frequent grams only, those of rare
ones are pruned. Which gram starts at a place depends on the letters of that gram
and on nothing after them. Gram counts are aggregates and lookups are joins, so
the dictionary may be larger than a task.

**Affected grams.** One inserted, deleted or replaced letter changes the grams
that lie over it, at most :func:`affected` of a word; all others are found again in
the other word, at the same place or one further. Sorted from rare to frequent, a
word's first ``affected + 1`` grams (and repeats of the last) therefore hold one
that the other word has among its own first ones: only those short lists are
merged. Lists are keyed by gram, word length and place.

**Frequent to the end.** A gram that is still frequent at ``Q_MAX`` letters has a
list without a bound; there the key also takes in one half of the word, in two
rows, as one edit leaves the first or the second half as it is. No list is cut.

**Verification** compares the words themselves.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import byte_rows, release, slices, staged

MIN_CHARS, MIN_COUNT, RATIO, DAMAGE = 6, 5, 5, 199
Q_MIN, Q_MAX, MAX_LIST = 2, 5, 100
_HELD = 400_000  # counts a task holds before it hands them on
_PIECE = 1 << 20  # characters looked at at once
_LETTER = "a-zÀ-ÿ"


def _pieces(text: str) -> Iterator[str]:
    """The text in parts of about ``_PIECE`` characters that cut no run of letters."""
    at, gap = 0, re.compile(f"[^{_LETTER}]")
    while at < len(text):
        cut = gap.search(text, at + _PIECE) if at + _PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def altered(doc: str, run: str) -> str:
    """The run, without one letter if ``DAMAGE`` divides the CRC-32 of ``doc:run``."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % DAMAGE == 0 else run


def words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of ``(doc_id, text)``: words long and frequent enough, with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(f"[{_LETTER}]{{{min_chars},}}")
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc").to_pylist(), byte_rows(batch.column("text"))):
                found: Counter = Counter()
                for piece in _pieces(text.lower().decode(errors="replace")):  # bytes: A-Z only
                    found.update(pattern.findall(piece))
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in found.items():
                    if zlib.crc32(word.encode(), start) % DAMAGE == 0:
                        word = altered(doc, word)
                        if len(word) < min_chars:
                            continue
                    held[word] += n
                if len(held) > _HELD:
                    yield out()
        yield out()

    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc")
    counted = docs.select(doc, F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _places(vocabulary: DataFrame, q_max: int) -> DataFrame:
    """``(wid, pos, ahead)``: at every place of a word between marks, the ``q_max`` letters from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wids, places, ahead = [], [], []
            for wid, word in zip(batch.column("wid").to_pylist(), batch.column("word").to_pylist()):
                marked = f"\x02{word}\x03"
                n = len(marked) - 1
                wids += [wid] * n
                places += range(n)
                ahead += [marked[p : p + q_max] for p in range(n)]
                if len(wids) > 50_000:
                    yield pa.record_batch([pa.array(wids, pa.int64()), pa.array(places, pa.int32()), pa.array(ahead, pa.string())], ["wid", "pos", "ahead"])
                    wids, places, ahead = [], [], []
            yield pa.record_batch([pa.array(wids, pa.int64()), pa.array(places, pa.int32()), pa.array(ahead, pa.string())], ["wid", "pos", "ahead"])

    return vocabulary.select("wid", "word").mapInArrow(run, "wid long, pos int, ahead string")


def dictionary(places: DataFrame, max_list: int = MAX_LIST, q_min: int = Q_MIN) -> DataFrame:
    """``(ahead, gram, freq)``: the gram that starts where ``ahead`` is to be read, and its occurrences."""
    seen = staged(places.groupBy("ahead").agg(F.count("*").alias("n")), "ahead")
    starts = seen.select("ahead", "n", F.explode(F.sequence(F.lit(q_min), F.length("ahead"))).alias("q"))
    starts = starts.withColumn("gram", F.substring("ahead", F.lit(1), F.col("q")))
    grams = staged(starts.groupBy("gram").agg(F.sum("n").alias("freq")), "grams")
    row = F.struct("q", "gram", "freq")
    met = starts.select("ahead", "q", "gram").join(grams, "gram").groupBy("ahead").agg(
        F.coalesce(F.min(F.when(F.col("freq") <= max_list, row)), F.max(row)).alias("g")
    )
    result = staged(met.select("ahead", "g.gram", "g.freq"), "dictionary")
    release(seen, grams)
    return result


def affected(length: int, starts: np.ndarray, ends: np.ndarray) -> int:
    """How many grams one edit of a word of that length can change, at most."""
    over = np.zeros(length + 3, np.int64)
    np.add.at(over, starts, 1)
    np.add.at(over, ends + 1, -1)
    return int(np.cumsum(over)[1 : length + 1].max())


def _probes(decomposed: DataFrame) -> DataFrame:
    """``(wid, word, n, chars, gram, pos, freq)``: the grams whose lists are merged for a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, grams, places, freqs = [], [], [], [], []
            for i, (word, found) in enumerate(zip(batch.column("word").to_pylist(), batch.column("grams").to_pylist())):
                starts = np.array([g["pos"] for g in found], np.int64)
                ends = starts + np.array([len(g["gram"]) for g in found], np.int64) - 1
                bound = affected(len(word), starts, ends)
                # already from rare to frequent, equal grams side by side
                last = (found[min(bound, len(found) - 1)]["freq"], found[min(bound, len(found) - 1)]["gram"])
                for g in found:
                    if (g["freq"], g["gram"].encode()) <= (last[0], last[1].encode()):
                        rows.append(i)
                        texts.append(len(word))
                        grams.append(g["gram"])
                        places.append(g["pos"])
                        freqs.append(g["freq"])
            at = pa.array(rows, pa.int64())
            columns = [batch.column(c).take(at) for c in ("wid", "word", "n")]
            more = [pa.array(texts, pa.int32()), pa.array(grams, pa.string()), pa.array(places, pa.int32()), pa.array(freqs, pa.int64())]
            yield pa.record_batch(columns + more, ["wid", "word", "n", "chars", "gram", "pos", "freq"])

    return decomposed.mapInArrow(run, "wid long, word string, n long, chars int, gram string, pos int, freq long")


def _keyed(probes: DataFrame, max_list: int) -> DataFrame:
    """Rows of ``(…, at)``, where ``at`` has the place and the shorter word's length, with the keys of their lists."""
    short = F.col("at.chars")
    half = F.floor(short / 2).cast("int")
    first = F.concat(F.lit("<"), F.substring("word", F.lit(1), half))
    second = F.concat(F.lit(">"), F.substring("word", F.col("chars") - (short - half) + 1, short - half))
    parts = F.when(F.col("freq") > max_list, F.array(first, second)).otherwise(F.array(F.lit("")))
    split = probes.select("wid", "word", "n", "gram", "at", F.explode(parts).alias("part"))
    return split.select(F.xxhash64("gram", "at.chars", "at.pos", "part").alias("key"), "wid", "word", "n", F.col("at.same").alias("same"))


def near_words(vocabulary: DataFrame, max_list: int = MAX_LIST, q_min: int = Q_MIN, q_max: int = Q_MAX) -> DataFrame:
    """``(a, n_a, b, n_b)``: every pair of words of ``(word, n)`` exactly one edit apart, once.

    ``vocabulary`` holds a word once. ``q_max`` must not exceed the length of its
    shortest word: longer grams could all be changed by one edit.
    """
    numbered = staged(vocabulary.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "vocabulary")
    places = staged(_places(numbered, q_max), "places")
    chosen = dictionary(places, max_list, q_min)
    grams = places.join(chosen, "ahead").groupBy("wid").agg(F.sort_array(F.collect_list(F.struct("freq", "gram", "pos"))).alias("grams"))
    probes = staged(_probes(numbered.join(grams, "wid").select("wid", "word", "n", "grams")), "probes")
    at = lambda chars, pos, same: F.struct(chars.alias("chars"), pos.alias("pos"), F.lit(same).alias("same"))
    chars, pos = F.col("chars"), F.col("pos")
    left = _keyed(probes.withColumn("at", at(chars, pos, True)), max_list).drop("same")
    around = F.explode(F.array(at(chars, pos, True), at(chars - 1, pos, False), at(chars - 1, pos - 1, False)))
    right = _keyed(probes.withColumn("at", around), max_list)
    a = left.select("key", F.col("wid").alias("x"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = right.select("key", F.col("wid").alias("y"), F.col("word").alias("b"), F.col("n").alias("n_b"), "same")
    one_edit = (~F.col("same") | (F.col("x") < F.col("y"))) & (F.levenshtein("a", "b", 1) == 1)
    result = staged(a.hint("merge").join(b, "key").filter(one_edit).select("a", "n_a", "b", "n_b").distinct(), "near")
    release(numbered, places, chosen, probes)
    return result


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``, following forms to the last.

    Every step leads to a word ``RATIO`` times as frequent, so there is no circle
    and a way of s steps ends after log2(s) rounds.
    """
    current = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(current.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        on = moved.filter("moved").limit(1).count()
        release(current)
        current = moved.select("word", "root")
        current._staged_path = moved._staged_path
        if not on:
            return current


def _best(n: Column, word: Column) -> Column:
    """Sorts words from the most frequent, then by code points."""
    return F.struct((-n).alias("less"), word.alias("word"))


def variants(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
    max_list: int = MAX_LIST, q_max: int = Q_MAX,
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of ``(doc_id, text)``, one row per word.

    A null or empty text, or one without such a run, has no words; a null id
    counts as an empty one. Rows that repeat an id or a text count each. An empty
    table gives no rows. Other columns are not looked at.
    """
    if not Q_MIN <= q_max <= min_chars:
        raise ValueError(f"q_max must lie between {Q_MIN} and min_chars")
    counted = staged(words(docs, min_chars, min_count), "words")
    near = near_words(counted, max_list, q_max=q_max)
    there = near.select(F.col("a").alias("word"), F.col("n_a").alias("n"), _best(F.col("n_b"), F.col("b")).alias("other"))
    back = near.select(F.col("b").alias("word"), F.col("n_b").alias("n"), _best(F.col("n_a"), F.col("a")).alias("other"))
    summed = there.unionByName(back).groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), F.min("other").alias("other"))
    found = -F.col("other.less") >= ratio * F.col("n")
    judged = staged(summed.select("word", "n_near", F.when(found, F.col("other.word")).alias("form"), F.when(found, -F.col("other.less")).alias("form_n")), "forms")
    roots = _roots(judged.filter("form IS NOT NULL"))
    result = counted.join(judged, "word", "left").join(roots, "word", "left")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
