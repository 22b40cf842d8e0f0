"""Substring dedup by hashing of units: the earliest ranked occurrence stays.

By default two kinds of units are hashed in one pass. Lines come first: a line of
``min_line_words`` words or more that stands earlier goes whole, whatever is around
it. Shorter lines (greetings, notices, headings) recur without being copies and
stay. What repeats inside lines or across their ends is found by units that do not
depend on the text around a passage: every window of words of half the bound is
hashed, and of as many neighbouring windows the one with the least hash is an
anchor; so any ``min_run_words`` words that recur share an anchor, wherever they
stand, and anchors of a longer run touch one another. At the ends of a run of
repeated anchors the text is compared word by word with that around the earliest
occurrence, and the bound holds for the extended run.

Other units are a line, a paragraph or a sentence of a line. Sentences of under
``min_unit_words`` are joined to the next one of their line; long ones are cut at
commas. Their boundaries depend on the context, so a passage can lose its ends.

Units are normalised (lower case, single blanks) and hashed. All units of the same
digest are ranked by document id and place; every one but the first is a repeat.
A single unit other than a long line recurs by chance, so a repeat alone removes
nothing: repeats that follow one another in a document form a run, and runs of at
least ``min_run_words`` words are removed. Start and end of each run are kept as
offsets (code points) in the original text.

Digests are combined before the shuffle, and repeats are found by a join of two
staged tables, where a digest that a third of all documents has is split over
tasks. What is brought together by document are its own repeats, and rows that repeat
id and text are combined before that.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stratalake.llm.common import fresh_name, release, slices, staged

_LINE = re.compile(r"[^\n]+")
_PARAGRAPH = re.compile(r"\S(?:[^\n]|\n(?![^\S\n]*\n))*")
_SENTENCE = re.compile(r"\S[^\n.!?]*(?:[.!?]+(?=[^\s.!?])[^\n.!?]*)*[.!?]*")
_PART = re.compile(r"[^,;:]+[,;:]*")

LONG_SENTENCE, PART_WORDS = 12, 6
SPANS = "array<struct<start:int,end:int,n_units:int,n_words:int,first_doc_id:{}>>"


def _sentences(text: str, min_words: int) -> Iterator[tuple[int, int, list[str]]]:
    for line in _LINE.finditer(text):
        begin, held = 0, []
        for match in _SENTENCE.finditer(text, line.start(), line.end()):
            words = match.group().split()
            if held:
                words = held + words
            else:
                begin = match.start()
            if len(words) < min_words:
                held = words
                continue
            held = []
            if len(words) <= LONG_SENTENCE:
                yield begin, match.end(), words
                continue
            at, part = begin, []
            for piece in _PART.finditer(text, begin, match.end()):
                part += piece.group().split()
                if len(part) >= PART_WORDS:
                    yield at, piece.end(), part
                    at, part = piece.end(), []
            if part:
                yield at, match.end(), part
        if held:
            yield begin, line.end(), held


def units(text: str, unit: str = "sentence", min_words: int = 3) -> Iterator[tuple[int, int, int, int]]:
    """``(start, end, words, digest)`` of the units of a text that have a word."""
    if unit == "sentence":
        found = _sentences(text, min_words)
    else:
        found = ((m.start(), m.end(), m.group().split()) for m in (_LINE if unit == "line" else _PARAGRAPH).finditer(text))
    for start, end, words in found:
        if words:
            digest = xxhash.xxh3_64_intdigest(" ".join(words).lower())
            yield start, end, len(words), digest - (1 << 64) if digest >> 63 else digest


def unit_rows(docs: DataFrame, unit: str = "sentence", min_unit_words: int = 3) -> DataFrame:
    """``(doc_id, doc_hash, unit, start, end, words, digest)``, one row per unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["unit", "start", "end", "words", "digest"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        for batch in slices(batches, "text", 2 << 20):
            rows, owner = [], []
            for n, text in enumerate(batch.column("text").to_pylist()):
                for place, found in enumerate(units(text or "", unit, min_unit_words)):
                    rows.append((place, *found))
                    owner.append(n)
            if rows:
                keys = batch.select(["doc_id", "doc_hash"]).take(pa.array(owner))
                yield pa.record_batch([*keys.columns, *(pa.array(list(c), k) for c, k in zip(zip(*rows), kinds))], [*keys.schema.names, *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    picked = docs.select("doc_id", F.xxhash64(text).alias("doc_hash"), text.alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, doc_hash long, unit int, start int, end int, words int, digest long")


def repeated_spans(docs: DataFrame, unit: str = "sentence", min_unit_words: int = 3, min_run_words: int = 25) -> DataFrame:
    """``(doc_id, doc_hash, spans)`` of the documents that lose a run."""
    rows = staged(unit_rows(docs, unit, min_unit_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_hash", "unit")
    first = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
    first = staged(first.filter("first < last").select("digest", "first"), "first")
    repeats = rows.join(first, "digest").filter(rank != F.col("first")).select("doc_id", "doc_hash", "unit", "start", "end", "words", F.col("first.doc_id").alias("first_doc_id"))
    by_doc = Window.partitionBy("doc_id", "doc_hash").orderBy("unit")
    runs = repeats.withColumn("run", F.col("unit") - F.dense_rank().over(by_doc))
    runs = runs.groupBy("doc_id", "doc_hash", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.countDistinct("unit").cast("int").alias("n_units"),
        F.sum("words").alias("words"), F.count("*").alias("n"), F.min("first_doc_id").alias("first_doc_id"),
    )
    runs = runs.withColumn("n_words", (F.col("words") * F.col("n_units") / F.col("n")).cast("int")).filter(F.col("n_words") >= min_run_words)
    spans = F.sort_array(F.collect_list(F.struct("start", "end", "n_units", "n_words", "first_doc_id"))).alias("spans")
    result = staged(runs.groupBy("doc_id", "doc_hash").agg(spans), "spans")
    release(rows, first)
    return result


def _sizes(min_run_words: int) -> tuple[int, int]:
    """Words of a window, and windows of which one is an anchor: together they span the bound."""
    return (min_run_words + 1) // 2, min_run_words + 1 - (min_run_words + 1) // 2


class _WordHashes(dict):
    """Hashes of words, each computed once."""

    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_FACTOR = 0x9E3779B97F4A7C15


def _window_sums(each: np.ndarray, size: int) -> np.ndarray:
    """Polynomials of ``size`` neighbours, modulo 2^64, from those of 1, 2, 4 … neighbours."""
    power, width, done, total = each, 1, 0, np.zeros(len(each) - size + 1, np.uint64)
    while True:
        if size & width:  # the next ``width`` neighbours, after those done
            total = total * np.uint64(pow(_FACTOR, width, 1 << 64)) + power[done : done + len(total)]
            done += width
        if done == size:
            return total
        power = power[:-width] * np.uint64(pow(_FACTOR, width, 1 << 64)) + power[width:]
        width *= 2


def _least_places(values: np.ndarray, among: int) -> np.ndarray:
    """Where the least of ``among`` neighbours stands, the first of equal ones, for every start."""
    at, width = np.arange(len(values)), 1
    while width < among:
        step = min(width, among - width)  # windows may overlap
        right = values[step:] < values[: len(values) - step]
        at = np.where(right, at[step:], at[: len(at) - step])
        values = np.where(right, values[step:], values[: len(values) - step])
        width += step
    return at


def anchors(words: list[str], min_run_words: int = 25, known: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and digests of the anchors among lower-case words; ``known`` has hashes of words."""
    size, among = _sizes(min_run_words)
    if len(words) < min_run_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = _WordHashes() if known is None else known
    digests = _window_sums(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), size)
    digests = (digests ^ digests >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    digests ^= digests >> np.uint64(32)
    best = _least_places(digests, among)
    places = best[np.concatenate([[True], best[1:] != best[:-1]])]  # they never go back
    return places, digests[places].view(np.int64)


def line_units(text: str, min_line_words: int) -> tuple[list[str], list[tuple[int, int, int]]]:
    """The words of a text in lower case, and ``(place, words, digest)`` of its lines of ``min_line_words`` or more."""
    words, found = [], []
    for line in text.lower().split("\n"):
        held = line.split()
        if len(held) >= min_line_words:
            found.append((len(words), len(held), xxhash.xxh3_64_intdigest(" ".join(held), seed=1)))
        words += held
    return words, found


def anchor_rows(docs: DataFrame, min_run_words: int, min_line_words: int) -> DataFrame:
    """``(doc_id, doc_hash, unit, place, words, digest)``, one row per line and anchor.

    ``place`` counts words. ``words`` is null for anchors; their units count up from 0,
    those of lines down from -4, so that no line is the neighbour of a unit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in slices(batches, "text", 2 << 20):
            if len(known) > 1 << 18:
                known.clear()
            found, lines = [], []
            for n, text in enumerate(batch.column("text").to_pylist()):
                words, whole = line_units(text or "", min_line_words)
                found.append(anchors(words, min_run_words, known))
                lines += [(n, -4 * (k + 1), *line) for k, line in enumerate(whole)]
            counts = [len(p) for p, _ in found]
            owner, line_unit, line_place, line_words, line_digest = zip(*lines) if lines else [()] * 5
            keys = batch.select(["doc_id", "doc_hash"]).take(pa.array(np.concatenate([np.repeat(np.arange(len(found)), counts), np.array(owner, np.int64)])))
            unit = np.concatenate([*(np.arange(n) for n in counts), np.array(line_unit, np.int64)])
            place = np.concatenate([*(p for p, _ in found), np.array(line_place, np.int64)])
            digest = np.concatenate([*(d for _, d in found), np.array(line_digest, np.uint64).view(np.int64)])
            size = pa.concat_arrays([pa.nulls(sum(counts), pa.int32()), pa.array(line_words, pa.int32())])
            columns = [pa.array(unit, pa.int32()), pa.array(place, pa.int32()), size, pa.array(digest, pa.int64())]
            yield pa.record_batch([*keys.columns, *columns], ["doc_id", "doc_hash", "unit", "place", "words", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    picked = docs.select("doc_id", F.xxhash64(text).alias("doc_hash"), text.alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, doc_hash long, unit int, place int, words int, digest long")


def _contexts(docs: DataFrame, wanted: DataFrame, min_run_words: int) -> DataFrame:
    """``(digest, before, after)``: up to ``min_run_words`` words on both sides of the earliest occurrences."""
    size, _ = _sizes(min_run_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            rows = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                words = text.lower().split()
                for x in places:
                    end = x["place"] + size
                    rows.append((x["digest"], words[max(0, x["place"] - min_run_words) : x["place"]], words[end : end + min_run_words]))
            if rows:
                digest, before, after = zip(*rows)
                words = pa.list_(pa.string())
                yield pa.record_batch([pa.array(digest, pa.int64()), pa.array(before, words), pa.array(after, words)], ["digest", "before", "after"])

    by_doc = wanted.groupBy(F.col("first.doc_id").alias("k1"), F.col("first.doc_hash").alias("k2")).agg(F.collect_set(F.struct(F.col("first.place").alias("place"), "digest")).alias("places"))
    text = F.col("text").cast("string")
    picked = docs.select(F.col("doc_id"), F.xxhash64(text).alias("doc_hash"), text.alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("k1")) & (F.col("doc_hash") == F.col("k2"))
    held = picked.join(by_doc.hint("merge"), same).select("text", "places")
    return held.mapInArrow(run, "digest long, before array<string>, after array<string>").dropDuplicates(["digest"])


def repeated_anchors(docs: DataFrame, min_run_words: int = 25, min_line_words: int = 20) -> DataFrame:
    """``(doc_id, doc_hash, found)``: places of the repeated lines and anchors, with the words around the earliest occurrence at the ends of runs of anchors."""
    rows = staged(anchor_rows(docs, min_run_words, min_line_words), "anchors")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_hash", "place")
    first = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
    first = staged(first.filter("first < last").select("digest", "first"), "first")
    repeats = rows.join(first, "digest").filter(rank != F.col("first")).distinct()  # rows may repeat id and text
    by_doc = Window.partitionBy("doc_id", "doc_hash").orderBy("unit")
    # Two anchors at each end: the earliest occurrence of the last one may be a shorter passage elsewhere.
    ends = [F.count("*").over(by_doc.rangeBetween(n, n)) == 0 for n in (-2, -1, 1, 2)]
    repeats = staged(repeats.withColumn("end", F.col("words").isNull() & (ends[0] | ends[1] | ends[2] | ends[3])), "repeats")
    release(rows, first)
    wanted = repeats.filter("end").select("digest", "first").distinct()
    around = staged(_contexts(docs, wanted, min_run_words), "contexts")
    kept = repeats.select("doc_id", "doc_hash", "place", "words", F.col("first.doc_id").alias("first_doc_id"), F.when(F.col("end"), F.col("digest")).alias("digest"))
    inner = kept.filter("digest IS NULL").withColumn("before", F.lit(None).cast("array<string>")).withColumn("after", F.lit(None).cast("array<string>"))
    outer = kept.join(around, "digest")
    each = outer.unionByName(inner).groupBy("doc_id", "doc_hash").agg(F.sort_array(F.collect_set(F.struct("place", "words", "first_doc_id", "before", "after"))).alias("found"))
    result = staged(each, "found")
    release(repeats, around)
    return result


def _merged(pieces: list[tuple[int, int, list]]) -> list[tuple[int, int, list]]:
    """Pieces that touch or overlap become one."""
    runs: list[tuple[int, int, list]] = []
    for low, high, sources in sorted(pieces, key=lambda p: p[:2]):
        if runs and low <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], high), runs[-1][2] + sources
        else:
            runs.append((low, high, sources))
    return runs


def _word_starts(text: str, places: list[int]) -> dict[int, int]:
    """Where the words of these places (rising) start in a text."""
    starts, rest, done = {}, text, 0
    for place in places:
        rest = rest.split(None, place - done)[-1] if place > done else rest.lstrip()
        done, starts[place] = place, len(text) - len(rest)
    return starts


def extended(text: str, found: Iterable[tuple], min_run_words: int) -> list[dict]:
    """What goes of a text: its repeated lines, and the long runs of its repeated anchors.

    ``found`` has ``(place, words, first_doc_id, before, after)``.
    """
    size, _ = _sizes(min_run_words)
    words = text.lower().split()
    lines, pieces = [], []
    for place, line_words, source, before, after in found:
        if line_words is not None:
            lines.append((place, place + line_words, [source]))
            continue
        low, high = place, place + size
        for word in reversed(before or ()):
            if not low or words[low - 1] != word:
                break
            low -= 1
        for word in after or ():
            if high == len(words) or words[high] != word:
                break
            high += 1
        pieces.append((low, high, [source]))
    runs = _merged(lines + [run for run in _merged(pieces) if run[1] - run[0] >= min_run_words])
    if not runs:
        return []
    own = text.split()
    starts = _word_starts(text, sorted({place for low, high, _ in runs for place in (low, high - 1)}))
    return [
        {"start": starts[low], "end": starts[high - 1] + len(own[high - 1]), "n_units": len(sources), "n_words": high - low, "first_doc_id": min((s for s in sources if s is not None), default=None)}
        for low, high, sources in runs
    ]


def _sparse(column: pa.Array) -> list:
    """The values of a column that is mostly null."""
    values = [None] * len(column)
    for place, value in zip(np.flatnonzero(column.is_valid()).tolist(), column.drop_null().to_pylist()):
        values[place] = value
    return values


def _runs_of(texts: list[str], found: pa.ListArray, min_run_words: int) -> list[list[dict]]:
    """The runs of texts from the lists of their repeated units."""
    ends = np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False)).tolist()
    place, words, source, before, after = found.flatten().flatten()
    rows = list(zip(place.to_pylist(), _sparse(words), source.to_pylist(), _sparse(before), _sparse(after)))
    return [extended(text, rows[low:high], min_run_words) for text, low, high in zip(texts, [0, *ends], ends)]


def _cut(text: str, spans: list[dict]) -> str:
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : span["start"]])
        at = span["end"]
    return "".join(kept) + text[at:]


def drop_repeats(docs: DataFrame, unit: str = "window", min_unit_words: int = 3, min_run_words: int = 25, min_line_words: int = 20) -> tuple[DataFrame, str]:
    """``docs`` with its repeats cut out of ``text``, and the name of the added column of spans.

    ``unit`` is window (lines of ``min_line_words`` and what repeats inside them),
    sentence, line or paragraph. All other columns stay as they are;
    a text that loses nothing is unchanged and has null spans. Null and empty
    texts have no units. Rows that repeat both id and text are one document to
    the ranking and fare alike; of rows with the same id and other texts, or with
    null ids (ranked last), the order of text hashes decides. A document whose
    text is all repeats keeps what lies between runs, at least an empty text. An
    empty table gives no rows.
    """
    name = fresh_name(docs, "spans")
    if unit == "window":
        spans = repeated_anchors(docs, min_run_words, min_line_words).withColumnRenamed("found", "spans")
    else:
        spans = repeated_spans(docs, unit, min_unit_words, min_run_words)
    by_id, by_hash = fresh_name(docs, "span_doc_id"), fresh_name(docs, "span_doc_hash")
    side = spans.select(F.col("doc_id").alias(by_id), F.col("doc_hash").alias(by_hash), F.col("spans").alias(name))
    same = docs["doc_id"].eqNullSafe(F.col(by_id)) & (F.xxhash64(docs["text"].cast("string")) == F.col(by_hash))
    joined = docs.join(side.hint("merge"), same, "left").drop(by_id, by_hash)  # the same plan at every size
    place, last = joined.columns.index("text"), joined.columns.index(name)
    kind = docs.schema["doc_id"].dataType
    parts = [("start", T.IntegerType()), ("end", T.IntegerType()), ("n_units", T.IntegerType()), ("n_words", T.IntegerType()), ("first_doc_id", kind)]
    spans_type = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in parts]))
    arrow = to_arrow_type(spans_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            some = batch.column(name).is_valid()
            column, spans = batch.column("text"), pa.nulls(batch.num_rows, arrow)
            texts, found = column.filter(some).to_pylist(), batch.column(name).filter(some)
            if texts:
                runs = _runs_of(texts, found, min_run_words) if unit == "window" else found.to_pylist()
                at = [n for n, r in zip(np.flatnonzero(some).tolist(), runs) if r]
                held = [(t, r) for t, r in zip(texts, runs) if r]
                mask = np.zeros(batch.num_rows, bool)
                mask[at] = True
                column = pc.replace_with_mask(column, pa.array(mask), pa.array([_cut(t, r) for t, r in held], column.type))
                # Each row takes its list, all others a null after the last list.
                order = np.full(batch.num_rows, len(held))
                order[at] = np.arange(len(held))
                spans = pa.array([*(r for _, r in held), None], arrow).take(pa.array(order))
            batch = batch.set_column(place, batch.schema.field(place), column)
            yield batch.set_column(last, pa.field(name, arrow), spans)

    schema = T.StructType([T.StructField(f.name, spans_type if f.name == name else f.dataType, True) for f in joined.schema.fields])
    return joined.mapInArrow(run, schema), name


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, n_removed, removed_chars, spans, text``."""
    cut, name = drop_repeats(docs.select("doc_id", "text"), **options)
    size = F.aggregate(F.coalesce(F.col(name), F.array().cast(SPANS.format(docs.schema["doc_id"].dataType.simpleString()))), F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", F.when(F.col(name).isNull(), 0).otherwise(F.size(name)).cast("long").alias("n_removed"), size.cast("long").alias("removed_chars"), F.col(name).alias("spans"), "text")
