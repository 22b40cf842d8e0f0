"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

Every window serves the source queues in turn. A source is owed its share of the
window; what whole tokens cannot serve is carried as its deficit to the next
window. The tokens served are split down a balanced tree over the sources: of x
tokens at a node its left half gets ``floor(x * share)`` and its right half the
rest. Both only grow with x, so after any number of packed tokens it is known
what every source got: windows are full, a carried deficit stays below one token
for each level of the tree, and no window needs the one before it. So deficits
carry over partitions too, and tasks cut their documents independently.

By default a source's share is its share of all tokens, so that all queues run
dry together; given ``weights``, the schedule has one phase after another, each
ending where a queue runs dry and the rest share its part by weight.

The place of a document in its source's queue is a sum over tasks: tokenising
tasks report tokens per source, those few sums are cumulated, and a document
adds its place within its task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import gather, slices, staged

WINDOW = 2048
END_ID = 1
_SEPARATOR = "<|endoftext|>"
_CACHE_WORDS = 1_200_000
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
# Letters beyond ASCII as the two bytes of their UTF-8, in the byte alphabet of byte-level
# models: bytes that print stand for themselves, the others follow from 256 on.
_PRINTING = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTING]
_ALPHABET = {**{b: chr(b) for b in _PRINTING}, **{b: chr(256 + n) for n, b in enumerate(_OTHERS)}}
_BYTES = {c: "".join(_ALPHABET[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordEncoder:
    """Token ids of texts by a ``tokenizers`` file whose pre-tokens hold no white space.

    Ids of white-space separated pieces do not depend on their neighbours, so
    each distinct piece is encoded once and texts are put together from them. The
    ids of known pieces lie in one array. The cache is bounded; it is emptied
    when full, which only costs time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}  # number of a piece
        self.ids, self.ends = array("I"), array("I")  # its ids end there and begin where the one before ends

    def _add(self, piece: str, ids: Iterable[int]) -> int:
        number = self.place[piece] = len(self.ends)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return number

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces.

        A run of Latin letters is one pre-token, and so is a run of marks after
        it: both go to the model as they are, in its byte alphabet, and words
        share the entry of their lower case. All else goes through the whole
        tokenizer, a separator between the pieces.
        """
        place, tokenize, other = self.place, self.tokenizer.model.tokenize, []
        for piece in pieces:
            plain = _PLAIN.fullmatch(piece)
            if plain is None:
                other.append(piece)
                continue
            word, mark = plain.groups()
            lower = word.lower()
            number = place.get(lower)
            if number is None:
                number = self._add(lower, [t.id for t in tokenize(lower if lower.isascii() else lower.translate(_BYTES))])
            if mark:
                if mark not in place:
                    self._add(mark, [t.id for t in tokenize(mark)])
                self._add(piece, [*self._ids(number), *self._ids(place[mark])])
            else:
                place[piece] = number
        joined = [p for p in other if "<|" not in p]
        for at in range(0, len(joined), 512):
            part = joined[at : at + 512]
            ids = np.array(self.tokenizer.encode(_SEPARATOR.join(part), add_special_tokens=False).ids, np.uint32)
            cut = np.split(ids, np.flatnonzero(ids == self.separator))
            for n, (piece, run) in enumerate(zip(part, cut, strict=True)):
                self._add(piece, (run[1:] if n else run).tolist())
        for piece in other:
            if "<|" in piece:
                self._add(piece, self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _ids(self, number: int) -> array:
        return self.ids[self.ends[number - 1] if number else 0 : self.ends[number]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column, one after the other, and the number of ids of each row."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = pc.dictionary_encode(pc.list_flatten(split))
        pieces = coded.dictionary.to_pylist()
        if len(self.place) > _CACHE_WORDS:
            self.clear()
        self._learn([p for p in pieces if p not in self.place])
        numbers = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        ends = np.frombuffer(self.ends, np.uint32).astype(np.int64) if self.ends else np.zeros(0, np.int64)
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        index = coded.indices.to_numpy(zero_copy_only=False)
        starts, lengths = begins[numbers][index], (ends - begins)[numbers][index]
        flat = gather(np.array(self.ids, np.uint32), starts, lengths)
        words = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        upto = np.concatenate(([0], np.cumsum(lengths)))
        edges = np.concatenate(([0], np.cumsum(words)))
        return flat, np.diff(upto[edges])


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, source, task, place, doc_tokens, ids)``.

    ``place`` counts the tokens of the same source before the row in its task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, served = _encoder(tokenizer_path), TaskContext.get().partitionId(), {}
        for batch in slices(batches, "text", 8 << 20):
            flat, counts = encoder.encode(batch.column("text"))
            ends = np.cumsum(counts)
            places, ids = [], []
            for source, begin, end in zip(batch.column("source").to_pylist(), (ends - counts).tolist(), ends.tolist()):
                places.append(served.get(source, 0))
                served[source] = places[-1] + end - begin + 1
                ids.append(np.append(flat[begin:end], np.uint32(end_id)).astype("<u4").tobytes())
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("source"), pa.array([task] * len(ids), pa.int32()), pa.array(places, pa.int64()), pa.array(counts + 1, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "source", "task", "place", "doc_tokens", "ids"],
            )

    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, task int, place long, doc_tokens long, ids binary"
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")).mapInArrow(run, kinds)


def phases(totals: list[int], weights: list[float] | None = None) -> list[tuple[int, list[int], list[int]]]:
    """The schedule: ``(first token, tokens served before per source, shares)`` per phase.

    Shares are integers. Without weights there is one phase with the totals as
    shares. With weights a phase ends where the first queue runs dry; in the next
    one the others share by weight. The last phase serves what rounding left over.
    """
    if weights is None:
        return [(0, [0] * len(totals), list(totals))]
    units = [round(w * 1_000_000) for w in weights]
    served, at, plan = [0] * len(totals), 0, []
    while any(s < t for s, t in zip(served, totals)):
        shares = [u if s < t else 0 for u, s, t in zip(units, served, totals)]
        if not any(shares):
            shares = [t - s for s, t in zip(served, totals)]
        whole = sum(shares)
        fits = [((t - s) * whole) // w for s, t, w in zip(served, totals, shares) if w]
        length = max(1, min(fits))
        plan.append((at, list(served), shares))
        got = [min(split(shares, n, length)[1], t - s) for n, (s, t) in enumerate(zip(served, totals))]
        if not any(got):  # less than a token each: serve the rest by what is there
            plan[-1] = (at, list(served), [t - s for s, t in zip(served, totals)])
            break
        if sum(got) != length:
            length = sum(got)
            plan[-1] = (at, list(served), got)
        served = [s + g for s, g in zip(served, got)]
        at += length
    return plan


def split(shares: list[int], s: int, x: int, upto: list[int] | None = None) -> tuple[int, int]:
    """Of x tokens, those that sources before s get, and those that source s gets."""
    upto = upto or [0, *accumulate(shares)]
    low, high, before = 0, len(shares), 0
    while high - low > 1:
        middle = (low + high) // 2
        whole = upto[high] - upto[low]
        left = x * (upto[middle] - upto[low]) // whole if whole else 0
        if s < middle:
            high, x = middle, left
        else:
            low, before, x = middle, before + left, x - left
    return before, x


class Schedule:
    """Tokens served per source after x packed tokens, and back."""

    def __init__(self, totals: list[int], weights: list[float] | None, window: int):
        self.totals, self.window, self.tokens = totals, window, sum(totals)
        self.plan = phases(totals, weights)
        self.starts = [p[0] for p in self.plan]
        self.before = [[0, *accumulate(p[1])] for p in self.plan]
        self.upto = [[0, *accumulate(p[2])] for p in self.plan]

    def _pair(self, s: int, x: int) -> tuple[int, int]:
        """Tokens of the sources before s, and of source s, after x tokens."""
        n = bisect_right(self.starts, x) - 1
        at, served, shares = self.plan[n]
        under, own = split(shares, s, x - at, self.upto[n])
        return self.before[n][s] + under, served[s] + own

    def windows(self, s: int, begin: int, length: int) -> Iterator[tuple[int, int, int]]:
        """``(window, offset, length)`` of the tokens ``begin … begin + length`` of source s."""
        low, high = 0, -(-self.tokens // self.window)  # the last window that begins at or before them
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._pair(s, middle * self.window)[1] <= begin else (low, middle)
        under, own = self._pair(s, low * self.window)
        while length:
            next_under, next_own = self._pair(s, min((low + 1) * self.window, self.tokens))
            take = min(length, next_own - begin)
            if take > 0:
                yield low, next_under - under + begin - own, take
                begin, length = begin + take, length - take
            low, under, own = low + 1, next_under, next_own


PIECES = "doc_id {}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, ids binary"


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, weights: dict[str | None, float] | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of documents in windows of ``window`` tokens, every token in exactly one.

    One row per piece: ``doc_id, source, start`` (the document's tokens before
    it), ``length, ids_crc32, doc_tokens, sequence_id, offset`` (its place in the
    sequence) and, with ``with_ids``, the ids as little-endian 32-bit integers.
    All sequences but the last are full. Within a sequence sources follow each
    other in order of their names, null last. A null or empty text is its end
    token alone. Repeated rows are packed as often as they occur; a null id or
    source is kept. Columns other than doc_id, source and text are ignored. An
    empty table gives no pieces. ``weights`` has one entry per source, as the
    totals the driver holds have; a source without one gets what the others leave.
    """
    tokens = staged(tokenize(docs, tokenizer_path, end_id), "tokens")
    per_task = staged(tokens.groupBy("task", "source").agg(F.sum("doc_tokens").alias("n")), "per_task")
    before = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(per_task.select(F.col("task").alias("t"), F.col("source").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    found = per_task.groupBy("source").agg(F.sum("n").alias("n")).collect()  # one row per source of the mixture
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    rank = {r.source: n for n, r in enumerate(found)}
    shares = None if weights is None else [float(weights.get(r.source, 0.0)) for r in found]
    schedule = Schedule([r.n for r in found], shares, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        for batch in slices(batches, "ids", 4 << 20):
            kinds = [batch.schema.field("doc_id").type, pa.string(), *[pa.int64()] * 6, pa.binary()]
            rows = []
            for doc_id, source, begin, size, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "begin", "doc_tokens", "ids"))):
                start = 0
                for sequence, offset, length in schedule.windows(rank[source], begin, size):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, source, start, length, zlib.crc32(piece), size, sequence, offset, piece if with_ids else None))
                    start += length
                    if len(rows) >= 20_000:
                        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
            if rows:
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    placed = tokens.join(bases, (F.col("task") == F.col("t")) & F.col("source").eqNullSafe(F.col("s")))
    placed = placed.select("doc_id", "source", (F.col("base") + F.col("place")).alias("begin"), "doc_tokens", "ids")
    pieces = placed.mapInArrow(run, PIECES.format(docs.schema["doc_id"].dataType.simpleString()))
    return pieces if with_ids else pieces.drop("ids")
