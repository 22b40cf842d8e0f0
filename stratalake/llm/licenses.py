"""License scans: fuzzy search for short notices by exact seeds and bounded verification.

A notice that may differ by k edits is cut into k + 1 pieces. Whatever is within
k edits of it holds one of them unchanged (pigeonhole), so an Aho-Corasick pass
for all pieces finds every candidate place. Only the text around a seed goes
through fuzzy matching of the ``regex`` library with at most k errors, which
verifies the edits and gives the span. Documents without a seed cost one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import byte_rows, slices

# Words that name a license wherever they stand next to each other.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Words of well-known short notices, in lower case without marks.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "licensed under a creative commons attribution": "cc-by",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "spdx license identifier": "spdx",
    "all rights reserved": "reserved",
}

# One in this many characters of a notice may be wrong, three at most.
CHARS_PER_EDIT, MOST_EDITS = 10, 3

_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def allowed_edits(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // CHARS_PER_EDIT)


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of about the same length, with their places in the notice."""
    cuts = [len(notice) * n // (edits + 1) for n in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def _machine():
    pieces: dict[str, list[tuple[int, int]]] = {}
    patterns, reach = [], []
    for n, notice in enumerate(NOTICES):
        edits = allowed_edits(notice)
        wanted = rf"(?:{regex.escape(notice)}){{e<={edits}}}"
        patterns.append((regex.compile(f"(?e){wanted}"), regex.compile(f"(?be){wanted}")))
        reach.append((len(notice), edits))
        for at, piece in seeds(notice, edits):
            pieces.setdefault(piece, []).append((n, at))
    machine = ahocorasick.Automaton()
    for piece, users in pieces.items():
        machine.add_word(piece, (len(piece), users))
    machine.make_automaton()
    return machine, patterns, reach, list(NOTICES.items())


def _places(near, best, text: str, low: int, high: int, length: int, edits: int) -> Iterator:
    """Matches in a part of the text one after the other, each the best one where it was found.

    The best match of a whole area would hide a worse one before it.
    """
    while match := near.search(text, low, high):
        match = best.search(text, match.start(), min(high, match.start() + length + 2 * edits)) or match
        yield match
        low = max(match.end(), low + 1)


def fuzzy_notices(text: str) -> list[tuple[str, str, int, int, int]]:
    """``(label, notice, start, end, edits)`` in a text of words joined by blanks.

    Places of one notice do not overlap; those of different ones may.
    """
    machine, patterns, reach, notices = _machine()
    areas: dict[int, list[list[int]]] = {}
    for end, (size, users) in machine.iter(text):
        for n, at in users:
            length, edits = reach[n]
            begin = end + 1 - size - at
            low, high = max(0, begin - edits), min(len(text), begin + length + edits)
            held = areas.setdefault(n, [])
            if held and low <= held[-1][1]:
                held[-1] = [min(low, held[-1][0]), max(high, held[-1][1])]
            else:
                held.append([low, high])
    found = []
    for n, places in areas.items():
        for low, high in places:
            for match in _places(*patterns[n], text, low, high, *reach[n]):
                found.append((notices[n][1], notices[n][0], match.start(), match.end(), sum(match.fuzzy_counts)))
    return sorted(found, key=lambda x: (x[2], x[3], x[1]))


def scan_text(text: bytes) -> tuple:
    """Counts, labels, score and spans of a UTF-8 text."""
    words = text.translate(_TABLE).split()
    joined = b" ".join(words)
    padded, places, base = b" " + joined + b" ", [], set()
    for phrase, label in BASE.items():
        wanted = b" " + phrase.encode() + b" "
        at = padded.find(wanted)
        while at >= 0:
            places.append(at)
            base.add(label)
            at = padded.find(wanted, at + 1)
    first = padded.count(b" ", 1, min(places) + 1) if places else None
    final = padded.count(b" ", 1, max(places) + 1) if places else None
    plain = joined.decode("utf-8", "replace")
    found = fuzzy_notices(plain)
    spans, score = [], 1.0 if places else 0.0
    if found:
        offsets = [m.span() for m in _WORD.finditer(text.decode("utf-8", "replace"))]
        for label, notice, start, end, edits in found:
            one = plain.count(" ", 0, start)
            one += plain[start : start + 1] == " "
            last = plain.count(" ", 0, max(start, end - 1))
            spans.append({
                "label": label, "notice": notice, "edits": edits, "first_word": one, "n_words": last - one + 1,
                "start": offsets[one][0], "end": offsets[min(last, len(offsets) - 1)][1],
            })
            score = max(score, 1.0 - edits / len(notice))
    labels = base | {s["label"] for s in spans}
    return len(words), len(places), first, final, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


SPAN = pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
FOUND = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,notice:string,edits:int,first_word:long,n_words:long,start:long,end:long>>"
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License notices per row of ``docs``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are about the
    exact phrases, ``labels`` about those and the fuzzy notices; labels are
    distinct, sorted and joined by commas, empty if there are none. ``score`` is 1
    for an exact phrase, else the best share of a notice that is unchanged, else 0.
    Spans have word numbers and code point offsets in the original text. A null
    or empty text has no words and score 0; every row is scanned for itself, so
    repeated rows and null ids are kept; an empty table gives no rows.
    """
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(SPAN)]
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [scan_text(text) for text in byte_rows(batch.column("text"))]
            yield pa.record_batch([batch.column("id"), *(pa.array(list(c), k) for c, k in zip(zip(*rows), kinds))], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"`{id_col}` {kind}, {FOUND}")
