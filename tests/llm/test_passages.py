"""Substring dedup against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from stratalake.llm.passages import deduplicated, drop_repeats, units


def slow(rows, unit, min_run):
    """Kept text per row, from lists and dicts only."""
    ordered = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    first, result = {}, {}
    for doc_id, text in ordered:
        found = list(units(text or "", unit))
        repeat = []
        for n, (_, _, words, digest) in enumerate(found):
            repeat.append(first.setdefault(digest, (doc_id, text, n)) != (doc_id, text, n))
        kept, at, n = [], 0, 0
        while n < len(found):
            if not repeat[n]:
                n += 1
                continue
            m = n
            while m < len(found) and repeat[m]:
                m += 1
            if sum(f[2] for f in found[n:m]) >= min_run:
                kept.append(text[at : found[n][0]])
                at = found[m - 1][1]
            n = m
        result[doc_id, text] = "".join(kept) + text[at:] if text is not None else None
    return sorted(((doc_id, result[doc_id, text]) for doc_id, text in rows), key=repr)


def sentence(rng, low=3, high=16):
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(low, high))]
    words[rng.randrange(len(words))] += rng.choice(["", ",", ""])
    return " ".join(words).capitalize() + rng.choice(".?!")


def corpus():
    rng = random.Random(8)
    passage = " ".join(sentence(rng) for _ in range(12))
    rows = []
    for i in range(60):
        lines = [" ".join(sentence(rng) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:  # into the middle of a line
            words = lines[0].split()
            lines[0] = " ".join(words[: len(words) // 2] + [passage] + words[len(words) // 2 :])
        rows.append((i, "\n".join(lines)))
    return passage, rows


def test_units_cover_words_once():
    text = "One two three. Les. Four, five six seven eight nine ten, eleven twelve thirteen fourteen fifteen.\n\nlast line no mark"
    found = list(units(text))
    assert [text[a:b] for a, b, _, _ in found] == ["One two three.", "Les. Four, five six seven eight nine ten,", " eleven twelve thirteen fourteen fifteen.", "last line no mark"]
    assert sum(f[2] for f in found) == len(text.split())
    paragraphs = "a b\nc\n\n d\ne"
    assert [paragraphs[a:b] for a, b, _, _ in units(paragraphs, "paragraph")] == ["a b\nc", "d\ne"]
    assert [f[2] for f in units("a b\n\n \nc", "line")] == [2, 1]


def test_passage_is_caught_wherever_it_stands(spark):
    passage, rows = corpus()
    got = {r.doc_id: r for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    core = " ".join(passage.split()[20:-10])
    assert [i for i, r in got.items() if core in r.text] == [0]
    for i, text in rows:
        r = got[i]
        assert (r.n_removed > 0) == (i % 3 == 0 and i > 0)
        if not r.n_removed:
            assert r.text == text and r.removed_chars == 0
        else:
            assert r.spans[0].first_doc_id == 0 and r.removed_chars == len(text) - len(r.text)
            assert text[r.spans[0].start : r.spans[0].end] in passage.join(["", ""]) or core in text[r.spans[0].start : r.spans[0].end]


@pytest.mark.parametrize("unit,min_run", [("sentence", 25), ("line", 1), ("paragraph", 8), ("sentence", 3)])
def test_against_loops(spark, unit, min_run):
    _, rows = corpus()
    rows = rows + [(100, rows[5][1]), (101, rows[5][1].upper()), (102, None), (103, ""), (104, " \n "), (None, rows[7][1]), (105, "same line here\n" * 3000), (6, rows[6][1]), (6, rows[6][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("unit", F.lit(1)).withColumn("run", F.lit(2))
    cut, name = drop_repeats(df, unit=unit, min_run_words=min_run)
    assert cut.drop(name).columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == slow(rows, unit, min_run)


def test_empty_table(spark):
    assert deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
