"""License scans against plain loops."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from stratalake.llm.licenses import BASE, NOTICES, allowed_edits, fuzzy_notices, scan, scan_text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_base(text):
    words = slow_words(text)
    places = []
    for phrase, label in BASE.items():
        wanted = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    at = [p for p, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None, "", "...", "MIT License", "the mit, license! MIT-License (Apache)license", "xmit license mit licenses", "GNU General  Public\nLicense, version 3",
    "Licensed under the Apache Licence, Version 2.0 (the", "MOZILLA Publik License", "All rights reserved é", "É mit license mit license", "all-rights-re served",
    "Redistribution and usage in source and binary form, with or without modifications", "license " * 5000, "mit license " * 3000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_columns(text):
    assert scan_text((text or "").encode())[:5] == slow_base(text)


def test_seeds_lose_nothing():
    rng = random.Random(4)
    for notice in NOTICES:
        k = allowed_edits(notice)
        for _ in range(12):
            chars = list(notice)
            for _ in range(rng.randint(0, k)):
                at = rng.randrange(len(chars))
                kind = rng.randrange(3)
                chars[at : at + 1] = [] if kind == 0 else [rng.choice("abcxyz")] if kind == 1 else [chars[at], rng.choice("abcxyz")]
            text = "some words before " + "".join(chars) + " and after"
            whole = regex.compile(rf"(?be)(?:{regex.escape(notice)}){{e<={k}}}").search(text)
            assert whole
            assert any(n == notice and a < whole.end() and whole.start() < b for _, n, a, b, _ in fuzzy_notices(text))


@pytest.mark.parametrize("first,second", [("mozilla publik license", "mozilla public license"), ("mozilla public license", "mozila public license"), ("mozilla publik license", "mozilla publiclicense")])
def test_notices_next_to_each_other(first, second):
    """A fuzzy notice is not hidden by a better one behind it."""
    found = [(a, b) for label, _, a, b, _ in fuzzy_notices(f"x {first} {second} y") if label == "mpl"]
    assert found == [(2, 2 + len(first)), (3 + len(first), 3 + len(first) + len(second))]


def test_spans_point_into_the_original():
    text = "Ünder MPL:  (Mozilla   Publik Licence) applies."
    *_, labels, score, spans = scan_text(text.encode())
    assert labels == "mpl" and 0.8 < score < 1 and spans[0]["edits"] == 2
    assert text[spans[0]["start"] : spans[0]["end"]].startswith("Mozilla") and "Licence" in text[spans[0]["start"] : spans[0]["end"]]
    words = slow_words(text)
    assert words[spans[0]["first_word"] : spans[0]["first_word"] + spans[0]["n_words"]][0] == "mozilla"


def test_scan(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "mit license"), (3, "mit license"), (3, "mit license")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit("clash")).withColumn("id", F.lit(0))
    got = scan(df).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((i, *slow_base(t)) for i, t in rows), key=repr)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
    by = {r.doc_id: r for r in got}
    assert by[7].labels == "apache" and by[7].n_base == 0 and by[8].labels == "mpl" and by[9].labels == "reserved" and by[12].labels == "bsd"


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
