"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_chars=6, min_count=5, ratio=5):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("word", "n", "doc", "wid", "gram")})
    return sorted(map(tuple, spelling.variants(df, **options).collect()), key=repr)


def typo(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


def texts(seed, letters, n_words=60, n_docs=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(n_words)]
    rows = []
    for i in range(n_docs):
        drawn = [rng.choice(base) for _ in range(120)] + [typo(rng, base[rng.randrange(8)], letters) for _ in range(60)]
        drawn = [w.upper() if rng.random() < 0.1 else w for w in drawn]
        rows.append((i, rng.choice([" ", ", ", "-\n", "1"]).join(drawn)))
    return rows


@pytest.mark.parametrize("letters,max_list,q_max", [("abé", 100, 5), ("abé", 1, 6), ("abé", 10_000, 2), ("abcdefgÀÿ", 3, 4)])
def test_against_all_pairs(spark, letters, max_list, q_max):
    rows = texts(len(letters), letters)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 5
    assert run(spark, rows, max_list=max_list, q_max=q_max) == want


def test_forms_are_followed(spark):
    rows = [(1, "wordone " * 6 + "wordonee " * 40 + "wordoneex " * 300 + "wordxne " * 6)]
    got = {r[0]: r[1:3] for r in run(spark, rows)}
    assert got == {r[0]: r[1:3] for r in brute(rows)}
    assert got["wordone"] == ("wordonee", "wordoneex")


def test_odd_rows(spark):
    long = "abcdefgh" * 5000
    rows = [(1, None), (2, ""), (None, "letters letters letters letters letters lettrrs"), (3, "short"), (3, f"{long} {long}x " * 5), (3, f"{long} {long}x " * 5)]
    rows += [(4, "ÀÉÎÕÜß " * 6 + "ÀÉÎÕÜàß " * 6 + "×÷×÷×÷ " * 6 + "naïveté" * 3), (5, "Ābcdefg " * 9)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_pieces_keep_runs(monkeypatch):
    monkeypatch.setattr(spelling, "_PIECE", 5)
    text = "abcdefghijklm no pq " * 3
    assert "".join(spelling._pieces(text)) == text
    assert all(p[-1] == "m" or not p[-1].isalpha() or p.endswith("q") or p.endswith("o") for p in spelling._pieces(text))


def test_one_edit_changes_no_more_grams_than_affected():
    rng, frequent = random.Random(4), {"ab", "ba", "aba", "bab", "\x02a", "aa", "abab"}

    def grams(word):
        marked = f"\x02{word}\x03"
        out = []
        for p in range(len(marked) - 1):
            e = p + 2
            while marked[p:e] in frequent and e < len(marked):
                e += 1
            out.append((p, marked[p:e]))
        return out

    for _ in range(400):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 10)))
        found = grams(word)
        starts = np.array([p for p, _ in found])
        ends = starts + np.array([len(g) for _, g in found]) - 1
        other = typo(rng, word, "abc")
        kept = sum((Counter(g for _, g in found) & Counter(g for _, g in grams(other))).values())
        assert len(found) - kept <= spelling.affected(len(word), starts, ends)


def test_grams_longer_than_words_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [], min_chars=4, q_max=5)
