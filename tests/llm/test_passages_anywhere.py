"""Passages of 25 words or more are cut whatever stands around them, against windows of words."""

import random

import pytest

from stratalake.llm.passages import deduplicated


def left_over(rows, kept, size):
    """Windows of ``size`` words that an earlier text has and a kept text still holds."""
    seen, found = set(), []
    for doc_id, text in rows:
        words = kept[doc_id].lower().split()
        found += [(doc_id, i) for i in range(len(words) - size + 1) if tuple(words[i : i + size]) in seen]
        words = text.lower().split()
        seen |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    return found


@pytest.mark.parametrize("marks", ["", ".,;"])
def test_pasted_into_a_sentence(spark, marks):
    rng = random.Random(17)

    def words(n):
        return [f"w{rng.randrange(10**7)}" + (rng.choice(marks) if marks and rng.random() < 0.2 else "") for _ in range(n)]

    passages = [words(n) for n in (25, 26, 30, 50, 57, 66, 80)]
    rows, pasted = [], {}
    for i in range(70):
        passage = passages[i % 7]
        before, after = words(rng.randint(1, 30)), words(rng.randint(1, 30))
        rows.append((i, " ".join(before + passage + after)))
        pasted[i] = " ".join(before), " ".join(after)
    rows.append((70, " ".join(words(24) + passages[3][:24] + words(9))))  # under the bound
    got = {r.doc_id: r for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = {i: r.text for i, r in got.items()}
    assert left_over(rows, kept, 25) == []
    for i, text in rows:
        if i < 7 or i == 70:
            assert kept[i] == text and got[i].n_removed == 0
        else:  # the passage whole and nothing else
            before, after = pasted[i]
            assert kept[i] == f"{before}  {after}"
            assert [(s.n_words, s.first_doc_id) for s in got[i].spans] == [(len(passages[i % 7]), i % 7)]
            assert got[i].removed_chars == len(text) - len(kept[i])


def test_repeats_inside_a_text_and_odd_rows(spark):
    line = " ".join(f"a{i}" for i in range(40))
    rows = [(1, f"{line}\n{line} end"), (2, None), (3, ""), (4, " \n "), (None, line), (5, line), (5, line), (6, "x y " * 200)]
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = {r.doc_id: r.text for r in got}
    assert len(got) == len(rows)
    assert kept == {1: f"{line}\n end", 2: None, 3: "", 4: " \n ", None: "", 5: "", 6: "x y  "}


def slow_lines(rows, low):
    """Texts without the lines of ``low`` words or more that stand earlier; all words differ otherwise."""
    seen, kept = set(), {}
    for doc_id, text in rows:
        left = []
        for line in text.split("\n"):
            key = " ".join(line.lower().split())
            repeat = len(key.split()) >= low and key in seen
            seen.add(key)
            left.append("" if repeat else line)
        kept[doc_id] = "\n".join(left)
    return kept


@pytest.mark.parametrize("low", [20, 10, 1])
def test_repeated_lines_go_whole(spark, low):
    """Lines are decided by their digests alone: the earliest stays, whatever is around it."""
    rng = random.Random(23)
    common = [" ".join(f"c{n}x{i}" for i in range(n)) for n in (1, 2, 9, 10, 11, 19, 20, 21, 24)]
    rows = []
    for i in range(40):
        lines = [rng.choice([str.upper, str.title, str.lower])(x) for x in rng.sample(common, 4)]
        own = [" ".join(f"o{i}y{n}z{k}" for k in range(rng.randint(2, 30))) for n in range(5)]
        rows.append((i, "\n".join(x for pair in zip(own, [*lines, own[0][::-1]]) for x in pair)))
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), min_line_words=low).collect()
    assert {r.doc_id: r.text for r in got} == slow_lines(rows, low)
    assert all(r.removed_chars == sum(s.end - s.start for s in r.spans or ()) for r in got)


def test_five_documents_with_a_common_line(spark):
    line = " ".join(f"word{i}" for i in range(20))
    rows = [(i, f"start of {i}\n  {line.title()}\t\nend of {i}") for i in range(5)]
    got = {r.doc_id: r for r in deduplicated(spark.createDataFrame(rows * 3, "doc_id long, text string")).collect()}
    assert sorted(i for i, r in got.items() if r.n_removed) == [1, 2, 3, 4]
    for i in range(1, 5):
        (span,) = got[i].spans
        assert rows[i][1][span.start : span.end] == line.title() and span.first_doc_id == 0
        assert got[i].text == f"start of {i}\n  \t\nend of {i}"
