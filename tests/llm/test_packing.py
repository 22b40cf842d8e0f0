"""Packing against the tokenizer itself and the contract."""

import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from stratalake.llm.packing import Schedule, WordEncoder, pack  # noqa: E402
from stratalake.llm.queries import tokenizer_path  # noqa: E402

TEXTS = [
    "", None, " \n ", "Hello, World!", "it's THE don't we'll I'VE", "é ÉCOLE école ﬁ", "a<|endoftext|>b <|startoftext|> <|x", "x y　z w", "数 字 12345 ½", "🙂 🙂🙂",
    "word," * 50, "tab\tnew\nline\x0bv\x0cf\rr", "a\x00b \x1c c\x85d", "İstanbul ΣΑΣ", "long " * 9000 + "end", "Mixed###words*** under_score a.b.c", "Über ÄÖÜß ÀÉÎõÿ×÷ été, Ça! naïve*** don't l'été <b> x<y é<|endoftext|> THE!! ÉCOLE%%% 3é é3 ª º",
]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(tokenizer_path())


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_whole_text(encoder):
    flat, counts = encoder.encode(pa.array(TEXTS))
    assert counts.tolist() == [len(plain(encoder, t)) for t in TEXTS]
    assert flat.tolist() == [i for t in TEXTS for i in plain(encoder, t)]


def test_given_texts(encoder, spark, small_tables):
    texts = [r.text for r in spark.read.parquet(f"{small_tables}/documents.parquet").select("text").collect()]
    flat, _ = encoder.encode(pa.array(texts))
    assert flat.tolist() == [i for t in texts for i in plain(encoder, t)]


@pytest.mark.parametrize("totals,weights", [([1000, 10, 3], None), ([7], None), ([500, 500, 500], [1.0, 2.0, 5.0]), ([9, 1000, 40], [3.0, 1.0, 0.0]), ([0, 5], None), ([1, 1, 1], [1.0, 1e-6, 3.0])])
def test_schedule(totals, weights):
    window = 16
    plan = Schedule(totals, weights, window)
    cells, whole = defaultdict(set), -(-sum(totals) // window)
    for s, n in enumerate(totals):
        at = 0
        while at < n:  # in pieces, as documents come
            size = min(n - at, random.Random(at).randint(1, 40))
            taken = 0
            for sequence, offset, length in plan.windows(s, at, size):
                for i in range(length):
                    assert offset + i not in cells[sequence]
                    cells[sequence].add(offset + i)
                taken += length
            assert taken == size
            at += size
    assert sorted(cells) == list(range(whole))
    for sequence, places in cells.items():
        assert places == set(range(min(window, sum(totals) - sequence * window)))


def test_shares_of_every_window():
    totals = [60_000, 30_000, 10_000]
    plan = Schedule(totals, None, 100)
    for s in range(3):
        got = defaultdict(int)
        for sequence, _, length in plan.windows(s, 0, totals[s]):
            got[sequence] += length
        assert set(got.values()) == {totals[s] // 1000}
    weighted = Schedule([1000, 1000], [3.0, 1.0], 100)
    first = [length for sequence, _, length in weighted.windows(0, 0, 1000) if sequence < 10]
    assert first == [75] * 10


def check(rows, pieces, encoder, window):
    cells, lengths = defaultdict(list), {}
    whole = defaultdict(list)
    for p in pieces:
        cells[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id, p.doc_tokens].append(p)
        lengths[p.sequence_id] = lengths.get(p.sequence_id, 0) + p.length
    assert sorted(cells) == list(range(len(cells)))
    for number, parts in cells.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or number == len(cells) - 1
    wanted = defaultdict(list)
    for doc_id, text in rows:
        ids = plain(encoder, text) + [1]
        wanted[doc_id, len(ids)].append(ids)
    assert set(wanted) == set(whole)
    for key, docs in wanted.items():
        assert sum(p.length for p in whole[key]) == sum(map(len, docs))
        if len(docs) == 1:
            at = 0
            for p in sorted(whole[key], key=lambda p: p.start):
                piece = docs[0][p.start : p.start + p.length]
                assert p.start == at and p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
                at += p.length
            assert at == len(docs[0])


@pytest.mark.parametrize("weights", [None, {"s0": 1.0, "s1": 4.0, None: 2.0}])
def test_pack(spark, encoder, weights):
    rows = [(i, t, [None, "s0", "s1"][i % 3]) for i, t in enumerate(TEXTS * 3)] + [(None, "no id", "s0"), (5, TEXTS[5], "s1"), (5, TEXTS[5], "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).withColumn("task", F.lit("clash")).withColumn("ids", F.lit(1))
    pieces = pack(df, tokenizer_path(), 256, weights=weights, with_ids=False).collect()
    check([(i, t) for i, t, _ in rows], pieces, encoder, 256)


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string, source string"), tokenizer_path()).count() == 0
