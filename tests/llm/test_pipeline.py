"""The pipeline stage by stage, each on its own input, against plain versions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from stratalake.llm import quality  # noqa: E402
from stratalake.llm.common import staged  # noqa: E402
from stratalake.llm.packing import WordEncoder  # noqa: E402
from stratalake.llm.queries import tokenizer_path  # noqa: E402
from tests.llm.test_packing import check  # noqa: E402
from tests.llm.test_neardup import slow_kept  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, small_tables):
    """Input and output of every stage over the smallest tables and a few odd rows."""
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    long = " ".join(f"word{i} and light of the river" for i in range(3000))
    odd = [(None, long, "en", None, 1), (10**6, None, None, "src0", None), (10**6 + 1, "", "en", "srcX", 0), (10**6 + 2, long, "en", "src1", 5), (10**6 + 2, long, "en", "src1", 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = staged(stage(spark, docs, small_tables), f"test-{name}")
        out[name] = docs, result
        docs = result
    return out


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "mix_sources", "pack_windows"]
    assert all(out.columns == COLUMNS for name, (_, out) in steps.items() if name != "pack_windows")


def test_quality_keeps_what_the_verdict_keeps(spark, small_tables, steps):
    docs, out = steps["quality_rules"]
    judged = quality.judge(docs, spark.read.parquet(f"{small_tables}/labels.parquet")).cache()
    want = sorted((tuple(r.doc) for r in judged.collect() if r.kept), key=repr)
    judged.unpersist()
    assert rows(out) == want and 0 < len(want) < docs.count()


def test_near_duplicates_leave_one_row(steps):
    """The rows that stay are whole rows, and those of all pairs compared by five-word Jaccard."""
    docs, out = steps["near_dedup"]
    before, after = rows(docs), rows(out)
    assert not Counter(after) - Counter(before)
    assert sorted((r[0] for r in after), key=repr) == slow_kept([(r[0], r[1]) for r in before])


def test_passages_are_cut(steps):
    """What goes stands earlier, window by window; no passage of 50 words that stands earlier is left."""
    docs, out = steps["substring_dedup"]
    held = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in docs.collect())
    kept = {(r.doc_id is None, r.doc_id or 0): r.text or "" for r in out.collect()}
    assert len(kept) == len(held) == docs.count()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
    seen, cut = set(), 0
    for key, text in held:
        words, left = text.lower().split(), kept[key].lower().split()
        windows = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        if kept[key] == text:
            assert not any(w in seen for w in windows), key
        else:
            cut += 1
            assert not any(tuple(left[i : i + 50]) in seen for i in range(len(left) - 49)), key
            assert not Counter(left) - Counter(words)
        seen.update(windows)
    assert cut > 0


def test_clashing_columns_travel(spark, small_tables):
    names = ("k1", "k2", "mix_copies_", "copies", "epoch_", "row_uid", "spans", "span_doc_id", "span_doc_hash", "uid", "sid", "key", "hash", "words", "score", "kept")
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").withColumns({c: F.lit(c) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, small_tables), f"clash-{name}")
        assert docs.columns == [*COLUMNS, *names]
        assert docs.filter(" OR ".join(f"{c} != '{c}'" for c in names)).count() == 0 and docs.count() > 0


def test_mix_repeats_whole_rows(steps):
    docs, out = steps["mix_sources"]
    before, after = Counter(rows(docs)), Counter(rows(out))
    assert set(after) <= set(before) and all(after[r] <= 3 * before[r] for r in after)


def test_windows_hold_every_token(steps):
    docs, out = steps["pack_windows"]
    check([(r.doc_id, r.text) for r in docs.collect()], out.collect(), WordEncoder(tokenizer_path()), 2048)
    assert out.filter(F.octet_length("ids") != 4 * F.col("length")).count() == 0


def test_empty_documents(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, small_tables), f"empty-{name}")
        assert docs.count() == 0
