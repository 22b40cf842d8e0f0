"""From raw documents to packed training windows, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns a DataFrame; it is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import mixing, neardup, packing, passages, quality
from stratalake.llm.common import release, staged, table
from stratalake.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the trained ratio reject go."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one of the smallest id.

    Groups of fingerprints come first and are checked, similar texts beyond their radius are added.
    """
    return neardup.keep_first(docs, reread=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the text; ``n_chars`` follows."""
    cut, spans = passages.drop_repeats(docs)
    return cut.drop(spans).selectExpr(*[("CAST(length(text) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their target weights."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, in windows of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Fingerprints, fitted models and tokens are beyond SQL: compared with brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name)
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
