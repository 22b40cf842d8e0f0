"""Registered queries of the operators: the whole given tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import codes, collisions, html_text, licenses, mixing, oracles, packing, passages, quality, simhash, spelling, topk, toxicity, warc
from stratalake.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file; the package comes with the environment."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), html_text.trained(spark))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return judged.select(F.col("doc.doc_id").alias("doc_id"), *counts)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.deduplicated(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).drop("source")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_html": op2_html,
        "op3_simhash": op3_simhash,
        "op4_quality": op4_quality,
        "op5_toxicity": op5_toxicity,
        "op6_passages": op6_passages,
        "op7_licenses": op7_licenses,
        "op8_packing": op8_packing,
        "op9_mixing": op9_mixing,
        "op10_topk": op10_topk,
        "op11_spelling": op11_spelling,
        "op12_codes": op12_codes,
        "op13_neighbours": op13_neighbours,
    }


def llm_oracles() -> dict[str, str]:
    return {"op9_mixing": oracles.OP9, "op11_spelling": oracles.OP11, "op12_codes": oracles.OP12}
