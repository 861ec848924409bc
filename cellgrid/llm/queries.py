"""The registered queries of the corpus operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html, langid, mixing, neardup, negatives, passages, quality, repair, rules, topk, toxicity, warc
from .common import Scratch, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.label_weights(table(spark, sf_dir, "labels")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), Scratch(spark).path("warc"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.embedding_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % topk.EVERY == 0)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(conversations), conversations.select("conv_id"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = negatives.labelled_vectors(table(spark, sf_dir, "embeddings"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % negatives.EVERY == 0)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"
    return rules.clean_lines(table(spark, sf_dir, "documents")).select(*digest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_mixing, op3_substring_dedup, op4_decontamination, op5_minhash_near_dedup, op6_warc_revisits,
        op7_language_id, op8_html_extraction, op9_exact_top_k, op10_quality_classifier,
        op11_conversation_repair, op12_hard_negatives, op13_quality_rules,
    )
}
ORACLE_SQL: dict[str, str] = {"op2_mixing": mixing.SQL, "op5_minhash_near_dedup": neardup.SQL, "op6_warc_revisits": warc.SQL, "op9_exact_top_k": topk.SQL, "op11_conversation_repair": repair.SQL, "op12_hard_negatives": negatives.SQL, "op13_quality_rules": rules.SQL}
