"""The corpus pipeline: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import decontam, mixing, neardup, passages, toxicity
from cellgrid.llm.common import Scratch, table


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose id and text stand in gone (doc_id, text_digest, ...); a null id equals a null id."""
    g = gone.select(F.col("doc_id").alias("g_id"), F.col("text_digest").alias("g_digest")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("g_id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("g_digest"))
    return rows.join(g, same, "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; so do repeated rows and rows without an id. Null and empty texts stay,
    an empty table stays empty, and all columns are returned as they are."""
    return _without(docs, toxicity.toxicity(docs, table(spark, sf_dir, "labels")).filter("toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, with all rows of its id. Rows without an id, and null or empty
    texts, stay; an empty table stays empty, and all columns are returned as they are."""
    gone = neardup.near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(gone, F.col("row.doc_id") == F.col("gone_id"), "left_anti").select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats of passages are cut out of the texts; every row stays, those without an id or a text as they are."""
    return passages.without_passages(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; so do repeated rows and rows without an id. Null and empty texts stay, an
    empty table stays empty, and all columns are returned as they are."""
    return _without(docs, decontam.contaminated(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes, with the words it takes of each, repeats counted. Repeated rows and rows without an id are
    drawn one by one; null and empty texts have no words to take. Columns size, source_size, target and taken replace
    those of docs with these names; an empty table stays empty."""
    mixed = mixing.mix(docs, mixing.label_weights(table(spark, sf_dir, "labels")), whole_rows=True).filter("taken > 0")
    new = ["size", "source_size", "target", "taken"]
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *new)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{i}")
        if i > 1:
            scratch.drop(f"stage-{i - 2}")
        scratch.release()
    return docs
