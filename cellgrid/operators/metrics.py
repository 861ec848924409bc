"""Tidy metrics, roll-ups, set operations and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_tidy(df: DataFrame, ids: list[str]) -> DataFrame:
    """Wide to (ids, metric, value)."""
    values = [c for c in df.columns if c not in ids]
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values]).unpivot(ids, values, "metric", "value")


def to_wide(df: DataFrame, row: str, col: str, val: str, names: list) -> DataFrame:
    """Tidy to wide, a column for each of names."""
    return df.groupBy(row).pivot(col, names).agg(F.sum(val))


def concat(parts: list[DataFrame]) -> DataFrame:
    """Union of parts by name; what a part lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def concat_samples(parts: dict[str, DataFrame]) -> DataFrame:
    """Union of samples with their key."""
    return concat([df.withColumn("sample", F.lit(k)) for k, df in parts.items()])


def regroup(parts: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """Rows (fastq, ti, ..) under the sample that the config (fastq, ti, sample) declares, or one pooled sample."""
    if config is None:
        return parts.withColumn("sample", F.lit("SuperloadedSample"))
    return parts.join(config.select("fastq", "ti", F.col("sample").alias("_s")).distinct(), ["fastq", "ti"], "left").withColumn("sample", F.coalesce("_s", F.lit("SuperloadedSample"))).drop("_s")


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a, as often as a has more of them than b."""
    return a.exceptAll(b)


def sum_by_process(metrics: DataFrame) -> DataFrame:
    """(sample, process, metric, value): processes that carry a contig as suffix after a dash, rolled up."""
    return metrics.groupBy("sample", F.regexp_extract("process", r"^([^-]*)", 1).alias("process"), "metric").agg(F.sum("value").alias("value"))


def dup_rollup(parts: DataFrame) -> DataFrame:
    """(sample, reads, duplicates, percent): the percentage is made anew, never averaged."""
    return parts.groupBy("sample").agg(F.sum("reads").alias("reads"), F.sum("duplicates").alias("duplicates")).withColumn("percent", F.when(F.col("reads") > 0, 100 * F.col("duplicates") / F.col("reads")).otherwise(0.0))


def bead_filt_summary(cells: DataFrame, reads: DataFrame) -> DataFrame:
    """Cells, reads per cell and median fragments for each index of a sample, and for the sample.

    cells: (sample, ti, cell, frags), reads: (sample, ti, reads). Two levels, by rollup; a sample's row has a null ti.
    """
    c = cells.rollup("sample", "ti").agg(F.countDistinct("cell").alias("cells"), F.median("frags").alias("median_frags"), F.grouping_id().alias("_g")).filter("_g < 3")
    r = reads.rollup("sample", "ti").agg(F.sum("reads").alias("reads"), F.grouping_id().alias("_g")).filter("_g < 3").withColumnsRenamed({"sample": "_s", "ti": "_t", "_g": "_h"})
    j = c.join(r, F.col("sample").eqNullSafe(F.col("_s")) & F.col("ti").eqNullSafe(F.col("_t")) & (F.col("_g") == F.col("_h")))
    return j.select("sample", "ti", "cells", "reads", (F.col("reads") / F.col("cells")).alias("mean_reads_per_cell"), "median_frags")


def funnel(metrics: DataFrame, steps: list[str]) -> DataFrame:
    """(sample, one count per step, and each as a percentage of the first)."""
    a = metrics.groupBy("sample").agg(*[F.sum(F.when(F.col("metric") == s, F.col("value"))).alias(s) for s in steps])
    return a.select("sample", *steps, *[F.round(100 * F.col(s) / F.col(steps[0]), 2).alias(f"{s}_pct") for s in steps[1:]])


def summary_metrics(metrics: DataFrame, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """(sample, metric, value): percentages of one summed metric over another."""
    names = sorted({x for pair in ratios.values() for x in pair})
    a = metrics.groupBy("sample").agg(*[F.sum(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    return a.select("sample", *[(100 * F.col(x) / F.when(F.col(y) != 0, F.col(y))).alias(k) for k, (x, y) in ratios.items()]).unpivot(["sample"], list(ratios), "metric", "value")


def reconcile(found: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, issue): found but not declared, or declared but not found."""
    f, d = found.select(*keys, F.lit(1).alias("_f")).distinct(), declared.select(*keys, F.lit(1).alias("_d")).distinct()
    issue = F.when(F.col("_d").isNull(), "not declared").when(F.col("_f").isNull(), "not found")
    return f.join(d, keys, "full").withColumn("issue", issue).filter("issue is not null").select(*keys, "issue")


def resolve_index(config: DataFrame, index: DataFrame) -> DataFrame:
    """The config with the sequence of each index name."""
    return config.join(index.select("ti", "sequence"), "ti")
