"""Constraint checks of references, configurations and reads: each gives a table of violations, empty if all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import merge_intervals, subtract_intervals


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n) for rules that some rows break, all counted in one pass (X11)."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(True))).alias(k) for k, c in rules.items()]).unpivot([], list(rules), "rule", "n").filter("n > 0")


def check_reference(features: DataFrame, contigs: DataFrame, kinds: tuple[str, ...] = ("exon",)) -> DataFrame:
    """(rule, n): coordinates, strands, ids, unknown contigs, missing kinds and repeated contigs (X11)."""
    rows = violations(features, {
        "coordinates": (F.col("start") < 0) | (F.col("stop") <= F.col("start")),
        "strand": ~F.col("strand").isin("+", "-"),
        "gene_id": F.col("gene_id").isNull() | (F.col("gene_id") == ""),
    })
    unknown = features.join(contigs.select("chr").distinct(), "chr", "left_anti").agg(F.count("*").alias("n")).select(F.lit("contig").alias("rule"), "n")
    twice = contigs.groupBy("chr").agg(F.count("*").alias("k")).filter("k > 1").agg(F.count("*").alias("n")).select(F.lit("repeated_contig").alias("rule"), "n")
    lacking = features.agg(*[(1 - F.max((F.col("kind") == k).cast("int"))).cast("long").alias(f"no_{k}") for k in kinds]).unpivot([], [f"no_{k}" for k in kinds], "rule", "n")
    return rows.unionByName(unknown).unionByName(twice).unionByName(lacking).filter("n > 0")


def check_config(config: DataFrame, index: DataFrame) -> DataFrame:
    """(rule, n): repeated (sample, ti), unknown index names, sequences of unequal length."""
    n = lambda df, rule: df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
    twice = config.groupBy("sample", "ti").agg(F.count("*").alias("k")).filter("k > 1")
    unknown = config.join(index.select("ti"), "ti", "left_anti")
    lengths = config.join(index, "ti").agg((F.countDistinct(F.length("sequence")) - 1).alias("n")).select(F.lit("unequal_length").alias("rule"), F.greatest("n", F.lit(0)).cast("long").alias("n"))
    return n(twice, "repeated").unionByName(n(unknown, "unknown_index")).unionByName(lengths).filter("n > 0")


def check_pairs(reads: DataFrame) -> DataFrame:
    """(rule, n): reads without a mate, and quality strings of another length than their sequence."""
    single = reads.groupBy("sample", "name").agg(F.count_if(F.col("mate") == 1).alias("a"), F.count_if(F.col("mate") == 2).alias("b")).filter("a <> 1 or b <> 1").agg(F.count("*").alias("n")).select(F.lit("unpaired").alias("rule"), "n")
    return violations(reads, {"quality_length": F.length("seq") != F.length("qual")}).unionByName(single.filter("n > 0"))


def has_contig(sizes: DataFrame, name: str) -> DataFrame:
    """One row (present)."""
    return sizes.agg((F.count_if(F.col("chr") == name) > 0).alias("present"))


def restrict_contigs(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows on known contigs."""
    return df.join(contigs.select("chr").distinct(), "chr", "left_semi")


def prefix_species(df: DataFrame, species: str) -> DataFrame:
    return df.withColumn("chr", F.concat_ws(".", F.lit(species), "chr"))


def gene_symbols(features: DataFrame) -> DataFrame:
    """(gene_id, gene_name) of exons and UTRs; the id stands in for a missing name."""
    return features.filter(F.col("kind").rlike("exon|utr")).select("gene_id", F.coalesce("gene_name", "gene_id").alias("gene_name")).distinct()


def ribosomal_genes(features: DataFrame) -> DataFrame:
    return features.filter(F.col("biotype").rlike("rRNA")).select("gene_id").distinct()


def build_saf(features: DataFrame, sizes: DataFrame) -> DataFrame:
    """(name, chr, start, stop, strand) of EXON, UTR, INTRON and INTERGENIC stretches.

    Per gene and strand: UTRs and exons merged, exons without UTRs, introns as the gene without both; per strand:
    intergenic stretches as what no gene covers.
    """
    keys = ["gene_id", "chr", "strand"]
    part = lambda c: merge_intervals(features.filter(c).select(*keys, "start", "stop"), keys).select(*keys, "start", "stop")
    utr, exon, gene = part(F.col("kind").rlike("utr")), part(F.col("kind") == "exon"), part(F.col("kind") == "gene")
    pure = subtract_intervals(exon, utr, keys)
    intron = subtract_intervals(gene, exon.unionByName(utr), keys)
    strands = sizes.select("chr", "length", F.explode(F.array(F.lit("+"), F.lit("-"))).alias("strand"))
    space = subtract_intervals(strands.select("chr", "strand", F.lit(0).cast("long").alias("start"), F.col("length").alias("stop")), gene.select("chr", "strand", "start", "stop"), ["chr", "strand"])
    named = [df.select(F.concat_ws("_", "gene_id", F.lit(k)).alias("name"), "chr", "start", "stop", "strand") for df, k in ((pure, "EXON"), (utr, "UTR"), (intron, "INTRON"))]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(space.select(F.lit("INTERGENIC").alias("name"), "chr", "start", "stop", "strand"))
