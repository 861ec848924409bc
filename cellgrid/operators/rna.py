"""RNA counts: UMIs per barcode and gene, read classes, matrices, bead tables and bead-per-droplet histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S

SKIP = r"^(Unassigned|INTRON|INTERGENIC)"


def umi_counts(reads: DataFrame, barcode: str = "cell") -> DataFrame:
    """(barcode, reads, umis), distinct within a contig and summed over contigs."""
    return reads.groupBy(barcode).agg(F.count("*").alias("reads"), F.countDistinct("contig", "umi").alias("umis"))


def genic_umis(reads: DataFrame, barcode: str = "cell") -> DataFrame:
    """(barcode, genic_umis): distinct UMIs of reads with a gene."""
    return reads.filter("gene is not null").groupBy(barcode).agg(F.countDistinct("contig", "umi").alias("genic_umis"))


def umi_matrix(reads: DataFrame, skip: str = SKIP) -> DataFrame:
    """(cell, gene, n): distinct UMIs per cell and gene without unassigned, intronic and intergenic reads."""
    return reads.filter(F.col("gene").isNotNull() & ~F.col("gene").rlike(skip)).groupBy("cell", "gene").agg(F.countDistinct("umi").alias("n"))


def expression_summary(reads: DataFrame, mito: tuple[str, ...] = ("chrM", "MT"), species: list[str] | None = None) -> DataFrame:
    """One row per cell: read classes, genes, UMIs and transcripts.

    reads: (cell, contig, gene, feature, status, umi, ribosomal). Genes and UMIs count the pseudo-genes INTRON and
    INTERGENIC, transcripts do not; distinct counts are within a contig. A ribosomal read is not mitochondrial as well.
    With species, names of contigs carry them, and each gets its reads and UMIs.
    """
    is_mito = F.element_at(F.split("contig", r"\."), -1).isin(*mito)
    f, g, status = F.col("feature"), F.col("gene"), F.col("status")
    assigned = g.isNotNull() & ~g.startswith("Unassigned")
    genic = assigned & ~g.isin("INTRON", "INTERGENIC")
    classes = {
        "input_reads": F.lit(True), "coding_reads": f == "EXON", "utr_reads": f == "UTR", "intronic_reads": (f == "INTRON") | (g == "INTRON"),
        "intergenic_reads": (f == "INTERGENIC") | (g == "INTERGENIC"), "rRNA_reads": F.col("ribosomal"), "_other_reads": ~F.col("ribosomal"),
        "unassigned_ambiguous_reads": status == "Unassigned_Ambiguity", "unassigned_low_mapping_qual_reads": status == "Unassigned_MappingQuality",
        "unassigned_other_reads": status.startswith("Unassigned") & ~status.isin("Unassigned_Ambiguity", "Unassigned_MappingQuality"),
    }
    sums = [F.sum(c).alias(c) for c in classes]
    # reads move once, and so do the sums of a cell's genes: UMIs are told apart where their gene's reads are
    umis = reads.repartition("cell", "contig", "gene").groupBy("cell", "contig", "gene", "umi").agg(*[F.count_if(c).alias(name) for name, c in classes.items()])
    genes = umis.groupBy("cell", "contig", "gene").agg(F.count("*").alias("_umis"), *sums)
    zero = lambda where, c, name: F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0)).cast("long").alias(name)
    more = [x for s in species or [] for x in (zero(F.col("contig").startswith(f"{s}."), "input_reads", f"input_{s}_reads"), zero(F.col("contig").startswith(f"{s}.") & assigned, "_umis", f"{s}_umi"))]
    return genes.groupBy("cell").agg(
        F.sum("input_reads").alias("input_reads"), F.count_if(assigned).alias("genes"), zero(assigned, "_umis", "umi"), zero(genic, "_umis", "transcripts"), zero(genic, "input_reads", "genic_reads"),
        *[F.sum(c).alias(c) for c in classes if c not in ("input_reads", "_other_reads") and not c.startswith("unassigned")],
        zero(is_mito, "_other_reads", "mitochondrial_reads"), *[F.sum(c).alias(c) for c in classes if c.startswith("unassigned")], *more,
    )


def duplicate_counts(dups: DataFrame, barcode_map: DataFrame) -> DataFrame:
    """(cell, gene, n): duplicate reads per bead and gene, rolled up to cells; beads without one stay."""
    m = barcode_map.select("bead", F.col("cell").alias("_cell")).dropDuplicates(["bead"])
    return dups.join(m, "bead", "left").groupBy(F.coalesce("_cell", "bead").alias("cell"), "gene").agg(F.sum("n").alias("n"))


def is_binary(counts: DataFrame) -> DataFrame:
    """One row (largest, binary): a matrix without a count above 1 is refused by callers."""
    return counts.agg(F.max("n").alias("largest"), (F.coalesce(F.max("n"), F.lit(0)) <= 1).alias("binary"))


def matrix_features(counts: DataFrame) -> DataFrame:
    """One row: cells, features, median features per cell, all UMIs, median UMIs per cell."""
    cells = counts.filter("n > 0").groupBy("cell").agg(F.count("*").alias("f"), F.sum("n").alias("u"))
    features = counts.filter("n > 0").agg(F.countDistinct("gene").alias("features"))
    return cells.agg(F.count("*").alias("cells"), F.median("f").alias("median_features"), F.sum("u").alias("umis"), F.median("u").alias("median_umis")).crossJoin(features)  # one row each


def gene_table(counts: DataFrame, samples: list[str], column: str = "sample") -> DataFrame:
    """(gene, one column per sample), zeros where a sample lacks a gene."""
    return counts.groupBy("gene").pivot(column, samples).agg(F.sum("n")).na.fill(0)


def combine_counts(aligned: DataFrame, unaligned: DataFrame) -> DataFrame:
    """(barcode, alignedReads, unalignedReads), from a full outer join; what one side lacks is null."""
    return aligned.select("barcode", F.col("n").alias("alignedReads")).join(unaligned.select("barcode", F.col("n").alias("unalignedReads")), "barcode", "full")


def bead_summary(bead_counts: DataFrame, allowlist: DataFrame, cell_expr: DataFrame, bead_expr: DataFrame, barcode_map: DataFrame, measures: list[str]) -> DataFrame:
    """A row per bead: its counts, its expression and its cell's, with suffixes _bead and _cell."""
    cells = cell_expr.select("cell", *[F.col(c).alias(f"{c}_cell") for c in measures])
    above = allowlist.select("cell", F.lit(True).alias("_above")).distinct()
    out = bead_expr.select("bead", *[F.col(c).alias(f"{c}_bead") for c in measures]).join(barcode_map.select("bead", "cell", "n_beads"), "bead", "left").withColumn("cell", F.coalesce("cell", "bead"))
    return out.join(cells, "cell", "left").join(bead_counts.select(F.col("barcode").alias("bead"), "alignedReads", "unalignedReads"), "bead", "left").join(above, "cell", "left").withColumn("n_beads", F.coalesce("n_beads", F.lit(1))).withColumn("above_knee", F.coalesce("_above", F.lit(False))).drop("_above")


def bead_merge_stats(barcode_map: DataFrame) -> DataFrame:
    """One row (cells, multi_bead_cells, percent)."""
    return barcode_map.agg(F.countDistinct("cell").alias("cells"), F.countDistinct(F.when(F.col("n_beads") > 1, F.col("cell"))).alias("multi_bead_cells")).withColumn("percent", F.round(100 * F.col("multi_bead_cells") / F.col("cells"), 2))


def expr_metrics(expr: DataFrame, allowlist: DataFrame, measures: list[str]) -> DataFrame:
    """(metric, total, percent_of_reads, fraction_in_cells)."""
    e = expr.join(allowlist.select("cell", F.lit(1).alias("_in")).distinct(), "cell", "left")
    a = e.agg(*[F.sum(c).alias(c) for c in measures], *[F.sum(F.when(F.col("_in") == 1, F.col(c)).otherwise(0)).alias(f"{c}_in") for c in measures])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("total"), (100 * F.col(c) / F.col(measures[0])).alias("percent_of_reads"), (F.col(f"{c}_in") / F.col(c)).alias("fraction_in_cells")) for c in measures])).alias("r")
    return a.select(rows).select("r.*")


def lambdas(cells: DataFrame, droplets: int = 100_000) -> DataFrame:
    """One row (mean_beads, beads_per_droplet) over distinct cells (cell, n_beads)."""
    return cells.select("cell", "n_beads").distinct().agg(F.avg("n_beads").alias("mean_beads"), (F.sum("n_beads") / droplets).alias("beads_per_droplet"))


def bead_histogram(cells: DataFrame, rate: float = 3.0, top: int = 8) -> DataFrame:
    """(n_beads, observed, expected): cells by beads, the last bin open, against a zero-truncated Poisson."""
    c = cells.select("cell", "n_beads").distinct()
    seen = c.groupBy(F.least("n_beads", F.lit(top)).cast("int").alias("n_beads")).agg(F.count("*").alias("observed"))
    k = cells.sparkSession.range(1, top + 1).select(F.col("id").cast("int").alias("n_beads"))
    total = c.agg(F.count("*").alias("cells"))
    p = S.zero_truncated_poisson("n_beads", F.lit(rate))
    closed = F.sum(F.when(F.col("n_beads") < top, F.col("p"))).over(Window.partitionBy())
    return k.join(seen, "n_beads", "left").crossJoin(F.broadcast(total)).withColumn("p", p).select("n_beads", F.coalesce("observed", F.lit(0)).alias("observed"), (F.col("cells") * F.when(F.col("n_beads") < top, F.col("p")).otherwise(1 - closed)).alias("expected"))  # a row per bin


def dedup_umis(reads: DataFrame) -> DataFrame:
    """The best read (mapq, then name) of each cell, gene and UMI (W11). UMIs are those of corrected edges.

    max_by combines before the shuffle, so a hot UMI is no hot task.
    """
    return reads.groupBy("cell", "gene", "umi").agg(F.min_by("name", F.struct((-F.col("mapq")).alias("m"), "name")).alias("name"), F.max("mapq").alias("mapq"), F.count("*").alias("copies"))


def mark_duplicates(pairs: DataFrame) -> DataFrame:
    """Adds set_size and duplicate to read pairs: of one barcode, position and strand set, the best base sum stays."""
    site = ["barcode", "contig", "pos1", "pos2", "strand1", "strand2"]
    best = pairs.groupBy(*site).agg(F.min_by("name", F.struct((-F.col("base_sum")).alias("q"), "name")).alias("_best"), F.count("*").alias("set_size"))
    return pairs.join(best, site).withColumn("duplicate", F.col("name") != F.col("_best")).drop("_best")


def mapping_by_species(alignments: DataFrame, unique_mapq: int = 255) -> DataFrame:
    """(species, unique_reads, multi_reads)."""
    return alignments.groupBy(S.species_of_contig("contig").alias("species")).agg(F.count_if(F.col("mapq") == unique_mapq).alias("unique_reads"), F.count_if(F.col("mapq") != unique_mapq).alias("multi_reads"))


def saturation(counts: DataFrame, points: int = 25, seed: int = 1, total_reads: DataFrame | None = None, depth: int = 50_000) -> DataFrame:
    """(sample, fraction, median_features, n): median features per cell at even depths, drawn without replacement.

    Each UMI of a (cell, feature) has a uniform draw; a feature is seen at fraction f if its least draw is at most f. The
    least of n uniforms is 1 - (1 - u) ** (1 / n), so one draw per matrix entry is enough and nothing is exploded. Cells
    without a feature at a depth stay in the median.

    total_reads: (sample, reads). With it a row also has mean_depth, the reads per cell at its fraction, and a sample that
    has at least ``depth`` reads per cell has a row at that depth besides. A sample without reads there has null depths.
    """
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "sample", "cell", "gene")), 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    least = 1 - F.pow(1 - u, 1 / F.col("n"))
    d = counts.withColumn("_least", least)
    even = [F.count_if(F.col("_least") <= (i + 1) / points).alias(f"f{i}") for i in range(points)]
    if total_reads is None:
        per = d.groupBy("sample", "cell").agg(*even)
        rows = F.explode(F.array(*[F.struct(F.lit((i + 1) / points).alias("fraction"), F.col(f"f{i}").alias("features")) for i in range(points)])).alias("r")
        return per.select("sample", rows).groupBy("sample", "r.fraction").agg(F.median("r.features").alias("median_features"), F.count("*").alias("cells"))
    cells = counts.select("sample", "cell").distinct().groupBy("sample").agg(F.count("*").alias("_cells"))
    mean = cells.join(total_reads, "sample", "left").select("sample", (F.col("reads") / F.col("_cells")).alias("_mean"))  # a row a sample
    at = F.when(F.col("_mean") >= depth, depth / F.col("_mean"))
    per = d.join(mean, "sample").groupBy("sample", "cell", "_mean").agg(*even, F.count_if(F.col("_least") <= at).alias("_f"))
    kinds = [F.struct(F.lit((i + 1) / points).alias("fraction"), F.col(f"f{i}").alias("features"), ((i + 1) / points * F.col("_mean")).alias("depth")) for i in range(points)]
    extra = F.when(at.isNotNull(), F.array(F.struct(at.alias("fraction"), F.col("_f").alias("features"), F.lit(float(depth)).alias("depth")))).otherwise(F.array())
    rows = per.select("sample", F.explode(F.concat(F.array(*kinds), extra)).alias("r"))
    return rows.groupBy("sample", "r.fraction", F.round("r.depth").cast("long").alias("mean_depth")).agg(F.median("r.features").alias("median_features"), F.count("*").alias("cells"))


def species_mix(cells: DataFrame, a: str, b: str, threshold: float = 0.9) -> DataFrame:
    """One row about a mixed sample (G29). cells: (cell, and one count column per species).

    Purity is the share of own counts in single-species cells, 100 if a species has no cell. The measurable crosstalk is
    the share of mixed cells; the total one adds the doublets within a species that cannot be seen.
    """
    total = F.col(a) + F.col(b)
    c = cells.filter(total > 0).withColumn("_type", S.cell_type(F.col(a) / total, threshold))
    t = c.agg(*[F.count_if(F.col("_type") == k).alias(k) for k in ("species1", "species2", "mixed")], F.count("*").alias("cells"),
              F.sum(F.when(F.col("_type") == "species1", F.col(a))).alias("_a1"), F.sum(F.when(F.col("_type") == "species1", total)).alias("_t1"),
              F.sum(F.when(F.col("_type") == "species2", F.col(b))).alias("_b2"), F.sum(F.when(F.col("_type") == "species2", total)).alias("_t2"))
    none = (F.col("species1") == 0) | (F.col("species2") == 0)
    own = 100 * (F.col("_a1") + F.col("_b2")) / (F.col("_t1") + F.col("_t2"))
    p, q = F.col("species1") / (F.col("species1") + F.col("species2")), F.col("species2") / (F.col("species1") + F.col("species2"))
    seen = F.col("mixed") / F.col("cells")
    return t.select("cells", "species1", "species2", "mixed", F.when(none, 100.0).otherwise(own).alias("purity"), (100 * seen).alias("measurable_crosstalk"), (100 * F.when(none, seen).otherwise(seen / (2 * p * q))).alias("total_crosstalk"))
