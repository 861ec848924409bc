"""ATAC fragments: from mate pairs to fragments, annotation with beads and cells, deduplication and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S


def pair_mates(alignments: DataFrame) -> DataFrame:
    """(sample, contig, name, pos1, end1, rev1, mapq1, pos2, end2, rev2, mapq2): mates of one read on one contig.

    Both mates come from one aggregation by name, with no self-join. A name with other than two primary mates is left out.
    """
    a = alignments.filter(S.is_primary("flag"))
    first = S.has_flag("flag", 0x40)
    pick = lambda c, which, name: F.max(F.when(which, F.col(c))).alias(name)
    a = a.withColumn("rev", S.has_flag("flag", 0x10))
    cols = [pick(c, which, f"{n}{i}") for i, which in ((1, first), (2, ~first)) for c, n in (("pos", "pos"), ("end", "end"), ("rev", "rev"), ("mapq", "mapq"))]
    return a.groupBy("sample", "contig", "name").agg(F.count_if(first).alias("_n1"), F.count("*").alias("_n"), *cols).filter("_n1 = 1 and _n = 2").drop("_n", "_n1")


def fragments_of_pairs(pairs: DataFrame, sizes: DataFrame, mapq: int = 30, most: int = 2000) -> DataFrame:
    """(chr, start, stop, read_name, orientation, support) of proper pairs (F3-F5). The forward mate gives the start."""
    o = S.orientation("rev1", "rev2", "mapq1", "mapq2", mapq)
    p = pairs.withColumn("orientation", o).filter("orientation is not null").withColumnRenamed("contig", "chr").join(sizes, "chr")
    start = F.when(F.col("orientation") == "r1r2", F.col("pos1")).otherwise(F.col("pos2"))
    stop = F.when(F.col("orientation") == "r1r2", F.col("end2")).otherwise(F.col("end1"))
    forward = F.col("orientation") == "r1r2"
    p = p.withColumn("start", S.shift_cut(start, forward, "length")).withColumn("stop", S.shift_cut(stop, forward, "length"))
    return p.filter((F.col("stop") > F.col("start")) & (F.col("stop") - F.col("start") <= most)).select("chr", "start", "stop", F.col("name").alias("read_name"), "orientation", F.lit(1).cast("long").alias("support"))


def annotate_bead(frags: DataFrame, read_bead: DataFrame) -> DataFrame:
    """Fragments with the bead of their read; a read without one is left out."""
    return frags.join(read_bead.filter("bead is not null").select("read_name", "bead").distinct(), "read_name")


def annotate_cell(frags: DataFrame, barcode_map: DataFrame) -> DataFrame:
    """Fragments with the cell of their bead; a bead without one is left out."""
    return frags.join(barcode_map.select("bead", "cell"), "bead")


def keep_deduped(alignments: DataFrame, barcode_map: DataFrame, names: DataFrame) -> DataFrame:
    """Reads of a mapped bead whose name survived deduplication, with their cell."""
    return alignments.join(barcode_map.select("bead", "cell"), "bead").join(names.select("name").distinct(), "name", "left_semi")


def frags_per_bead(frags: DataFrame) -> DataFrame:
    """(bead, n): distinct (chr, start, stop) of a bead (G1)."""
    return frags.groupBy("bead").agg(F.countDistinct("chr", "start", "stop").alias("n"))


def sum_counts(counts: DataFrame, mito: str = "MT") -> DataFrame:
    """Counts per bead over contigs, without the mitochondrial one."""
    return counts.filter(F.element_at(F.split("chr", r"\."), -1) != mito).groupBy("bead").agg(F.sum("n").alias("n"))


def dedup_cell(frags: DataFrame) -> DataFrame:
    """One row per (chr, start, stop, cell): the first read name and the sum of support."""
    return frags.groupBy("chr", "start", "stop", "cell").agg(F.min("read_name").alias("read_name"), F.sum("support").alias("support"))


def frag_sumstats(frags: DataFrame) -> DataFrame:
    """(cell, chr, total, unique): fragments before and after deduplication."""
    per = frags.groupBy("cell", "chr", "start", "stop").agg(F.count("*").alias("k"))
    return per.groupBy("cell", "chr").agg(F.sum("k").alias("total"), F.count("*").alias("unique"))


def basic_qc(stats: DataFrame, mito: list[str], species: list[str] | None = None) -> DataFrame:
    """One row per cell: nuclear and mitochondrial fragments, total and unique, and those of each species."""
    m = F.col("chr").isin(*mito)
    add = lambda c, k, name: F.sum(F.when(c, F.col(k)).otherwise(0)).alias(name)
    more = [add(~m & F.col("chr").startswith(s), k, f"{k}{s}Frags") for s in species or [] for k in ("total", "unique")]
    return stats.groupBy("cell").agg(add(~m, "total", "totalNuclearFrags"), add(~m, "unique", "uniqueNuclearFrags"), add(m, "total", "totalMitoFrags"), add(m, "unique", "uniqueMitoFrags"), *more)


def advanced_qc(qc: DataFrame) -> DataFrame:
    """Adds duplicateProportion and librarySize of the nuclear fragments."""
    t, u = "totalNuclearFrags", "uniqueNuclearFrags"
    return qc.withColumn("duplicateProportion", S.duplicate_rate(t, u)).withColumn("librarySize", S.library_size(t, u))


def frag_qc(frags: DataFrame, in_tss: str = "in_tss", in_peak: str = "in_peak") -> DataFrame:
    """(cell, mean and median insert size, share in TSS windows, share in peaks)."""
    size = F.col("stop") - F.col("start")
    return frags.groupBy("cell").agg(F.avg(size).alias("meanInsertSize"), F.median(size).alias("medianInsertSize"), F.avg(F.col(in_tss).cast("double")).alias("tssProportion"), F.avg(F.col(in_peak).cast("double")).alias("FRIP"))


def join_qc(qc: DataFrame, more: DataFrame) -> DataFrame:
    return qc.join(more, "cell", "left")


def flagstat(alignments: DataFrame) -> DataFrame:
    """(metric, value): counts of alignments by flag."""
    f = "flag"
    paired = S.has_flag(f, 0x1) & S.is_primary(f)
    rules = {
        "total": F.lit(True), "secondary": S.has_flag(f, 0x100), "supplementary": S.has_flag(f, 0x800), "duplicates": S.has_flag(f, 0x400),
        "mapped": S.lacks_flag(f, 0x4), "paired": paired, "read1": paired & S.has_flag(f, 0x40), "read2": paired & S.has_flag(f, 0x80),
        "properly_paired": paired & S.has_flag(f, 0x2) & S.lacks_flag(f, 0x4), "both_mapped": paired & S.lacks_flag(f, 0xC), "singletons": paired & S.lacks_flag(f, 0x4) & S.has_flag(f, 0x8),
    }
    return alignments.agg(*[F.count_if(c).alias(k) for k, c in rules.items()]).unpivot([], list(rules), "metric", "value")


def idxstats(alignments: DataFrame) -> DataFrame:
    """(contig, mapped, unmapped)."""
    return alignments.groupBy("contig").agg(F.count_if(S.lacks_flag("flag", 0x4)).alias("mapped"), F.count_if(S.has_flag("flag", 0x4)).alias("unmapped"))


def insert_sizes(alignments: DataFrame) -> DataFrame:
    """(size, n): absolute template lengths of first mates of proper pairs."""
    return alignments.filter(S.is_proper_pair("flag") & S.has_flag("flag", 0x40) & (F.col("tlen") != 0)).groupBy(F.abs("tlen").alias("size")).agg(F.count("*").alias("n"))


def insert_size_metrics(histogram: DataFrame) -> DataFrame:
    """One row (mean_size, median_size) from a histogram (size, n); the median is the first size that half have reached."""
    w = Window.orderBy("size")  # one row per size
    h = histogram.withColumn("_c", F.sum("n").over(w)).withColumn("_t", F.sum("n").over(Window.partitionBy()))
    return h.agg((F.sum(F.col("size") * F.col("n")) / F.max("_t")).alias("mean_size"), F.min(F.when(2 * F.col("_c") >= F.col("_t"), F.col("size"))).alias("median_size"))


def step_counts(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """(process, metric, value): proper pairs before and after a step, and the mapped share."""
    one = lambda df, name: df.agg((F.count_if(S.is_proper_pair("flag")) / 2).alias(name), (100 * F.count_if(S.lacks_flag("flag", 0x4)) / F.count("*")).alias(f"{name}_mapped"))
    both = one(before, "input").crossJoin(one(after, "output"))  # one row each
    return both.unpivot([], ["input", "output", "input_mapped", "output_mapped"], "metric", "value").select(F.lit(step).alias("process"), "metric", "value")


def index_counts(reads: DataFrame, k: int, warn_below: int = 10_000) -> DataFrame:
    """(sample, ti, count, low, percent): reads per plate index, which of them are few, and their share."""
    n = reads.groupBy("sample", S.index_of_name("name", k).alias("ti")).agg(F.count("*").alias("count"))
    return n.withColumn("low", F.col("count") < warn_below).withColumn("percent", 100 * F.col("count") / F.sum("count").over(Window.partitionBy("sample")))


def beads_of_reads(reads: DataFrame, pos: int = 0) -> DataFrame:
    """Distinct bead barcodes of read names."""
    return reads.select(S.name_part("name", pos).alias("bead")).filter("bead is not null").distinct()


def read_qc(reads: DataFrame) -> DataFrame:
    """(pos, n, mean_quality, share of each base): per-cycle figures of (seq, qual)."""
    each = lambda c: F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    q = reads.select(F.posexplode(F.arrays_zip(each("seq").alias("base"), each("qual").alias("qual"))).alias("pos", "b")).select("pos", "b.base", (F.ascii("b.qual") - 33).alias("code"))
    return q.groupBy("pos").agg(F.count("*").alias("n"), F.avg("code").alias("mean_quality"), *[F.avg((F.col("base") == b).cast("double")).alias(b) for b in "ACGTN"])


def mean_cycle_quality(per_cycle: DataFrame) -> DataFrame:
    return per_cycle.agg(F.avg("mean_quality").alias("mean_cycle_quality"))
