"""Antibody tags: cleaning, mismatch maps, matching, debarcoding, counts, and joins of modalities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S


def clean_tags(raw: DataFrame) -> DataFrame:
    """(sequence, label) from a two-column table in either order: the column of sequences is found by its letters."""
    a, b = raw.columns[:2]
    swap = raw.agg((F.count_if(S.is_sequence(a)) < F.count_if(S.is_sequence(b))).alias("_swap"))
    both = raw.select(a, b).crossJoin(F.broadcast(swap))  # one row
    return both.select(F.upper(F.when(F.col("_swap"), F.col(b)).otherwise(F.col(a))).alias("sequence"), S.clean_label(F.when(F.col("_swap"), F.col(a)).otherwise(F.col(b))).alias("label"))


def mismatch_map(tags: DataFrame) -> DataFrame:
    """(seq, label, key): each sequence and its one-substitution neighbours, keyed label-pos-base."""
    near = tags.select("label", F.explode(S.mismatches("sequence")).alias("m")).select(F.col("m.seq").alias("seq"), "label", F.concat_ws("-", "label", "m.pos", "m.base").alias("key"))
    return tags.select(F.col("sequence").alias("seq"), "label", F.col("label").alias("key")).unionByName(near)


def min_edit_distance(tags: DataFrame) -> DataFrame:
    """One row (min_distance): the least edit distance between sequences of two labels (F20); null with fewer labels.

    Distances are tried from 0. Of two sequences within d edits, one of d + 1 even pieces of the first stands in the second
    at most d places away, so only pairs that share such a piece are compared. Pieces get short only where no near pair
    was found, and a panel without near pairs is small. Rows with a null in either column take no part.
    """
    t = tags.select("sequence", "label", F.length("sequence").alias("size")).dropna().distinct()
    answer = lambda d: tags.sparkSession.range(1).select(F.lit(d).cast("int").alias("min_distance"))
    shortest, longest, labels = t.agg(F.min("size"), F.max("size"), F.countDistinct("label")).first()
    if labels < 2:
        return answer(None)
    for d in range(longest + 1):
        low, high = shortest // (d + 1), -(-longest // (d + 1))
        edge = lambda i: F.floor(i * F.col("size") / (d + 1)).cast("int")  # noqa: B023, E731
        a = t.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(d)))).withColumn("at", edge(F.col("i")) + 1)
        a = a.select("sequence", "label", "at", F.substr("sequence", F.col("at"), edge(F.col("i") + 1) + 1 - F.col("at")).alias("piece"))
        b = t.withColumn("n", F.explode(F.sequence(F.lit(low), F.least(F.lit(high), F.col("size")))))
        b = b.withColumn("at2", F.explode(F.sequence(F.lit(1), F.when(F.col("n") == 0, 1).otherwise(F.col("size") - F.col("n") + 1))))
        b = b.select(F.col("sequence").alias("sequence2"), F.col("label").alias("label2"), "at2", F.substr("sequence", F.col("at2"), F.col("n")).alias("piece"))
        near = (F.col("piece") == "") | (F.abs(F.col("at") - F.col("at2")) <= d)
        met = a.join(b, "piece").filter((F.col("label") < F.col("label2")) & near)
        if not met.filter(F.levenshtein("sequence", "sequence2") <= d).isEmpty():
            return answer(d)
    return answer(None)


def unambiguous(mapped: DataFrame) -> DataFrame:
    """Rows of a mismatch map whose sequence leads to one label; an exact sequence wins over neighbours."""
    exact = F.max(F.when(F.col("key") == F.col("label"), F.col("label")))
    return mapped.groupBy("seq").agg(exact.alias("_exact"), F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_exact is not null or _a = _b").select("seq", F.coalesce("_exact", "_a").alias("label"))


def match_tags(reads: DataFrame, tags: DataFrame, length: int) -> DataFrame:
    """Reads (.., seq) with the label of their first bases, exact or with one mismatch."""
    return reads.withColumn("_s", F.substring("seq", 1, length)).join(unambiguous(mismatch_map(tags)).withColumnRenamed("seq", "_s"), "_s").drop("_s")


def debarcode(reads: DataFrame, segments: list[dict], whitelists: dict[str, DataFrame]) -> DataFrame:
    """Reads with barcode and umi from fixed segments.

    segments: {"kind": "Barcode" | "Umi" | "Const", "start": i, "length": n, "list": name or "seq": sequence}. Barcodes
    are corrected within one substitution to their whitelist (seq); an ambiguous or unknown one, or a wrong constant,
    leaves the read out. A whitelist is joined, and broadcast only if Spark finds it small.
    """
    out, codes, umis = reads, [], []
    for i, s in enumerate(segments):
        part = F.substring("seq", s["start"] + 1, s["length"])
        if s["kind"] == "Umi":
            umis.append(part)
        elif s["kind"] == "Const":
            out = out.filter(F.levenshtein(part, F.lit(s["seq"])) <= 1)
        else:
            m = unambiguous(mismatch_map(whitelists[s["list"]].select(F.col("seq").alias("sequence"), F.col("seq").alias("label")).distinct())).select(F.col("seq").alias(f"_s{i}"), F.col("label").alias(f"_b{i}"))
            out = out.withColumn(f"_s{i}", part).join(m, f"_s{i}").drop(f"_s{i}")
            codes.append(F.col(f"_b{i}"))
    return out.withColumn("barcode", F.concat(*codes)).withColumn("umi", F.concat(*umis) if umis else F.lit("")).drop(*[f"_b{i}" for i in range(len(segments))])


def debarcode_counts(reads: DataFrame, good: DataFrame) -> DataFrame:
    """One row (total, good)."""
    return reads.agg(F.count("*").alias("total")).crossJoin(good.agg(F.count("*").alias("good")))  # one row each


def adt_matrix(reads: DataFrame) -> DataFrame:
    """(cell, feature, n): distinct UMIs."""
    return reads.groupBy("cell", F.col("label").alias("feature")).agg(F.countDistinct("umi").alias("n"))


def adt_metrics(counts: DataFrame) -> DataFrame:
    """One row (total, median_umi, median_adts) over cells."""
    c = counts.filter("n > 0").groupBy("cell").agg(F.sum("n").alias("u"), F.count("*").alias("f"))
    return c.agg(F.sum("u").alias("total"), F.median("u").alias("median_umi"), F.median("f").alias("median_adts"))


def adt_per_cell(counts: DataFrame) -> DataFrame:
    """(feature, mean_count): mean over all cells of the table, to one decimal."""
    cells = counts.agg(F.countDistinct("cell").alias("_cells"))
    return counts.groupBy("feature").agg(F.sum("n").alias("_n")).crossJoin(F.broadcast(cells)).select("feature", F.round(F.col("_n") / F.col("_cells"), 1).alias("mean_count"))  # one row


def contaminants(reads: DataFrame, classes: dict[str, str]) -> DataFrame:
    """One row: distinct read names per class, by a pattern of their reference, unmapped and in all."""
    rules = [F.countDistinct(F.when(F.col("reference").rlike(p), F.col("name"))).alias(k) for k, p in classes.items()]
    return reads.agg(*rules, F.countDistinct(F.when(F.col("reference").isNull(), F.col("name"))).alias("unmapped"), F.countDistinct("name").alias("total"))


def feature_summary(counts: DataFrame, x: str = "n") -> DataFrame:
    """(feature, min, q1, median, q3, max, mean)."""
    p = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return counts.groupBy("feature").agg(F.min(x).alias("min"), p.alias("_p"), F.max(x).alias("max"), F.avg(x).alias("mean")).select("feature", "min", F.col("_p")[0].alias("q1"), F.col("_p")[1].alias("median"), F.col("_p")[2].alias("q3"), "max", "mean")


def cluster_freq(clusters: DataFrame) -> DataFrame:
    """(cluster, n, share)."""
    n = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(clusters.agg(F.count("*").alias("_t")))).select("cluster", "n", (F.col("n") / F.col("_t")).alias("share"))  # one row


def align_modalities(rna: DataFrame, adt: DataFrame) -> DataFrame:
    """Counts of both modalities on the cells that both have, with their feature type."""
    common = rna.select("cell").intersect(adt.select("cell"))
    return merge_modalities(rna.join(common, "cell", "left_semi"), adt.join(common, "cell", "left_semi"))


def merge_modalities(rna: DataFrame, adt: DataFrame) -> DataFrame:
    """(cell, feature, n, type)."""
    return rna.select("cell", "feature", "n", F.lit("Gene Expression").alias("type")).unionByName(adt.select("cell", "feature", "n", F.lit("Antibody Capture").alias("type")))


def join_embeddings(meta: DataFrame, embeddings: list[DataFrame]) -> DataFrame:
    """Cell metadata joined with each embedding by barcode."""
    return reduce(lambda a, b: a.join(b, "barcode"), embeddings, meta)
