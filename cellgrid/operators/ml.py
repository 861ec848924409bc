"""Matrix analytics on cells: normalisation, variable features, principal components, clusters and markers."""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import checkpoint


def log_normalize(counts: DataFrame, scale: float = 1e4) -> DataFrame:
    """Adds x = log1p(n * scale / depth of the cell) (K1)."""
    depth = counts.groupBy("cell").agg(F.sum("n").alias("_d"))
    return counts.join(depth, "cell").withColumn("x", F.log1p(F.col("n") * scale / F.col("_d"))).drop("_d")


def variable_features(counts: DataFrame, k: int, x: str = "n") -> DataFrame:
    """(feature, mean, dispersion, rank) of the k features with the largest variance over mean, zeros included (K2)."""
    cells = counts.agg(F.countDistinct("cell").alias("_c"))
    s = counts.groupBy("feature").agg(F.sum(x).alias("_s"), F.sum(F.col(x) * F.col(x)).alias("_q")).crossJoin(F.broadcast(cells))  # one row
    mean = F.col("_s") / F.col("_c")
    var = (F.col("_q") - F.col("_s") * mean) / (F.col("_c") - 1)
    ranked = s.select("feature", mean.alias("mean"), (var / mean).alias("dispersion")).orderBy(F.desc("dispersion"), "feature").limit(k)
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("dispersion"), "feature")))  # k rows


def feature_vectors(counts: DataFrame, features: list[str], x: str = "x") -> DataFrame:
    """(cell, v): a vector of the chosen features per cell, zeros where there is no count."""
    m = F.map_from_entries(F.collect_list(F.struct("feature", F.col(x).cast("double"))))
    kept = counts.filter(F.col("feature").isin(features)).groupBy("cell").agg(m.alias("_m"))
    return kept.select("cell", array_to_vector(F.transform(F.array(*map(F.lit, features)), lambda f: F.coalesce(F.col("_m")[f], F.lit(0.0)))).alias("v"))


def pca(vectors: DataFrame, k: int) -> DataFrame:
    """(cell, pcs) (K3). The vectors are read by each pass of the fits here and after, so they are kept."""
    vectors = checkpoint(vectors)
    return PCA(k=k, inputCol="v", outputCol="pcs").fit(vectors).transform(vectors).select("cell", "pcs")


def cluster(pcs: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """(cell, cluster) by k-means (K4)."""
    return KMeans(k=k, seed=seed, featuresCol="pcs", predictionCol="cluster").fit(pcs).transform(pcs).select("cell", "cluster")


def markers(matrix: DataFrame, clusters: DataFrame, min_pct: float = 0.1, min_lfc: float = 0.25, x: str = "x") -> DataFrame:
    """(cluster, feature, pct_in, pct_out, log2fc, p, p_adj): each cluster against the rest (K5).

    Rank sums come from the distinct values of a feature: cells without a count share the lowest rank, so zeros are never
    made into rows. Normal approximation with a tie correction; p-values adjusted by Benjamini and Hochberg per cluster.
    """
    c = clusters.groupBy("cluster").agg(F.count("*").alias("n_in"))
    total = clusters.agg(F.count("*").alias("n"))
    m = matrix.filter(F.col(x) > 0).join(clusters, "cell")
    values = m.groupBy("feature", x).agg(F.count("*").alias("k"))
    seen = values.groupBy("feature").agg(F.sum("k").alias("nz"))
    values = values.join(seen, "feature").crossJoin(F.broadcast(total))  # one row
    w = Window.partitionBy("feature").orderBy(x)
    zeros = F.col("n") - F.col("nz")
    ranks = values.withColumn("rank", zeros + F.sum("k").over(w) - F.col("k") + (F.col("k") + 1) / 2)
    ties = values.groupBy("feature").agg(F.sum(F.pow("k", F.lit(3)) - F.col("k")).alias("_t"), F.max(zeros).alias("zeros")).select("feature", "zeros", (F.col("_t") + F.pow("zeros", F.lit(3)) - F.col("zeros")).alias("ties"))
    per = m.join(ranks.select("feature", x, "rank"), ["feature", x]).groupBy("feature", "cluster").agg(F.sum("rank").alias("r"), F.count("*").alias("nz_in"), F.sum(F.expm1(x)).alias("s_in"))
    whole = m.groupBy("feature").agg(F.count("*").alias("nz"), F.sum(F.expm1(x)).alias("s"))
    d = per.join(whole, "feature").join(ties, "feature").join(F.broadcast(c), "cluster").crossJoin(F.broadcast(total))  # clusters; one row
    n_out = F.col("n") - F.col("n_in")
    rank_sum = F.col("r") + (F.col("n_in") - F.col("nz_in")) * (F.col("zeros") + 1) / 2
    u = rank_sum - F.col("n_in") * (F.col("n_in") + 1) / 2
    var = F.col("n_in") * n_out / 12 * ((F.col("n") + 1) - F.col("ties") / (F.col("n") * (F.col("n") - 1)))
    z = F.abs(u - F.col("n_in") * n_out / 2) / F.sqrt(var)
    # an upper tail of the normal distribution, by the classical rational approximation (absolute error below 7.5e-8)
    t = 1 / (1 + 0.2316419 * z)
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    lfc = F.log2((F.col("s_in") / F.col("n_in") + 1) / ((F.col("s") - F.col("s_in")) / n_out + 1))
    out = d.select("cluster", "feature", (F.col("nz_in") / F.col("n_in")).alias("pct_in"), ((F.col("nz") - F.col("nz_in")) / n_out).alias("pct_out"), lfc.alias("log2fc"), F.least(2 * tail, F.lit(1.0)).alias("p"))
    out = out.filter((F.greatest("pct_in", "pct_out") >= min_pct) & (F.col("log2fc") >= min_lfc))
    by = Window.partitionBy("cluster")
    step = F.col("p") * F.count("*").over(by) / F.row_number().over(by.orderBy("p", "feature"))
    adjusted = out.withColumn("_q", step).withColumn("p_adj", F.least(F.lit(1.0), F.min("_q").over(by.orderBy(F.desc("p"), F.desc("feature")))))
    return adjusted.drop("_q")
