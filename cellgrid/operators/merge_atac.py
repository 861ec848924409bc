"""Merging of ATAC beads: co-occurring cut sites, Jaccard scores, thresholds from a density, and star merges."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from .graph import Saved, connected_components, first_independent_set
from .numbering import numbered

#: Beads of a site that meet in one join key, at most twice as many.
BLOCK = 1024


def nc_filter(frags: DataFrame, most: int = 6) -> DataFrame:
    """Rows of fragments (chr, start, stop) that occur at most so often (G3); n_rows has how often.

    Before rows move, each task leaves out what a fragment has beyond one row too many, so that one with very many rows is no
    single task's group; then rows are counted where they are.
    """
    site = ["chr", "start", "stop"]
    w = Window.partitionBy(*site)
    few = frags.withColumn("_at", F.row_number().over(w.orderBy("start"))).filter(F.col("_at") <= most + 1)
    return few.withColumn("n_rows", F.count("*").over(w)).filter(F.col("n_rows") <= most).select(*site, *[c for c in frags.columns if c not in site], "n_rows")


def dedup_bead(frags: DataFrame) -> DataFrame:
    """One row per (chr, start, stop, bead) and, where there are such columns, support and orientation."""
    return frags.dropDuplicates([c for c in ("chr", "start", "stop", "support", "bead", "orientation") if c in frags.columns])


def sites(frags: DataFrame, method: str = "both", digits: int = 0) -> DataFrame:
    """(chr, side, pos, bead): the cut sites that are compared."""
    return frags.select("chr", "bead", F.explode(S.cut_sites("start", "stop", method)).alias("s")).select("chr", F.col("s.side").alias("side"), S.round_site("s.pos", digits).alias("pos"), "bead")


def site_pairs(at: DataFrame, block: int = BLOCK) -> DataFrame:
    """(b1, b2, n): how often rows of two beads meet at a site, b1 > b2.

    Rows are counted by site and bead, so a pair comes once per site, with the product of its counts. The rows of a site
    move to one place once, where they are counted and put in one row. Sites with more than ``block`` rows are looked for
    before; their beads are dealt to blocks instead, and each pair of blocks is a join key of its own: no row or key holds
    more than two blocks, whatever a site holds. Rows with a null bead or at no site meet nothing.
    """
    site, saved = ["chr", "side", "pos"], Saved(at.sparkSession)
    at = at.dropna(subset=[*site, "bead"]).select(*site, "bead")
    hot = saved(at.groupBy(*site).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > block).select(*site))
    cold = hot.isEmpty()
    rest, many = (at, hot.withColumn("bead", F.lit(None).cast(at.schema["bead"].dataType))) if cold else (at.join(hot, site, "left_anti"), at.join(hot, site, "left_semi"))
    counted = rest.repartition(*site).groupBy(*site, "bead").agg(F.count("*").alias("k"))
    met = counted.groupBy(*site).agg(F.sort_array(F.collect_list(F.struct("bead", "k"))).alias("met"))
    each = met.select("met", F.posexplode("met").alias("i", "a")).filter("i > 0").select("a", F.explode(F.slice("met", F.lit(1), F.col("i"))).alias("b"))
    few = each.select(F.col("a.bead").alias("b1"), F.col("b.bead").alias("b2"), (F.col("a.k") * F.col("b.k")).alias("n"))
    n = many.groupBy(*site, "bead").agg(F.count("*").alias("k")).withColumn("_beads", F.count("*").over(Window.partitionBy(*site)))
    dealt = n.withColumn("_m", F.ceil(F.col("_beads") / block).cast("int"))
    dealt = dealt.withColumn("_g", F.pmod(F.xxhash64("bead"), F.col("_m")).cast("int"))
    a = dealt.select(*site, F.col("_g").alias("_i"), F.explode(F.sequence(F.col("_g"), F.col("_m") - 1)).alias("_j"), F.col("bead").alias("x1"), F.col("k").alias("k1"))
    b = dealt.select(*site, F.explode(F.sequence(F.lit(0), F.col("_g"))).alias("_i"), F.col("_g").alias("_j"), F.col("bead").alias("x2"), F.col("k").alias("k2"))
    pairs = a.join(b, [*site, "_i", "_j"]).filter((F.col("_i") < F.col("_j")) | (F.col("x1") > F.col("x2")))
    return few.union(pairs.select(F.greatest("x1", "x2").alias("b1"), F.least("x1", "x2").alias("b2"), (F.col("k1") * F.col("k2")).alias("n")))


def pair_counts(pairs: DataFrame, least: int = 4) -> DataFrame:
    """(barc1, barc2, n_both) with n_both >= least."""
    return pairs.groupBy(F.col("b1").alias("barc1"), F.col("b2").alias("barc2")).agg(F.sum("n").alias("n_both")).filter(F.col("n_both") >= least)


def with_counts(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Pairs with n_barc1 and n_barc2 of counts (bead, n)."""
    a, b = (counts.select(F.col("bead").alias(f"barc{i}"), F.col("n").alias(f"n_barc{i}")) for i in (1, 2))
    return pairs.join(a, "barc1").join(b, "barc2")


def jaccard(pairs: DataFrame, regularise: float = 0.05, digits: int = 5) -> DataFrame:
    """Adds jaccard_frag = N / (N1 + N2 - N + 0.05), each bead having two sites per fragment; only above 0."""
    n, a, b = F.col("n_both"), 2 * F.col("n_barc1"), 2 * F.col("n_barc2")
    score = F.round(n / (a + b - n + regularise), digits)
    kept = [c for c in pairs.columns if c not in ("n_barc1", "n_barc2")]
    return pairs.select(*kept, a.alias("n_barc1"), b.alias("n_barc2"), score.alias("jaccard_frag")).filter("jaccard_frag > 0")


def bead_pair_jaccard(frags: DataFrame, method: str = "both", most_rows: int = 6, least_both: int = 4, digits: int = 0) -> DataFrame:
    """The whole chain: G3, G4, J12, G9, J13, G10. frags: (chr, start, stop, bead, support)."""
    return scored(Saved(frags.sparkSession)(cleaned(frags, most_rows)), method, least_both, digits)


def cleaned(frags: DataFrame, most_rows: int = 6) -> DataFrame:
    """(chr, start, stop, bead) of G3 and G4: what sites and counts are taken of."""
    return dedup_bead(nc_filter(frags, most_rows)).select("chr", "start", "stop", "bead")


def bead_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("bead").agg(F.count("*").alias("n"))


def scored(clean: DataFrame, method: str = "both", least_both: int = 4, digits: int = 0) -> DataFrame:
    """The chain after G4. clean: (chr, start, stop, bead), a saved table, as it is read several times."""
    return jaccard(with_counts(pair_counts(site_pairs(sites(clean, method, digits)), least_both), bead_counts(clean)))


def mode(df: DataFrame, x: str) -> DataFrame:
    """The commonest value, the smallest of ties."""
    return df.groupBy(x).agg(F.count("*").alias("n")).agg(F.max_by(x, F.struct("n", -F.col(x))).alias("mode"))


def density(df: DataFrame, x: str, bandwidth: float = 0.1, points: int = 10_000) -> DataFrame:
    """(i, x, density): a Gaussian kernel density of log10 x on an even grid from minimum to maximum.

    Values are counted at the two grid points beside them, in shares by distance; that is the part that grows with the
    table. What is convolved with the kernel, cut at five bandwidths, has a row a grid point at most. Values that are null or
    not above 0 are left out; an empty table gives no grid, and a single value a grid of one point.
    """
    v = df.filter(F.col(x) > 0).select(F.log10(x).alias("v"))
    span = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).filter("n > 0").select("lo", "n", ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"))
    place = F.when(F.col("step") > 0, (F.col("v") - F.col("lo")) / F.col("step")).otherwise(0.0)
    beside = v.crossJoin(F.broadcast(span)).select(place.alias("p"), "lo", "n", "step").select("lo", "n", "step", F.least(F.floor("p"), F.lit(points - 1)).alias("c"), (F.col("p") - F.floor("p")).alias("f"))  # one row
    counted = beside.groupBy("lo", "n", "step", "c").agg(F.sum(1 - F.col("f")).alias("here"), F.sum("f").alias("next"))

    def convolved(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lo, n, step = key
        size = points if step > 0 else 1
        k, c = np.zeros(size + 1), pdf["c"].to_numpy()
        np.add.at(k, c, pdf["here"].to_numpy())
        np.add.at(k, c + 1, pdf["next"].to_numpy())
        reach = min(size, math.ceil(5 * bandwidth / step)) if step > 0 else 0
        z = np.arange(-reach, reach + 1) * step / bandwidth
        total = np.convolve(k, np.where(np.abs(z) <= 5, np.exp(-z * z / 2), 0))[reach : reach + size]
        return pd.DataFrame({"i": np.arange(size, dtype=np.int32), "x": lo + np.arange(size) * step, "density": total / n / (bandwidth * math.sqrt(2 * math.pi))})

    return counted.groupBy("lo", "n", "step").applyInPandas(convolved, "i int, x double, density double")


def density_threshold(grid: DataFrame, spread: float = 0.5, skip: float = 0.2, low: float = 1e-6, high: float = 0.5, fallback: float = 0.005) -> DataFrame:
    """One row (raw, safe): a threshold at a local minimum of a density over log10 x.

    Minima are visited from the right; those in the first skip of the grid do not count. The first one whose height is
    below spread times the peak is taken. A threshold outside (low, high) gives the fallback.
    """
    w = Window.orderBy("i")  # the grid has a fixed number of points
    g = grid.withColumn("before", F.lag("density").over(w)).withColumn("after", F.lead("density").over(w)).withColumn("peak", F.max("density").over(Window.partitionBy())).withColumn("m", F.max("i").over(Window.partitionBy()))
    minima = g.filter((F.col("density") < F.col("before")) & (F.col("density") <= F.col("after")) & (F.col("i") >= skip * F.col("m")) & (F.col("density") < spread * F.col("peak")))
    raw = minima.agg(F.pow(F.lit(10.0), F.max_by("x", "i")).alias("raw"))
    return raw.select("raw", F.when((F.col("raw") > low) & (F.col("raw") < high), F.col("raw")).otherwise(F.lit(fallback)).alias("safe"))


def merge_by_jaccard(counts: DataFrame, pairs: DataFrame, cut: float) -> DataFrame:
    """(bead, droplet, n_beads, head_rank): the greedy star merge in descending order of counts.

    The loop over beads takes the largest bead that is left as a head with all its neighbours, and joins droplets that a
    neighbour is already in. Its heads are the lexicographically first maximal independent set in count order, and its
    droplets the components over edges that touch a head. counts: (bead, n), pairs: (barc1, barc2, jaccard_frag).
    """
    edges = pairs.filter(F.col("jaccard_frag") >= cut).select(F.col("barc1").alias("a"), F.col("barc2").alias("b"))
    # a rank that needs no global window: more reads first, then the name
    nodes = counts.select(F.col("bead").alias("node"), F.struct((-F.col("n")).alias("n"), F.col("bead").alias("bead")).alias("rank"))
    heads = first_independent_set(nodes, edges)
    at_head = edges.join(heads.select(F.col("node").alias("a")), "a", "left_semi").union(edges.join(heads.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b"))
    loops = counts.select(F.col("bead").alias("a"), F.col("bead").alias("b"))
    comp = connected_components(at_head.distinct().union(loops))
    last = comp.join(heads, "node", "left").groupBy("component").agg(F.max("rank").alias("head"), F.count("*").alias("n_beads"))
    return comp.join(last, "component").select(F.col("node").alias("bead"), F.col("head.bead").alias("droplet"), "n_beads")


def number_cells(groups: DataFrame, sample: str, order: list | None = None) -> DataFrame:
    """(bead, cell, n_beads) with droplet names, numbered by their order (U5). groups: (bead, droplet, n_beads).

    Droplets are numbered by sorted ranges, one row per droplet, and names are padded to the width of the last number.
    """
    drops = numbered(groups.select("droplet", "n_beads").distinct(), order or [F.desc("n_beads"), F.col("droplet")], "number")
    drops = drops.crossJoin(F.broadcast(drops.agg(F.length(F.max("number").cast("string")).alias("width"))))  # one row
    width = F.col("width")
    text = F.col("number").cast("string")
    padded = F.concat(F.repeat(F.lit("0"), width - F.length(text)), text)
    named = drops.select("droplet", F.concat(F.translate(F.lit(sample), "-_", ""), F.lit("BC"), padded, F.lit("N"), F.col("n_beads").cast("string")).alias("cell"))
    return groups.join(named, "droplet").select("bead", "cell", "n_beads")


def merge_none(beads: DataFrame) -> DataFrame:
    """Each bead is its own droplet (U4)."""
    return beads.select("bead").distinct().select("bead", F.col("bead").alias("droplet"), F.lit(1).cast("long").alias("n_beads"))


def deconvolution_metrics(pairs: DataFrame, cut: float, merged: DataFrame, counts: DataFrame) -> DataFrame:
    """(metric, value) rows about a merge."""
    p = pairs.agg(F.count("*").cast("double").alias("pairs_scored"), F.count_if(F.col("jaccard_frag") >= cut).cast("double").alias("pairs_above_threshold"), F.max("jaccard_frag").alias("highest_jaccard"))
    m = merged.agg(F.countDistinct("droplet").cast("double").alias("droplets"), F.count("*").cast("double").alias("beads"), F.count_if(F.col("n_beads") > 1).cast("double").alias("beads_in_multiplets"))
    c = counts.agg(F.sum("n").cast("double").alias("fragments"))
    return p.crossJoin(m).crossJoin(c).unpivot([], ["pairs_scored", "pairs_above_threshold", "highest_jaccard", "droplets", "beads", "beads_in_multiplets", "fragments"], "metric", "value")  # one row each
