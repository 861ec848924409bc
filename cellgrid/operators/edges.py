"""Bead edges: weights, UMI correction, droplets from components, allowlists and renumbering."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .graph import checkpoint, connected_components
from .numbering import numbered

EDGE = ["bead1", "umi1", "bead2", "umi2"]
_GAP, _BLANK = "\x01", "\x02"
#: Edges of a bead pair that one row holds.
HELD = 4096
#: Edges that are compared each with each, in columns.
FEW = 16


def canonical(edges: DataFrame) -> DataFrame:
    """Edges with the smaller (bead, UMI) end first (F9); other columns are kept."""
    return edges.withColumn("_e", S.canonical_edge(*EDGE)).select(*[F.col(f"_e.{c}").alias(c) for c in EDGE], *[c for c in edges.columns if c not in EDGE])


def _clean(edges: DataFrame) -> DataFrame:
    """Edges whose UMIs hold no N."""
    return edges.filter(~F.col("umi1").contains("N") & ~F.col("umi2").contains("N"))


def edge_weights(edges: DataFrame, least: int = 3) -> DataFrame:
    """(bead1, bead2, weight): distinct UMI pairs without N, between different beads, at least so many."""
    clean = canonical(_clean(edges.filter("bead1 <> bead2")))
    return clean.groupBy("bead1", "bead2").agg(F.countDistinct("umi1", "umi2").alias("weight")).filter(F.col("weight") >= least)


def edge_metadata(edges: DataFrame) -> DataFrame:
    """One row (total, unique, ambiguous, redundant): edges by what a repeat or an N makes of them."""
    n = canonical(edges).groupBy(*EDGE).agg(F.count("*").alias("k"))
    clear = ~F.col("umi1").contains("N") & ~F.col("umi2").contains("N")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return n.agg(zero(F.sum("k")).alias("total"), F.count_if(clear).alias("unique"), zero(F.sum(F.when(~clear, F.col("k")))).alias("ambiguous"), zero(F.sum(F.when(clear, F.col("k") - 1))).alias("redundant"))


def allow(df: DataFrame, allowlist: DataFrame, columns: list[str], bead: str = "bead") -> DataFrame:
    """Rows whose listed columns are all on the allowlist."""
    names = allowlist.select(bead).distinct()
    for c in columns:
        df = df.join(names.withColumnRenamed(bead, c), c, "left_semi").select(*df.columns)
    return df


def unmerged_beads(beads: DataFrame, barcode_map: DataFrame) -> DataFrame:
    """Beads that are in no droplet."""
    return beads.select("bead").distinct().join(barcode_map.select("bead"), "bead", "left_anti")


def _masked(umis: Column, places: int) -> Column:
    """The pair of UMIs with so many places left blank, in all ways."""
    blank = lambda s: F.transform(F.filter(F.sequence(F.lit(1), F.length(s)), lambda i: ~F.substring(s, i, F.lit(1)).isin(_GAP, _BLANK)), lambda i: F.overlay(s, F.lit(_BLANK), i, F.lit(1)))
    out = F.array(umis)
    for _ in range(places):
        out = F.array_distinct(F.flatten(F.transform(out, lambda s: F.when(F.size(blank(s)) > 0, blank(s)).otherwise(F.array(s)))))
    return out


def umi_links(counts: DataFrame, threshold: int = 1) -> DataFrame:
    """(a, b): UMI pairs of one bead pair that differ in at most ``threshold`` places, of equal lengths, where n_a >= 2 n_b - 1.
    counts: (node, n), node a struct with bead1, bead2, umi1 and umi2.

    Pairs that differ in few places are equal with these places left blank, so they meet in one key. A key holds no more
    pairs than the alphabet has letters (to the power of the threshold), and a bead pair is spread over its keys.
    """
    n = F.col("node")
    umis = F.concat(n["umi1"], F.lit(_GAP), n["umi2"])
    keyed = counts.select("node", "n", F.explode(_masked(umis, threshold)).alias("key"))
    met = keyed.groupBy(n["bead1"].alias("bead1"), n["bead2"].alias("bead2"), "key").agg(F.collect_list(F.struct("node", "n")).alias("met")).filter(F.size("met") > 1)
    both = met.select("met", F.explode("met").alias("a")).select("a", F.explode("met").alias("b"))
    links = both.filter((F.col("a.node") != F.col("b.node")) & (F.col("a.n") >= 2 * F.col("b.n") - 1)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    return links if threshold == 1 else links.distinct()


def _directional(met: list[str], threshold: int) -> list[tuple[str, int, int]]:
    """(UMI pair, n, corrected) of one bead pair's edges, each written as umi1, gap, umi2."""
    n, keys = Counter(met), {}
    for u in n:
        at = [i for i, c in enumerate(u) if c != _GAP]
        own = []
        for blank in combinations(at, min(threshold, len(at))):
            s = list(u)
            for i in blank:
                s[i] = _BLANK
            own.append("".join(s))
        keys[u] = own
    same: dict[str, list[str]] = {}
    for u, own in keys.items():
        for k in own:
            same.setdefault(k, []).append(u)
    out, taken = [], set()
    for u in sorted(n, key=lambda u: (-n[u], u.split(_GAP))):
        if u in taken:
            continue
        taken.add(u)
        reach, total = [u], 0
        for x in reach:
            total += n[x]
            for k in keys[x]:
                for y in same[k]:
                    if y not in taken and n[x] >= 2 * n[y] - 1:
                        taken.add(y)
                        reach.append(y)
        out.append((u, total, total - n[u]))
    return out


def _corrected(edges: DataFrame, threshold: int) -> DataFrame:
    """correct_edge_umis for canonical edges without nulls, where a row holds the edges of a bead pair.

    Few edges without a link among them stay in columns; the others are put together one bead pair at a time."""
    met = edges.groupBy("bead1", "bead2").agg(F.collect_list(F.concat("umi1", F.lit(_GAP), "umi2")).alias("met"))
    # what differs in few places is no farther by edits
    near = lambda a, b: (a < b) & (F.length(a) == F.length(b)) & (F.levenshtein(a, b) <= threshold)
    own = F.array_distinct("met")
    linked = (F.size("met") > 1) & ((F.size("met") > FEW) | F.exists(own, lambda a: F.exists(own, lambda b: near(a, b))))
    alone = F.transform(own, lambda u: F.struct(u.alias("u"), F.size(F.filter("met", lambda x: x == u)).cast("long").alias("n"), F.lit(0).cast("long").alias("corrected")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(a, b, *r) for a, b, m in zip(pdf["bead1"], pdf["bead2"], pdf["met"], strict=True) for r in _directional(list(m), threshold)]
            yield pd.DataFrame(rows, columns=["bead1", "bead2", "u", "n", "corrected"])

    b1, b2 = (f"{c} {edges.schema[c].dataType.simpleString()}" for c in ("bead1", "bead2"))
    both = met.filter(~linked).select("bead1", "bead2", F.explode(alone).alias("r")).select("bead1", "bead2", "r.*").union(met.filter(linked).mapInPandas(run, f"{b1}, {b2}, u string, n long, corrected long"))
    return both.select("bead1", F.substring_index("u", _GAP, 1).alias("umi1"), "bead2", F.substring_index("u", _GAP, -1).alias("umi2"), "n", "corrected")


def correct_edge_umis(edges: DataFrame, threshold: int = 1, held: int = HELD) -> DataFrame:
    """(bead1, umi1, bead2, umi2, n, corrected): UMI pairs after directional correction, n edges each.

    From the commonest down, a UMI pair takes what it reaches by links and nobody has taken; of equal counts the first by
    UMIs goes first. Bead pairs of at most ``held`` edges come in one row each, and their edges move once. Those with
    more edges, or with nulls, go by masked keys. Null beads and UMIs count as values that differ from all others; an empty
    table gives an empty table.
    """
    c = canonical(edges).select(*EDGE)
    sizes = c.groupBy("bead1", "bead2").agg(F.count("*").alias("k"), F.count_if(F.col("umi1").isNull() | F.col("umi2").isNull()).alias("nulls"))
    rest = checkpoint(sizes.filter(f"k > {held} or nulls > 0 or bead1 is null or bead2 is null").select(F.col("bead1").alias("r1"), F.col("bead2").alias("r2")))
    if rest.isEmpty():
        return _corrected(c, threshold)
    among = F.col("bead1").eqNullSafe(F.col("r1")) & F.col("bead2").eqNullSafe(F.col("r2"))
    return _corrected(c.join(rest, among, "left_anti"), threshold).union(_corrected_by_keys(c.join(rest, among, "left_semi"), threshold))


def _corrected_by_keys(edges: DataFrame, threshold: int) -> DataFrame:
    """correct_edge_umis for canonical edges, where a bead pair is spread over masked keys.

    Each UMI pair belongs to the first of all that reach it, which rounds of joins find: counts fall by half along a link
    unless both are 1, and UMI pairs of count 1 are put together as components.
    """
    n = edges.groupBy(*EDGE).agg(F.count("*").alias("n"))
    # in order of nodes the commoner comes first
    node = F.struct("bead1", "bead2", (-F.col("n")).alias("less"), "umi1", "umi2").alias("node")
    links = checkpoint(umi_links(n.dropna(subset=EDGE).select(node, "n"), threshold))
    ones = connected_components(links.filter("na = 1 and nb = 1").select("a", "b"))
    rare = links.filter("nb = 1 and na > 1").join(ones.select(F.col("node").alias("b"), "component"), "b", "left").select("a", F.coalesce("component", "b").alias("b"))
    common = links.filter("nb > 1").select("a", "b")
    first, was = checkpoint(common.select(F.col("b").alias("node")).union(links.filter("na > 1").select("a")).distinct().select("node", F.col("node").alias("to"))), None
    while True:
        told = common.join(first, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "to")
        first = checkpoint(first.union(told).groupBy("node").agg(F.min("to").alias("to")))
        mark = first.agg(F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()[0]
        if mark == was:
            break
        was = mark
    reached = rare.join(first, F.col("a") == F.col("node")).groupBy("b").agg(F.min("to").alias("to"))
    # a pair of count 1: by its component, or alone
    alone = reached.join(ones, F.col("b") == F.col("node"), "left").select(F.coalesce("node", "b").alias("node"), "to")
    members = ones.join(reached.select(F.col("b").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("to"))
    found = members.union(alone.join(members.select("node"), "node", "left_anti")).union(first)
    done = n.select(*EDGE, "n", node).join(found, "node", "left").withColumn("to", F.coalesce("to", "node"))
    moved = F.when(F.col("node") != F.col("to"), F.col("n")).otherwise(0)
    return done.groupBy("bead1", F.col("to.umi1").alias("umi1"), "bead2", F.col("to.umi2").alias("umi2")).agg(F.sum("n").alias("n"), F.sum(moved).alias("corrected")).select(*EDGE, "n", "corrected")


def merge_beads(edges: DataFrame, least: int = 3) -> DataFrame:
    """(bead, droplet, n_beads): components of the pruned bead graph.

    Beads that lose all edges stay as droplets of their own; beads whose edges all lead to themselves are absent.
    """
    proper = edges.filter("bead1 <> bead2")
    # a single edge without N is enough for a weight of 1, and components drop repeats
    strong = edge_weights(edges, least) if least > 1 else _clean(proper)
    kept = strong.select(F.col("bead1").alias("a"), F.col("bead2").alias("b"))
    loops = proper.select(F.col("bead1").alias("a")).union(proper.select("bead2")).distinct().select("a", F.col("a").alias("b"))
    comp = connected_components(kept.union(loops))
    return comp.join(comp.groupBy("component").agg(F.count("*").alias("n_beads")), "component").select(F.col("node").alias("bead"), F.col("component").alias("droplet"), "n_beads")


def unmerge(allowlist: DataFrame, barcode_map: DataFrame) -> DataFrame:
    """All beads of the allowed cells; a cell that is no droplet is a bead itself."""
    m = barcode_map.select("cell", "bead")
    return allowlist.select("cell").join(m, "cell", "left").select(F.coalesce("bead", "cell").alias("bead")).distinct()


def beads_per_cell(qc: DataFrame, cell: str = "cell") -> DataFrame:
    """(cell, beads_in_drop), in order of cells."""
    return qc.select(cell, S.beads_in_drop(cell).alias("beads_in_drop")).distinct()


def append_unmerged(barcode_map: DataFrame, beads: DataFrame, sample: str) -> DataFrame:
    """The map with a droplet for each bead that has none, numbered on, and all names padded to the new width.

    New droplets are numbered in the order of their beads, by sorted ranges."""
    new = numbered(unmerged_beads(beads, barcode_map), ["bead"], "_place")
    number = F.regexp_extract("cell", r"BC0*(\d+)N\d+$", 1).cast("long")
    last = barcode_map.agg(F.coalesce(F.max(number), F.lit(0)).alias("last"))
    added = new.crossJoin(F.broadcast(last)).select("bead", (F.col("last") + F.col("_place")).alias("number"), F.lit(1).alias("n"))  # one row
    old = barcode_map.select("bead", number.alias("number"), S.beads_in_drop("cell").alias("n"))
    both = old.unionByName(added)
    width = both.agg(F.length(F.max("number").cast("string")).alias("width"))
    text = F.col("number").cast("string")
    name = F.concat(F.translate(F.lit(sample), "-_", ""), F.lit("BC"), F.repeat(F.lit("0"), F.col("width") - F.length(text)), text, F.lit("N"), F.col("n").cast("string"))
    return both.crossJoin(F.broadcast(width)).select("bead", name.alias("cell"), F.col("n").cast("long").alias("n_beads"))  # one row


def map_with_synthetic(counts: DataFrame, barcode_map: DataFrame, sample: str) -> DataFrame:
    """(cell, feature, n): counts by bead summed to cells; beads without a droplet get synthetic ids (W17), in the order of
    the beads, by sorted ranges."""
    unknown = counts.select("bead").distinct().join(barcode_map.select("bead"), "bead", "left_anti")
    made = numbered(unknown, ["bead"], "_place").select("bead", F.concat(F.lit(f"{sample}SYN"), F.col("_place").cast("string")).alias("cell"))
    both = barcode_map.select("bead", "cell").unionByName(made)
    return counts.join(both, "bead").groupBy("cell", "feature").agg(F.sum("n").alias("n"))


def map_or_self(df: DataFrame, barcode_map: DataFrame, bead: str = "bead") -> DataFrame:
    """Adds cell: the bead's droplet, or the bead if it has none."""
    m = barcode_map.select(F.col("bead").alias(bead), F.col("cell").alias("_cell")).dropDuplicates([bead])
    return df.join(m, bead, "left").withColumn("cell", F.coalesce("_cell", bead)).drop("_cell")
