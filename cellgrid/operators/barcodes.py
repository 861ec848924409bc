"""Ranked barcode curves, knees and cell calling.

Curves are built from the histogram of counts, not from a window over all barcodes of a sample: barcodes of one count are
one row, so the ordered part has as many rows as there are distinct counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .numbering import in_ranges, numbered


def count_curve(counts: DataFrame, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """(keys, n, barcodes, rank_hi, cum): distinct counts in descending order with the last rank and the sum so far."""
    h = counts.groupBy(*keys, "n").agg(F.count("*").alias("barcodes"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"))
    total = Window.partitionBy(*keys)
    return h.select(*keys, "n", "barcodes", F.sum("barcodes").over(w).alias("rank_hi"), F.sum(F.col("n") * F.col("barcodes")).over(w).alias("cum"), F.sum(F.col("n") * F.col("barcodes")).over(total).alias("total"))


def rank_curve(counts: DataFrame, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """(keys, barcode, n, rank, fraction, cum_fraction), ties in order of barcodes.

    Barcodes are numbered over the whole table by sorted ranges, so that neither a sample nor the barcodes of one count are
    one task's; a rank is that number less the rows of the samples before. Sums come from the histogram. Barcodes without
    a count, or without a key, have no rank.
    """
    curve = count_curve(counts, keys)
    at = numbered(counts.select(*keys, "barcode", "n").dropna(subset=[*keys, "n"]), [*keys, F.desc("n"), "barcode"], "_at")
    first = at.groupBy(*keys).agg(F.min("_at").alias("_first"))
    rank = F.col("_at") - F.col("_first") + 1
    return at.join(first, [*keys]).join(curve, [*keys, "n"]).select(
        *keys, "barcode", "n", rank.alias("rank"), (F.col("n") / F.col("total")).alias("fraction"),
        ((F.col("cum") - F.col("n") * (F.col("rank_hi") - rank)) / F.col("total")).alias("cum_fraction"),
    )


def clean_curve(curve: DataFrame, x: str, y: str, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Points with finite coordinates above the cut-offs."""
    fine = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")) for c in (x, y)]
    return curve.filter(fine[0] & fine[1] & (F.col(x) > x0) & (F.col(y) > y0))


def kneedle(curve: DataFrame, x: str, y: str, keys: tuple[str, ...] = ("sample",), x_limit: float | None = None) -> DataFrame:
    """(keys, knee): the x with the largest distance of normalised y over normalised x; the smaller x of ties."""
    c = curve if x_limit is None else curve.filter(F.col(x) <= x_limit)
    span = c.groupBy(*keys).agg(*[f(v).cast("double").alias(f"_{n}{i}") for i, v in (("x", x), ("y", y)) for n, f in (("lo", F.min), ("hi", F.max))])
    norm = lambda v, i: (F.col(v) - F.col(f"_lo{i}")) / F.when(F.col(f"_hi{i}") > F.col(f"_lo{i}"), F.col(f"_hi{i}") - F.col(f"_lo{i}")).otherwise(1.0)
    far = c.join(F.broadcast(span), [*keys]).withColumn("_d", norm(y, "y") - norm(x, "x"))  # one row per sample
    return far.groupBy(*keys).agg(F.max_by(x, F.struct("_d", -F.col(x))).alias("knee"))


def kneedle_recall(curve: DataFrame, x: str, y: str, keys: tuple[str, ...] = ("sample",), limit: float = 50_000, factor: float = 12.5) -> DataFrame:
    """The knee; for samples of fewer ranks than limit, the knee of the curve up to factor times the first knee."""
    first = kneedle(curve, x, y, keys)
    size = curve.groupBy(*keys).agg(F.max(x).alias("_size"))
    again = curve.join(F.broadcast(first.join(size, [*keys])), [*keys]).filter((F.col("_size") >= limit) | (F.col(x) <= factor * F.col("knee"))).drop("knee", "_size")
    return kneedle(again, x, y, keys)


def kneedle_loglog(curve: DataFrame, x: str, y: str, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """(keys, knee): the knee of the reversed log10-log10 curve."""
    c = clean_curve(curve, x, y).withColumn("_lx", F.log10(x)).withColumn("_ly", F.log10(y))
    top = c.groupBy(*keys).agg(F.max("_lx").alias("_tx"), F.max("_ly").alias("_ty"))
    back = c.join(F.broadcast(top), [*keys]).withColumn("_rx", F.col("_tx") - F.col("_lx")).withColumn("_ry", F.col("_ty") - F.col("_ly"))
    knee = kneedle(back, "_rx", "_ry", keys)
    return knee.join(F.broadcast(top), [*keys]).select(*keys, F.round(F.pow(F.lit(10.0), F.col("_tx") - F.col("knee"))).cast("long").alias("knee"))


def inflection(curve: DataFrame, x: str, y: str, bins: int = 50, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """(keys, inflection): the x of the steepest fall of log y over log x, on a curve thinned to log bins."""
    c = clean_curve(curve, x, y).withColumn("_lx", F.log10(x)).withColumn("_ly", F.log10(y))
    top = c.groupBy(*keys).agg(F.max("_lx").alias("_tx"))
    binned = c.join(F.broadcast(top), [*keys]).groupBy(*keys, F.floor(F.col("_lx") / F.greatest(F.col("_tx"), F.lit(1e-9)) * bins).alias("_b")).agg(F.avg("_lx").alias("_lx"), F.avg("_ly").alias("_ly"))
    w = Window.partitionBy(*keys).orderBy("_b")
    slope = (F.lead("_ly").over(w) - F.lag("_ly").over(w)) / (F.lead("_lx").over(w) - F.lag("_lx").over(w))
    return binned.withColumn("_s", slope).filter("_s is not null").groupBy(*keys).agg(F.round(F.pow(F.lit(10.0), F.min_by("_lx", F.struct("_s", "_b")))).cast("long").alias("inflection"))


def cells_rna(ranked: DataFrame, knees: DataFrame, override: int | None = None, keys: tuple[str, ...] = ("sample",), floor: int = 250, ceiling: int = 20_000, most: int = 10_000) -> DataFrame:
    """Barcodes that are called cells (W7): the override, else the knee; at least floor, and a knee of over ceiling is
    taken for most. Where the knee failed (null, or no row), most barcodes are called. A sample that has fewer barcodes
    than that is called whole. An empty table stays empty."""
    size = ranked.groupBy(*keys).agg(F.count("*").alias("_size"))
    knee = F.lit(override) if override else F.when(F.col("knee").isNull() | (F.col("knee") > ceiling), most).otherwise(F.greatest(F.col("knee"), F.lit(floor)))
    take = size.join(knees, [*keys], "left").select(*keys, F.least(knee, F.col("_size")).alias("called"))
    return ranked.join(F.broadcast(take), [*keys]).filter(F.col("rank") <= F.col("called"))


def cells_atac(ranked: DataFrame, methods: list[DataFrame], override: int | None = None, loaded: int | None = None, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Called barcodes with the bead threshold (W8): of methods, each (keys, knee), the first that has a knee; at most
    twice the loaded cells. bead_threshold is the count at the last rank that is kept."""
    knee = methods[0].select(*keys, F.col("knee").alias("_k0"))
    for i, m in enumerate(methods[1:], 1):
        knee = knee.join(m.select(*keys, F.col("knee").alias(f"_k{i}")), [*keys], "full")
    best = F.lit(override) if override else F.coalesce(*[F.col(f"_k{i}") for i in range(len(methods))])
    best = F.least(best, F.lit(2 * loaded)) if loaded else best
    kept = ranked.join(F.broadcast(knee.select(*keys, best.alias("_called"))), [*keys]).filter(F.col("rank") <= F.col("_called")).drop("_called")
    return kept.join(F.broadcast(kept.groupBy(*keys).agg(F.min("n").alias("bead_threshold"))), [*keys])


def thin_curve(curve: DataFrame, x: str, y: str, n: int, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """About n points of a curve, even along its length, with the first and those of the last x.

    Points are taken in order of x and y, in sorted ranges: a range starts from the last point and the length of the ranges
    before it, so a sample is many tasks. Lengths are measured with x and y scaled to their spans, and rounded to 9 digits
    of the total, so that how points are dealt to ranges can't matter. Points with a null x or y are left out.
    """
    fine = curve.dropna(subset=[*keys, x, y])
    span = fine.groupBy(*keys).agg(*[F.greatest(F.max(c) - F.min(c), F.lit(1e-12)).alias(f"_s{i}") for i, c in enumerate((x, y))], F.max(x).alias("_end"))
    at = in_ranges(fine, [*keys, x, y], "_part")
    w, by_part = Window.partitionBy(*keys, "_part").orderBy(x, y), Window.partitionBy(*keys).orderBy("_part")
    point = F.struct(x, y)
    length = lambda a: F.sqrt(F.pow((F.col(x) - a[x]) / F.col("_s0"), 2) + F.pow((F.col(y) - a[y]) / F.col("_s1"), 2))
    edge = at.groupBy(*keys, "_part").agg(F.max(point).alias("_tail")).select(*keys, "_part", F.lag("_tail").over(by_part).alias("_from"))  # a row a range
    parts = at.join(edge, [*keys, "_part"]).join(span, [*keys]).withColumn("_step", F.coalesce(length(F.coalesce(F.lag(point).over(w), F.col("_from"))), F.lit(0.0)))
    sums = parts.groupBy(*keys, "_part").agg(F.sum("_step").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    starts = sums.select(*keys, "_part", before.alias("_before"))
    total = sums.groupBy(*keys).agg(F.sum("_sum").alias("_total"))
    along = F.col("_before") + F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    share = F.round(along / F.when(F.col("_total") > 0, F.col("_total")).otherwise(1.0), 9)
    placed = parts.join(starts, [*keys, "_part"]).join(total, [*keys]).withColumn("_bucket", F.floor(share * n))
    # the first point of a bucket: of a bucket over several ranges, the one of the first range
    row = F.row_number().over(Window.partitionBy(*keys, "_part", "_bucket").orderBy(x, y))
    firsts = placed.groupBy(*keys, "_bucket").agg(F.min("_part").alias("_first"))
    chosen = placed.withColumn("_row", row).filter((F.col("_row") == 1) | (F.col(x) == F.col("_end"))).join(firsts, [*keys, "_bucket"])
    return chosen.filter((F.col(x) == F.col("_end")) | (F.col("_part") == F.col("_first"))).select(*curve.columns)


def subsample(reads: DataFrame, fraction: float, name: str = "name") -> DataFrame:
    """Reads by a digest of their name, so mates stay together (W22). A read without a name is left out."""
    part = F.conv(F.substring(F.md5(F.col(name).cast("binary")), 1, 8), 16, 10).cast("long")
    return reads.filter(part % 1_000_000 < int(fraction * 1_000_000))


def top_k(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each key, or of the table if there is none."""
    if not keys:
        return df.orderBy(*order).limit(k)
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")
