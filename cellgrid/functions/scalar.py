"""Column functions: names, flags, positions, sizes and estimates. All but quality_cut stay in the JVM."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def _c(x: C) -> Column:
    return F.col(x) if isinstance(x, str) else x


# read names


def name_part(name: C, pos: int, sep: str = "_") -> Column:
    """The pos-th field (from 0) of a read name that carries barcode and UMI; null if there is none."""
    return F.get(F.split(_c(name), sep), pos)


def name_rest(name: C, drop: list[int], sep: str = "_") -> Column:
    """The read name without the fields at the given positions."""
    gone = F.array(*map(F.lit, drop))
    return F.array_join(F.filter(F.split(_c(name), sep), lambda x, i: ~F.array_contains(gone, i)), sep)


def index_of_name(name: C, k: int) -> Column:
    """The last k characters of a read name's first field: the plate index."""
    first = F.split(_c(name), "_")[0]
    return F.substring(first, F.greatest(F.length(first) - k + 1, F.lit(1)), F.lit(k))


# alignment flags


def has_flag(flag: C, bits: int) -> Column:
    return _c(flag).bitwiseAND(bits) == bits


def lacks_flag(flag: C, bits: int) -> Column:
    return _c(flag).bitwiseAND(bits) == 0


def is_primary(flag: C) -> Column:
    return lacks_flag(flag, 0x900)


def is_proper_pair(flag: C) -> Column:
    return has_flag(flag, 0x3) & lacks_flag(flag, 0xC)


# fragments of read pairs


def orientation(rev1: C, rev2: C, mapq1: C, mapq2: C, least: int = 30) -> Column:
    """r1r2 if the first mate is the forward one, r2r1 if the second is; null for pairs to leave out."""
    fine = F.least(_c(mapq1), _c(mapq2)) >= least
    return F.when(fine & ~_c(rev1) & _c(rev2), "r1r2").when(fine & _c(rev1) & ~_c(rev2), "r2r1")


def shift_cut(pos: C, forward: C, length: C, plus: int = 4, minus: int = 5) -> Column:
    """A transposase shift of both ends in the fragment's direction, clipped to the contig."""
    return F.least(F.greatest(_c(pos) + F.when(_c(forward), plus).otherwise(-minus), F.lit(0)), _c(length))


# Droplet names


def beads_in_drop(cell: C) -> Column:
    """The count after the last N of a droplet name; a name without one has a single bead."""
    n = F.regexp_extract(_c(cell), r"N(\d+)$", 1)
    return F.when(n == "", 1).otherwise(n.cast("int"))


def cell_name(sample: C, number: C, width: int, n: C) -> Column:
    return F.concat(F.translate(_c(sample), "-_", ""), F.lit("BC"), F.lpad(_c(number).cast("string"), width, "0"), F.lit("N"), _c(n).cast("string"))


def repad(name: C, width: int) -> Column:
    """A droplet name with its number padded to another width."""
    head, number, tail = (F.regexp_extract(_c(name), r"^(.*BC)0*(\d+)(N\d+)$", i) for i in (1, 2, 3))
    return F.when(head != "", F.concat(head, F.lpad(number, width, "0"), tail)).otherwise(_c(name))


# edges


def canonical_edge(bead1: C, umi1: C, bead2: C, umi2: C) -> Column:
    """The edge as a struct with its smaller (bead, UMI) end first."""
    a, b = F.struct(_c(bead1).alias("bead"), _c(umi1).alias("umi")), F.struct(_c(bead2).alias("bead"), _c(umi2).alias("umi"))
    lo, hi = F.least(a, b), F.greatest(a, b)
    return F.struct(lo["bead"].alias("bead1"), lo["umi"].alias("umi1"), hi["bead"].alias("bead2"), hi["umi"].alias("umi2"))


# genes of reads


def assign_feature(tag: C, introns: bool = False, sep: str = ",") -> Column:
    """One gene and feature class for a read whose tag lists `gene_CLASS` hits; struct (gene, feature, hits).

    Of several hits, intronic ones count only on request. Hits of one gene are that gene's: its one class besides introns, or
    UTR if it has both. Of several genes, the one with the only exon hit has priority; otherwise, and if no hit is left, the
    read is ambiguous. A single hit names its gene; an intronic one names INTRON unless introns are asked for, and any
    other tag (INTERGENIC) is returned as it is, both without a feature. The class is what stands after the last
    underscore, so gene ids may hold underscores. A null tag gives nulls and no hits.
    """
    tag = _c(tag)
    kind = lambda x: F.when(x.endswith("_EXON"), "EXON").when(x.endswith("_UTR"), "UTR").when(x.endswith("_INTRON"), "INTRON").otherwise("")
    gene_of = lambda x: F.when(kind(x) == "", x).otherwise(F.substring(x, F.lit(1), F.length(x) - F.length(kind(x)) - 1))
    # an array of one, so that what is made of x is made once
    bound = lambda x, f: F.transform(F.array(x), f)[0]
    result = lambda gene, feature, hits: F.struct(gene.alias("gene"), feature.alias("feature"), hits.cast("int").alias("hits"))

    def parts(used):
        strong = F.filter(used, lambda x: x["kind"] != "INTRON") if introns else used
        return F.struct(used.alias("used"), F.array_distinct(F.transform(used, lambda x: x["gene"])).alias("genes"), F.filter(used, lambda x: x["kind"] == "EXON").alias("exons"), strong.alias("strong"))

    def of_several(p):
        one = F.size(p["genes"]) == 1
        first = F.when((F.size(p["genes"]) > 1) & (F.size(p["exons"]) == 1), p["exons"][0]).when(one, F.when(F.size(p["used"]) > 1, p["strong"][0]).otherwise(p["used"][0]))
        feature = F.when(one & (F.size(p["strong"]) > 1), "UTR").otherwise(F.when(first["kind"] != "", first["kind"]))
        return result(F.coalesce(first["gene"], F.lit("Unassigned_Ambiguous")), feature, F.size(p["genes"]))

    items = F.transform(F.array_distinct(F.split(tag, sep)), lambda x: F.struct(gene_of(x).alias("gene"), kind(x).alias("kind")))
    used = items if introns else F.filter(items, lambda x: x["kind"] != "INTRON")
    known = kind(tag).isin("EXON", "UTR", "INTRON") if introns else kind(tag).isin("EXON", "UTR")
    single = result(F.when(known, gene_of(tag)).when(kind(tag) == "INTRON", "INTRON").otherwise(tag), F.when(known, kind(tag)), known & tag.isNotNull())
    return F.when(F.size(F.split(tag, sep)) > 1, bound(bound(used, parts), of_several)).otherwise(single)


def assignment(gene: C, status: C) -> Column:
    """The gene tag, or why there is none."""
    return F.coalesce(_c(gene), _c(status))


def species_of_contig(contig: C) -> Column:
    """What stands before the first dot of a contig that carries its species; null if there is no dot."""
    return F.when(F.instr(_c(contig), ".") > 0, F.substring_index(_c(contig), ".", 1))


def species_of_gene(gene: C) -> Column:
    """ENSG and ENST ids are human; other Ensembl ids carry a species code after ENS."""
    code = F.regexp_extract(_c(gene), r"^ENS([A-Z]{3})?[GTP]\d", 1)
    return F.when(_c(gene).rlike(r"^ENS[GTP]\d"), "HSA").when(code != "", code)


# Library estimates


def duplicate_rate(total: C, unique: C, digits: int = 3) -> Column:
    return F.round(F.when(_c(total) > 0, (_c(total) - _c(unique)) / _c(total)).otherwise(0.0), digits)


def library_size(total: C, unique: C) -> Column:
    """The number of distinct molecules x for which unique / x = 1 - exp(-total / x); null without duplicates.

    The root, as a multiple of unique, is bracketed by tenfold steps and halved 41 times, inside one expression.
    """
    n, c = _c(total).cast("double"), _c(unique).cast("double")
    f = lambda x: c / x - 1 + F.exp(-n / x)
    top = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(100.0), lambda hi, _: F.when(f(hi * c) > 0, hi * 10).otherwise(hi))
    half = lambda s: (s["lo"] + s["hi"]) / 2
    pick = lambda s: F.struct(F.when(f(half(s) * c) > 0, half(s)).otherwise(s["lo"]).alias("lo"), F.when(f(half(s) * c) > 0, s["hi"]).otherwise(half(s)).alias("hi"))
    root = F.aggregate(F.sequence(F.lit(0), F.lit(40)), F.struct(F.lit(1.0).alias("lo"), top.alias("hi")), lambda s, _: pick(s), half)
    return F.when((c > 0) & (c < n), F.bround(c * root).cast("long"))


def zero_truncated_poisson(k: C, rate: C) -> Column:
    """P(k | k > 0); factorials as sums of logarithms."""
    r, k = _c(rate).cast("double"), _c(k).cast("int")
    return F.exp(k * F.log(r) - F.aggregate(F.sequence(F.lit(1), k), F.lit(0.0), lambda a, i: a + F.log(i.cast("double")))) / (F.exp(r) - 1)


# Cut sites


def round_site(pos: C, digits: int) -> Column:
    """Position rounded to 10**digits, half to even."""
    return F.bround(_c(pos), -digits) if digits else _c(pos)


def cut_sites(start: C, stop: C, method: str) -> Column:
    """The sites (side, pos) that the merge method r1, r2 or both compares, as an array to explode."""
    sites = {"r1": [("start", start)], "r2": [("stop", stop)], "both": [("start", start), ("stop", stop)]}[method]
    return F.array(*[F.struct(F.lit(side).alias("side"), _c(x).alias("pos")) for side, x in sites])


# Tags and reads


def clean_label(label: C) -> Column:
    """A label in which all but letters, digits and dots has become single dots."""
    return F.regexp_replace(F.regexp_replace(F.trim(_c(label)), r"[^A-Za-z0-9.]+", "."), r"\.+$", "")


def is_sequence(x: C) -> Column:
    return _c(x).rlike("^[ATCGatcg]+$")


def mismatches(seq: C) -> Column:
    """All sequences one substitution away, as an array of structs (seq, pos, base)."""
    s = _c(seq)
    at = lambda i: F.transform(F.filter(F.array(*map(F.lit, "ACGT")), lambda b: b != F.substring(s, i, F.lit(1))), lambda b: F.struct(F.overlay(s, b, i).alias("seq"), i.alias("pos"), b.alias("base")))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(s)), at))


def crop(seq: C, five: int, three: int) -> Column:
    """A read without its first five and last three bases."""
    s = _c(seq)
    return F.substring(s, F.lit(five + 1), F.greatest(F.length(s) - five - three, F.lit(0)))


def trim_adapter(seq: C, adapter: str, overlap: int = 5, rounds: int = 4) -> Column:
    """A read without exact copies of the adapter, or its last bases, at the 5' end."""
    tails = "|".join(adapter[i:] for i in range(len(adapter) - overlap + 1))
    return F.regexp_replace(_c(seq), f"^(?:{tails}){{1,{rounds}}}", "")


def quality_cut(qual: C, cutoff: int = 20) -> Column:
    """How many bases stay when the 3' end is trimmed where the sum of (cutoff - quality) from the end is largest.

    Sums are taken from the end over arrays of codes, so the work grows with the length. Of equal sums the longer read
    stays; an empty read keeps 0 bases, a null one null.
    """

    def keep(q: str | None) -> int | None:
        if not q:
            return None if q is None else 0
        s = np.cumsum(cutoff + 33 - np.frombuffer(q.encode("utf-32-le"), np.int32)[::-1].astype(np.int64))
        s = s[: np.argmax(s < 0)] if (s < 0).any() else s
        best = int(np.argmax(s)) if len(s) else 0
        return len(q) - (best + 1 if len(s) and s[best] > 0 else 0)

    @F.pandas_udf("int")
    def cut(quals: pd.Series) -> pd.Series:
        return pd.Series([keep(q) for q in quals], dtype="Int32")

    return cut(_c(qual))


# F23-F25


def signif(x: C, digits: int) -> Column:
    """x to so many significant digits."""
    v = _c(x).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(float(digits - 1)) - F.floor(F.log10(F.abs(v))))
    return F.when(v == 0, 0.0).otherwise(F.round(v * scale) / scale)


def cell_type(share: C, threshold: float = 0.9) -> Column:
    """species2, mixed or species1 by the share of species 1; intervals are closed on the right."""
    return F.when(_c(share) <= round(1 - threshold, 10), "species2").when(_c(share) <= threshold, "mixed").otherwise("species1")


def odd_below(n: C) -> Column:
    """n, or n - 1 if n is even: a k-mer length."""
    return _c(n) - F.when(_c(n) % 2 == 0, 1).otherwise(0)
