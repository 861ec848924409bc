"""Registered queries of the single-cell operators, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import adt, atac, barcodes, checks, edges, merge_atac, metrics, ml, ranges, rna
from ..operators.graph import Saved, checkpoint
from . import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


SIZES = "sizes AS (SELECT unnest(['AF', 'AO', 'NF', 'NO', 'RF', 'RO']) AS chr, (SELECT max(l_partkey) * 100 + 100 FROM lineitem) AS length)"


def sizes(spark, d) -> DataFrame:
    top = A.table(spark, d, "lineitem").agg((F.max("l_partkey") * 100 + 100).alias("length"))
    return top.select(F.explode(F.array(*map(F.lit, A.CHRS))).alias("chr"), "length")


# merging of ATAC beads

_SITES = f"""WITH {A.FRAG}, nc AS (SELECT *, count(*) OVER (PARTITION BY chr, start, stop) AS n_rows FROM frag QUALIFY n_rows <= 6),
s AS (SELECT chr, 'start' AS side, start AS pos, bead, count(*) AS k FROM nc GROUP BY ALL UNION ALL SELECT chr, 'stop', stop, bead, count(*) FROM nc GROUP BY ALL),
p AS (SELECT a.bead AS barc1, b.bead AS barc2, sum(a.k * b.k)::BIGINT AS n_both FROM s a JOIN s b USING (chr, side, pos) WHERE a.bead > b.bead GROUP BY ALL HAVING n_both >= 4),
c AS (SELECT bead, count(*) AS n FROM nc GROUP BY bead),
j AS (SELECT barc1, barc2, n_both, 2 * x.n AS n_barc1, 2 * y.n AS n_barc2, round(n_both / (2 * x.n + 2 * y.n - n_both + 0.05::DOUBLE), 5) AS jaccard_frag
  FROM p JOIN c x ON barc1 = x.bead JOIN c y ON barc2 = y.bead)"""


@query(_SITES + " SELECT * FROM j WHERE jaccard_frag > 0")
def bead_pair_jaccard(spark, d):
    return merge_atac.bead_pair_jaccard(A.frag(spark, d)).select("barc1", "barc2", "n_both", "n_barc1", "n_barc2", "jaccard_frag")


@query(f"WITH {A.FRAG} SELECT *, count(*) OVER (PARTITION BY chr, start, stop) AS n_rows FROM frag QUALIFY n_rows <= 6")
def nc_filter(spark, d):
    return merge_atac.nc_filter(A.frag(spark, d))


@query(_SITES + " SELECT * FROM p")
def pair_counts(spark, d):
    clean = Saved(spark)(merge_atac.cleaned(A.frag(spark, d)))
    return merge_atac.pair_counts(merge_atac.site_pairs(merge_atac.sites(clean)))


@query(f"WITH {A.FRAG} SELECT chr, 'start' AS side, round_even(start, -3)::BIGINT AS pos, bead FROM frag")
def rounded_sites(spark, d):
    return merge_atac.sites(A.frag(spark, d), "r1", 3)


@query(f"WITH {A.FRAG} SELECT mode AS mode FROM (SELECT support AS mode, count(*) AS n FROM frag GROUP BY 1 ORDER BY n DESC, mode LIMIT 1)")
def mode_of_support(spark, d):
    return merge_atac.mode(A.frag(spark, d), "support")


def _merged(spark, d):
    saved = Saved(spark)
    clean = saved(merge_atac.cleaned(A.frag(spark, d)))
    # both are read by every round of the merge
    pairs, counts = saved(merge_atac.scored(clean)), saved(merge_atac.bead_counts(clean))
    saved.drop(1)
    cut = pairs.agg(F.percentile("jaccard_frag", F.lit(0.99))).first()[0] or 0.0
    return merge_atac.merge_by_jaccard(counts, pairs, cut), pairs, counts, cut


@query()
def merge_by_jaccard(spark, d):
    return _merged(spark, d)[0]


@query()
def merged_cell_names(spark, d):
    return merge_atac.number_cells(_merged(spark, d)[0], "Demo_S1")


@query()
def deconvolution_metrics(spark, d):
    merged, pairs, counts, cut = _merged(spark, d)
    return merge_atac.deconvolution_metrics(pairs, cut, merged, counts)


@query()
def jaccard_density(spark, d):
    return merge_atac.density(merge_atac.bead_pair_jaccard(A.frag(spark, d)), "jaccard_frag")


@query()
def density_threshold(spark, d):
    t = merge_atac.density_threshold(jaccard_density(spark, d))
    return t.select(F.round("raw", 9).alias("raw"), F.round("safe", 9).alias("safe"))


@query(f"WITH {A.FRAG} SELECT DISTINCT bead, bead AS droplet, 1::BIGINT AS n_beads FROM frag")
def merge_none(spark, d):
    return merge_atac.merge_none(A.frag(spark, d))


# intervals

_OVER = "JOIN peaks p ON f.chr = p.chr AND f.start < p.stop AND p.start < f.stop"


@query(f"WITH {A.CELL_FRAG}, {A.PEAKS} SELECT p.name AS peak, cell, count(*) AS n FROM cell_frag f {_OVER} GROUP BY ALL")
def peak_matrix(spark, d):
    return ranges.peak_matrix(A.peaks(spark, d), A.cell_frag(spark, d))


@query(f"WITH {A.CELL_FRAG}, {A.PEAKS} SELECT p.name AS peak, cell, count(*) AS n FROM cell_frag f {_OVER} WHERE f.start >= p.start OR f.stop <= p.stop GROUP BY ALL")
def peak_matrix_ends_only(spark, d):
    return ranges.peak_matrix(A.peaks(spark, d), A.cell_frag(spark, d), ends_only=True)


@query(f"WITH {A.FRAG}, {A.PEAKS} SELECT f.*, p.name AS r_name, p.score AS r_score, p.start AS r_start, p.stop AS r_stop FROM frag f JOIN peaks p ON f.chr = p.chr AND f.start <= p.stop AND p.start <= f.stop")
def overlap_join_closed(spark, d):
    return ranges.overlap_join(A.frag(spark, d), A.peaks(spark, d), closed=True)


@query(f"WITH {A.CELL_FRAG}, {A.PEAKS} SELECT * FROM cell_frag f WHERE NOT EXISTS (SELECT 1 FROM peaks p WHERE f.chr = p.chr AND f.start < p.stop AND p.start < f.stop)")
def drop_blocklisted(spark, d):
    return ranges.drop_blocklisted(A.cell_frag(spark, d), A.peaks(spark, d))


@query(f"""WITH {A.CELL_FRAG}, {A.PEAKS}, i AS (SELECT DISTINCT chr, start, stop, cell FROM cell_frag),
h AS (SELECT cell, count(*) AS in_peaks FROM i f WHERE EXISTS (SELECT 1 FROM peaks p WHERE f.chr = p.chr AND f.start < p.stop AND p.start < f.stop) GROUP BY cell)
SELECT cell, count(*) AS total, coalesce(any_value(in_peaks), 0) AS in_peaks, coalesce(any_value(in_peaks), 0) / count(*) AS frip FROM i LEFT JOIN h USING (cell) GROUP BY cell""")
def frip_by_cell(spark, d):
    return ranges.frip_by_cell(A.peaks(spark, d), A.cell_frag(spark, d))


@query(f"WITH {A.FRAG}, {A.PEAKS} SELECT floor(100 * count(*) FILTER (EXISTS (SELECT 1 FROM peaks p WHERE f.chr = p.chr AND f.start < p.stop AND p.start < f.stop)) / count(*)) / 100 AS frip FROM frag f")
def sample_frip(spark, d):
    return ranges.share_in(A.frag(spark, d), A.peaks(spark, d), 2, "frip")


@query(f"WITH {A.CELL_FRAG}, e AS (SELECT chr, cell, unnest([start, stop - 1]) AS pos FROM cell_frag) SELECT chr, pos // 500 * 500 AS tile, cell, count(*) AS n FROM e GROUP BY ALL")
def tile_matrix(spark, d):
    return ranges.tile_matrix(A.cell_frag(spark, d))


_ISLANDS = "SELECT *, sum(CASE WHEN start <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY chr ORDER BY start, stop) AS island FROM (SELECT *, max(stop) OVER (PARTITION BY chr ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM peaks)"


@query(f"WITH {A.PEAKS} SELECT chr, min(start) AS start, max(stop) AS stop, count(*) AS n FROM ({_ISLANDS}) GROUP BY chr, island")
def merge_intervals(spark, d):
    return ranges.merge_intervals(A.peaks(spark, d), ["chr"])


_MERGED = f"m AS (SELECT chr, min(start) AS start, max(stop) AS stop FROM ({_ISLANDS}) GROUP BY chr, island)"


@query(f"""WITH {A.PEAKS}, {_MERGED}, {SIZES}, g AS (SELECT chr, 0 AS stop FROM sizes UNION ALL SELECT chr, stop FROM m)
SELECT chr, start, stop FROM (SELECT g.chr, greatest(g.stop, 0)::BIGINT AS start, coalesce((SELECT min(m.start) FROM m WHERE m.chr = g.chr AND m.start >= g.stop), length)::BIGINT AS stop FROM g JOIN sizes USING (chr)) WHERE stop > start""")
def complement_intervals(spark, d):
    return ranges.complement_intervals(A.peaks(spark, d), sizes(spark, d), ["chr"])


@query()
def subtract_intervals(spark, d):
    return ranges.subtract_intervals(A.frag(spark, d), A.peaks(spark, d), ["chr"])


def _tss(spark, d, half=200):
    p = A.peaks(spark, d).select("chr", ((F.col("start") + F.col("stop")) / 2).cast("long").alias("pos"))
    return ranges.slop(p, half, sizes(spark, d))


@query(f"WITH {A.PEAKS}, {SIZES} SELECT DISTINCT p.chr, (start + stop) // 2 - 200 AS start, (start + stop) // 2 + 201 AS stop FROM peaks p JOIN sizes s ON p.chr = s.chr WHERE (start + stop) // 2 >= 200 AND (start + stop) // 2 + 201 <= length")
def tss_windows(spark, d):
    return _tss(spark, d)


_DEPTH = f"""WITH {A.FRAG}, {A.PEAKS}, {SIZES}, w AS (SELECT DISTINCT p.chr, (start + stop) // 2 - 200 AS a, (start + stop) // 2 + 201 AS b FROM peaks p JOIN sizes s ON p.chr = s.chr
  WHERE (start + stop) // 2 >= 200 AND (start + stop) // 2 + 201 <= length),
e AS (SELECT greatest(start - a, 0) AS lo, least(stop, b) - a AS hi FROM frag f JOIN w ON f.chr = w.chr AND start < b AND a < stop),
v AS (SELECT unnest([lo, hi]) AS "offset", unnest([1, -1]) AS x FROM e),
p AS (SELECT "offset", (sum(sum(x)) OVER (ORDER BY "offset"))::BIGINT AS depth FROM v GROUP BY "offset")"""


@query(_DEPTH + ' SELECT "offset", depth FROM p')
def tss_profile(spark, d):
    return ranges.tss_profile(A.frag(spark, d), _tss(spark, d))


@query(_DEPTH + """, a AS (SELECT o, coalesce((SELECT arg_max(depth, "offset") FROM p WHERE "offset" <= o), 0) AS depth FROM range(401) t(o))
SELECT max(depth) / avg(depth) FILTER (o < 100 OR o >= 301) AS tss_score FROM a""")
def tss_enrichment(spark, d):
    return ranges.tss_enrichment(tss_profile(spark, d), 401)


@query()
def clean_peaks(spark, d):
    p = A.peaks(spark, d).select("chr", ((F.col("start") + F.col("stop")) / 2).cast("long").alias("pos"), "name", "score")
    block = A.peaks(spark, d).filter("score > 1400").select("chr", (F.col("start") + 200).alias("start"), "stop")
    return ranges.clean_peaks(p, block, sizes(spark, d))


@query(f"""WITH {A.CELL_FRAG}, {A.PEAKS}, x AS (SELECT read_name, name FROM (SELECT *, CASE WHEN support % 2 = 0 THEN '+' ELSE '-' END AS strand FROM cell_frag) f
  JOIN (SELECT *, CASE WHEN score > 1000 THEN '+' ELSE '-' END AS ps, start AS a, stop AS b FROM peaks) p ON f.chr = p.chr AND f.start < b AND a < f.stop AND strand = ps
  WHERE least(f.stop, b) - greatest(f.start, a) >= 0.8 * (f.stop - f.start))
SELECT read_name, string_agg(DISTINCT name, ',' ORDER BY name) AS features, count(DISTINCT name) AS hits FROM x GROUP BY 1""")
def assign_features(spark, d):
    r = A.cell_frag(spark, d).withColumn("strand", F.when(F.col("support") % 2 == 0, "+").otherwise("-"))
    return ranges.assign_features(r, A.peaks(spark, d).withColumn("strand", F.when(F.col("score") > 1000, "+").otherwise("-")))


# curves and cell calling

_RANKED = f"""WITH {A.BEAD_COUNTS}, r AS (SELECT *, row_number() OVER w AS rank, n / sum(n) OVER (PARTITION BY sample) AS fraction,
  sum(n) OVER (w ROWS UNBOUNDED PRECEDING) / sum(n) OVER (PARTITION BY sample) AS cum_fraction FROM bead_counts WINDOW w AS (PARTITION BY sample ORDER BY n DESC, barcode)),
z AS (SELECT *, (rank - min(rank) OVER s)::DOUBLE / (max(rank) OVER s - min(rank) OVER s) AS x, (cum_fraction - min(cum_fraction) OVER s) / (max(cum_fraction) OVER s - min(cum_fraction) OVER s) AS y FROM r WINDOW s AS (PARTITION BY sample)),
k AS (SELECT sample, arg_max(rank, round(y - x, 12) - rank * 1e-15) AS knee FROM z GROUP BY sample)"""


@query(_RANKED + " SELECT sample, barcode, n, rank, fraction, cum_fraction FROM r")
def rank_curve(spark, d):
    return barcodes.rank_curve(A.bead_counts(spark, d))


@query(_RANKED + " SELECT * FROM k")
def kneedle(spark, d):
    return barcodes.kneedle(barcodes.rank_curve(A.bead_counts(spark, d)), "rank", "cum_fraction")


@query(_RANKED + " SELECT r.sample, barcode, n, rank, fraction, cum_fraction, knee FROM r LEFT JOIN k USING (sample) WHERE rank <= CASE WHEN knee IS NULL OR knee > 20000 THEN 10000 ELSE greatest(knee, 250) END")
def cells_rna(spark, d):
    r = barcodes.rank_curve(A.bead_counts(spark, d))
    k = barcodes.kneedle(r, "rank", "cum_fraction")
    return barcodes.cells_rna(r, k).join(F.broadcast(k), "sample", "left").drop("called")  # a row per sample


@query()
def kneedle_recall(spark, d):
    return barcodes.kneedle_recall(barcodes.rank_curve(A.bead_counts(spark, d)), "rank", "cum_fraction")


@query()
def kneedle_loglog(spark, d):
    return barcodes.kneedle_loglog(barcodes.rank_curve(A.bead_counts(spark, d)), "rank", "n")


@query()
def inflection(spark, d):
    return barcodes.inflection(barcodes.rank_curve(A.bead_counts(spark, d)), "rank", "n")


@query(_RANKED + """, q AS (SELECT r.* FROM r JOIN k USING (sample) WHERE rank <= least(knee, 200)) SELECT sample, barcode, n, rank, fraction, cum_fraction, min(n) OVER (PARTITION BY sample) AS bead_threshold FROM q""")
def cells_atac(spark, d):
    r = barcodes.rank_curve(A.bead_counts(spark, d))
    none = barcodes.kneedle(r.limit(0), "rank", "cum_fraction")
    return barcodes.cells_atac(r, [none, barcodes.kneedle(r, "rank", "cum_fraction")], loaded=100)


@query(_RANKED + " SELECT sample, barcode, n, rank, fraction, cum_fraction FROM r WHERE n > 10 AND rank > 3")
def clean_curve(spark, d):
    return barcodes.clean_curve(barcodes.rank_curve(A.bead_counts(spark, d)), "rank", "n", 3, 10)


@query()
def thin_curve(spark, d):
    return barcodes.thin_curve(barcodes.rank_curve(A.bead_counts(spark, d)), "rank", "cum_fraction", 100)


@query(f"WITH {A.PAIRS} SELECT sample, barcode, n FROM ({_RANKED} SELECT sample, barcode, n, rank FROM r) WHERE rank <= 3")
def top_k(spark, d):
    return barcodes.top_k(A.bead_counts(spark, d), ["sample"], [F.desc("n"), "barcode"], 3)


@query()
def subsample(spark, d):
    return barcodes.subsample(A.pairs(spark, d), 0.1).select("name", "flag")


# edges

_CLEAN = f"WITH {A.EDGES}, {A.CANON}, clean AS (SELECT * FROM canon WHERE bead1 <> bead2 AND NOT contains(umi1, 'N') AND NOT contains(umi2, 'N'))"


@query(_CLEAN + " SELECT bead1, bead2, count(DISTINCT (umi1, umi2)) AS weight FROM clean GROUP BY ALL HAVING weight >= 3")
def edge_weights(spark, d):
    return edges.edge_weights(A.edges(spark, d))


@query(_CLEAN + """, n AS (SELECT *, count(*) AS k, NOT contains(umi1, 'N') AND NOT contains(umi2, 'N') AS clear FROM canon GROUP BY ALL)
SELECT sum(k)::BIGINT AS total, count(*) FILTER (clear) AS "unique", coalesce(sum(k) FILTER (NOT clear), 0)::BIGINT AS ambiguous, coalesce(sum(k - 1) FILTER (clear), 0)::BIGINT AS redundant FROM n""")
def edge_metadata(spark, d):
    return edges.edge_metadata(A.edges(spark, d))


@query()
def merge_beads(spark, d):
    li = A.table(spark, d, "lineitem")
    side = lambda i: li.select("l_orderkey", F.col("l_linenumber").alias(f"n{i}"), F.col("l_partkey").cast("string").alias(f"bead{i}"), F.lit("A").alias(f"umi{i}"))
    return edges.merge_beads(side(1).join(side(2), "l_orderkey").filter("n1 < n2").select(*edges.EDGE), 1)


@query()
def correct_edge_umis(spark, d):
    return edges.correct_edge_umis(A.edges(spark, d))


@query(f"WITH {A.EDGES}, ok AS (SELECT s_suppkey::VARCHAR AS bead FROM supplier WHERE s_acctbal > 0) SELECT * FROM edges WHERE bead1 IN (SELECT bead FROM ok) AND bead2 IN (SELECT bead FROM ok)")
def allow_edges(spark, d):
    ok = A.table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("bead"))
    return edges.allow(A.edges(spark, d), ok, ["bead1", "bead2"])


_MAP = "m AS (SELECT 'B' || s_suppkey AS bead, 'TestBC' || lpad((s_suppkey // 3)::VARCHAR, 4, '0') || 'N' || count(*) OVER (PARTITION BY s_suppkey // 3) AS cell FROM supplier WHERE s_acctbal > 0)"


def _map(spark, d):
    s = A.table(spark, d, "supplier").filter("s_acctbal > 0").select(F.concat(F.lit("B"), F.col("s_suppkey").cast("string")).alias("bead"), F.floor(F.col("s_suppkey") / 3).alias("g"))
    n = s.groupBy("g").agg(F.count("*").alias("n_beads"))
    return s.join(n, "g").select("bead", S.cell_name(F.lit("Test"), "g", 4, "n_beads").alias("cell"), "n_beads")


@query(f"WITH {_MAP} SELECT DISTINCT 'B' || l_suppkey AS bead FROM lineitem WHERE bead NOT IN (SELECT bead FROM m)")
def unmerged_beads(spark, d):
    return edges.unmerged_beads(A.reads(spark, d), _map(spark, d))


@query(f"WITH {_MAP} SELECT DISTINCT coalesce(m.bead, a.cell) AS bead FROM (SELECT cell FROM m WHERE bead LIKE '%1' UNION ALL SELECT 'B9999') a LEFT JOIN m USING (cell)")
def unmerge_allowlist(spark, d):
    m = _map(spark, d)
    return edges.unmerge(m.filter("bead like '%1'").select("cell").union(spark.range(1).select(F.lit("B9999"))), m)


@query(f"WITH {_MAP} SELECT DISTINCT cell, regexp_extract(cell, 'N(\\d+)$', 1)::INT AS beads_in_drop FROM m")
def beads_per_cell(spark, d):
    return edges.beads_per_cell(_map(spark, d))


@query(f"""WITH {_MAP}, b AS (SELECT DISTINCT 'B' || l_suppkey AS bead FROM lineitem), o AS (SELECT bead, regexp_extract(cell, 'BC0*(\\d+)N', 1)::BIGINT AS number, regexp_extract(cell, 'N(\\d+)$', 1)::BIGINT AS n FROM m),
u AS (SELECT bead, (SELECT max(number) FROM o) + row_number() OVER (ORDER BY bead) AS number, 1 AS n FROM b WHERE bead NOT IN (SELECT bead FROM m)), a AS (SELECT * FROM o UNION ALL SELECT * FROM u)
SELECT bead, 'TestBC' || lpad(number::VARCHAR, (SELECT length(max(number)::VARCHAR) FROM a)::INT, '0') || 'N' || n AS cell, n AS n_beads FROM a""")
def append_unmerged(spark, d):
    return edges.append_unmerged(_map(spark, d), A.reads(spark, d), "Test")


@query(f"""WITH {_MAP}, {A.READS}, c AS (SELECT bead, gene AS feature, count(*) AS n FROM reads WHERE gene IS NOT NULL GROUP BY ALL),
u AS (SELECT bead, 'TestSYN' || row_number() OVER (ORDER BY bead) AS cell FROM (SELECT DISTINCT bead FROM c WHERE bead NOT IN (SELECT bead FROM m)))
SELECT cell, feature, sum(n)::BIGINT AS n FROM c JOIN (SELECT bead, cell FROM m UNION ALL SELECT * FROM u) USING (bead) GROUP BY ALL""")
def map_with_synthetic(spark, d):
    c = A.reads(spark, d).filter("gene is not null").groupBy("bead", F.col("gene").alias("feature")).agg(F.count("*").alias("n"))
    return edges.map_with_synthetic(c, _map(spark, d), "Test")


@query(f"WITH {_MAP}, {A.READS} SELECT coalesce(m.cell, r.bead) AS cell, count(*) AS n FROM reads r LEFT JOIN m USING (bead) GROUP BY ALL")
def map_or_self(spark, d):
    return edges.map_or_self(A.reads(spark, d).drop("cell"), _map(spark, d)).groupBy("cell").agg(F.count("*").alias("n"))


# RNA


@query(f"WITH {A.READS} SELECT cell, count(*) AS reads, count(DISTINCT (contig, umi)) AS umis FROM reads GROUP BY cell")
def umi_counts(spark, d):
    return rna.umi_counts(A.reads(spark, d))


@query(f"WITH {A.READS} SELECT cell, count(DISTINCT (contig, umi)) AS genic_umis FROM reads WHERE gene IS NOT NULL GROUP BY cell")
def genic_umis(spark, d):
    return rna.genic_umis(A.reads(spark, d))


@query(f"WITH {A.CELL_GENE} SELECT cell, gene, n FROM cell_gene")
def umi_matrix(spark, d):
    return rna.umi_matrix(A.reads(spark, d))


_G = "gene IS NOT NULL"


@query(f"""WITH {A.READS} SELECT cell, count(*) AS input_reads, count(DISTINCT (contig, gene)) FILTER ({_G}) AS genes, count(DISTINCT (contig, gene, umi)) FILTER ({_G}) AS umi,
count(DISTINCT (contig, gene, umi)) FILTER (gene NOT IN ('INTRON', 'INTERGENIC')) AS transcripts, count(*) FILTER (gene NOT IN ('INTRON', 'INTERGENIC')) AS genic_reads,
count(*) FILTER (feature = 'EXON') AS coding_reads, count(*) FILTER (feature = 'UTR') AS utr_reads, count(*) FILTER (feature = 'INTRON') AS intronic_reads, count(*) FILTER (feature = 'INTERGENIC') AS intergenic_reads,
count(*) FILTER (ribosomal) AS rRNA_reads, count(*) FILTER (contig LIKE '%.MT' AND NOT ribosomal) AS mitochondrial_reads, count(*) FILTER (status = 'Unassigned_Ambiguity') AS unassigned_ambiguous_reads,
count(*) FILTER (status = 'Unassigned_MappingQuality') AS unassigned_low_mapping_qual_reads, 0::BIGINT AS unassigned_other_reads,
count(*) FILTER (contig LIKE 'hs.%') AS input_hs_reads, count(DISTINCT (contig, gene, umi)) FILTER ({_G} AND contig LIKE 'hs.%') AS hs_umi,
count(*) FILTER (contig LIKE 'mm.%') AS input_mm_reads, count(DISTINCT (contig, gene, umi)) FILTER ({_G} AND contig LIKE 'mm.%') AS mm_umi FROM reads GROUP BY cell""")
def expression_summary(spark, d):
    return rna.expression_summary(A.reads(spark, d), species=["hs", "mm"])


@query(f"WITH {_MAP}, {A.READS}, u AS (SELECT bead, gene, count(*) AS n FROM reads WHERE {_G} GROUP BY ALL) SELECT coalesce(m.cell, u.bead) AS cell, gene, sum(n)::BIGINT AS n FROM u LEFT JOIN m USING (bead) GROUP BY ALL")
def duplicate_counts(spark, d):
    dups = A.reads(spark, d).filter("gene is not null").groupBy("bead", "gene").agg(F.count("*").alias("n"))
    return rna.duplicate_counts(dups, _map(spark, d))


@query(f"WITH {A.CELL_GENE} SELECT max(n) AS largest, max(n) <= 1 AS \"binary\" FROM cell_gene")
def binary_matrix_guard(spark, d):
    return rna.is_binary(A.cell_gene(spark, d))


@query(f"WITH {A.CELL_GENE}, c AS (SELECT cell, count(*) AS f, sum(n) AS u FROM cell_gene GROUP BY cell) SELECT count(*) AS cells, median(f) AS median_features, sum(u)::BIGINT AS umis, median(u)::DOUBLE AS median_umis, (SELECT count(DISTINCT gene) FROM cell_gene) AS features FROM c")
def matrix_features(spark, d):
    return rna.matrix_features(A.cell_gene(spark, d))


@query(f"WITH {A.READS} SELECT gene, " + ", ".join(f"count(*) FILTER (contig LIKE '{s}.%') AS {s}" for s in ("hs", "mm")) + f" FROM reads WHERE {_G} GROUP BY gene")
def gene_table(spark, d):
    c = A.reads(spark, d).filter("gene is not null").groupBy("gene", S.species_of_contig("contig").alias("sample")).agg(F.count("*").alias("n"))
    return rna.gene_table(c, ["hs", "mm"])


@query(f"WITH {A.READS}, a AS (SELECT cell AS barcode, count(*) AS n FROM reads WHERE status = 'Assigned' GROUP BY 1), u AS (SELECT cell AS barcode, count(*) AS n FROM reads WHERE status <> 'Assigned' GROUP BY 1) SELECT barcode, a.n AS alignedReads, u.n AS unalignedReads FROM a FULL JOIN u USING (barcode)")
def combine_counts(spark, d):
    r = A.reads(spark, d)
    n = lambda c: r.filter(c).groupBy(F.col("cell").alias("barcode")).agg(F.count("*").alias("n"))
    return rna.combine_counts(n("status = 'Assigned'"), n("status <> 'Assigned'"))


@query(f"""WITH {_MAP}, {A.READS}, b AS (SELECT bead, count(*) AS reads, count(DISTINCT (contig, umi)) AS umis FROM reads GROUP BY bead),
r AS (SELECT *, coalesce(m.cell, reads.bead) AS drop FROM reads LEFT JOIN (SELECT bead, cell FROM m) m ON m.bead = reads.bead), c AS (SELECT drop, count(*) AS reads, count(DISTINCT (contig, umi)) AS umis FROM r GROUP BY drop)
SELECT b.bead, coalesce(m.cell, b.bead) AS cell, b.reads AS reads_bead, b.umis AS umis_bead, c.reads AS reads_cell, c.umis AS umis_cell, b.reads AS "alignedReads", NULL::BIGINT AS "unalignedReads",
  coalesce(regexp_extract(m.cell, 'N(\\d+)$', 1)::BIGINT, 1) AS n_beads, coalesce(m.cell, b.bead) LIKE 'Test%' AS above_knee FROM b LEFT JOIN m ON b.bead = m.bead LEFT JOIN c ON c.drop = coalesce(m.cell, b.bead)""")
def bead_summary(spark, d):
    m, r = _map(spark, d), A.reads(spark, d).drop("cell")
    bead = rna.umi_counts(r, "bead")
    cell = rna.umi_counts(edges.map_or_self(r, m))
    counts = bead.select(F.col("bead").alias("barcode"), F.col("reads").alias("alignedReads"), F.lit(None).cast("long").alias("unalignedReads"))
    out = rna.bead_summary(counts, m.select("cell"), cell, bead, m, ["reads", "umis"])
    return out.select("bead", "cell", "reads_bead", "umis_bead", "reads_cell", "umis_cell", "alignedReads", "unalignedReads", "n_beads", "above_knee")


@query(f"WITH {_MAP} SELECT count(DISTINCT cell) AS cells, count(DISTINCT cell) FILTER (cell NOT LIKE '%N1') AS multi_bead_cells, round(100 * count(DISTINCT cell) FILTER (cell NOT LIKE '%N1') / count(DISTINCT cell), 2) AS percent FROM m")
def bead_merge_stats(spark, d):
    return rna.bead_merge_stats(_map(spark, d))


@query(f"""WITH {A.READS}, e AS (SELECT cell, count(*) AS input_reads, count(*) FILTER (feature = 'EXON') AS coding_reads, count(*) FILTER (feature = 'UTR') AS utr_reads, cell LIKE '1%' AS i FROM reads GROUP BY cell),
t AS (SELECT unnest(['input_reads', 'coding_reads', 'utr_reads']) AS metric, unnest([sum(input_reads), sum(coding_reads), sum(utr_reads)])::BIGINT AS total, unnest([sum(input_reads) FILTER (i), sum(coding_reads) FILTER (i), sum(utr_reads) FILTER (i)]) AS x, sum(input_reads) AS s FROM e)
SELECT metric, total, 100 * total / s::DOUBLE AS percent_of_reads, x / total AS fraction_in_cells FROM t""")
def expr_metrics(spark, d):
    e = rna.expression_summary(A.reads(spark, d))
    return rna.expr_metrics(e, e.filter("cell like '1%'").select("cell"), ["input_reads", "coding_reads", "utr_reads"])


@query(f"WITH {_MAP}, c AS (SELECT DISTINCT cell, regexp_extract(cell, 'N(\\d+)$', 1)::BIGINT AS n FROM m) SELECT avg(n) AS mean_beads, sum(n) / 100000 AS beads_per_droplet FROM c")
def lambdas(spark, d):
    return rna.lambdas(_map(spark, d))


@query(f"""WITH {_MAP}, c AS (SELECT DISTINCT cell, regexp_extract(cell, 'N(\\d+)$', 1)::INT AS n FROM m), k AS (SELECT unnest(range(1, 9))::INT AS n_beads),
p AS (SELECT n_beads, exp(n_beads * ln(3.0::DOUBLE) - ln(factorial(n_beads))) / (exp(3.0::DOUBLE) - 1) AS p FROM k)
SELECT n_beads, (SELECT count(*) FROM c WHERE least(n, 8) = n_beads) AS observed, round((SELECT count(*) FROM c) * CASE WHEN n_beads < 8 THEN p ELSE 1 - (SELECT sum(p) FROM p WHERE n_beads < 8) END, 6) AS expected FROM p""")
def bead_histogram(spark, d):
    return rna.bead_histogram(_map(spark, d)).withColumn("expected", F.round("expected", 6))


@query(f"WITH {A.READS} SELECT cell, gene, umi, arg_min(name, (-mapq, name)) AS name, max(mapq) AS mapq, count(*) AS copies FROM reads GROUP BY ALL")
def dedup_umis(spark, d):
    return rna.dedup_umis(A.reads(spark, d))


def _read_pairs(spark, d):
    li = A.table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("barcode"), F.col("l_returnflag").alias("contig"), F.floor(F.col("l_partkey") / 10).alias("pos1"), F.col("l_quantity").cast("long").alias("pos2"), F.lit("+").alias("strand1"), F.lit("-").alias("strand2"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("name"), F.floor("l_extendedprice").alias("base_sum"))


@query("""WITH p AS (SELECT l_suppkey AS barcode, l_returnflag AS contig, l_partkey // 10 AS pos1, l_quantity::BIGINT AS pos2, '+' AS strand1, '-' AS strand2, l_orderkey || '_' || l_linenumber AS name, floor(l_extendedprice)::BIGINT AS base_sum FROM lineitem)
SELECT *, count(*) OVER w AS set_size, row_number() OVER (w ORDER BY base_sum DESC, name) > 1 AS duplicate FROM p WINDOW w AS (PARTITION BY barcode, contig, pos1, pos2, strand1, strand2)""")
def mark_duplicates(spark, d):
    return rna.mark_duplicates(_read_pairs(spark, d))


@query(f"WITH {A.READS} SELECT split_part(contig, '.', 1) AS species, count(*) FILTER (mapq = 50) AS unique_reads, count(*) FILTER (mapq <> 50) AS multi_reads FROM reads GROUP BY 1")
def mapping_by_species(spark, d):
    return rna.mapping_by_species(A.reads(spark, d), 50)


@query(f"""WITH {A.CELL_GENE}, l AS (SELECT *, 1 - pow(1 - (('0x' || substr(md5('1|' || sample || '|' || cell || '|' || gene), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE, 1.0::DOUBLE / n) AS least FROM cell_gene),
f AS (SELECT i / 25.0::DOUBLE AS fraction FROM range(1, 26) t(i)), c AS (SELECT sample, cell, fraction, count(*) FILTER (least <= fraction) AS k FROM l, f GROUP BY ALL)
SELECT sample, fraction, median(k) AS median_features, count(*) AS cells FROM c GROUP BY ALL""")
def saturation(spark, d):
    return rna.saturation(A.cell_gene(spark, d))


@query(f"""WITH {A.READS}, c AS (SELECT cell, count(*) FILTER (contig LIKE 'hs.%') AS a, count(*) FILTER (contig LIKE 'mm.%') AS b FROM reads GROUP BY cell),
t AS (SELECT *, a + b AS n, CASE WHEN a / (a + b) <= 0.4 THEN 2 WHEN a / (a + b) <= 0.6 THEN 0 ELSE 1 END AS k FROM c), x AS (SELECT count(*) AS cells, count(*) FILTER (k = 1) AS s1, count(*) FILTER (k = 2) AS s2, count(*) FILTER (k = 0) AS mixed,
  100.0::DOUBLE * (sum(a) FILTER (k = 1) + sum(b) FILTER (k = 2)) / (sum(n) FILTER (k = 1) + sum(n) FILTER (k = 2)) AS purity FROM t)
SELECT cells, s1 AS species1, s2 AS species2, mixed, purity, 100 * (mixed / cells) AS measurable_crosstalk, 100 * ((mixed / cells) / (2 * (s1 / (s1 + s2)) * (s2 / (s1 + s2)))) AS total_crosstalk FROM x""")
def species_mix(spark, d):
    c = A.reads(spark, d).groupBy("cell").agg(F.count_if(F.col("contig").startswith("hs.")).alias("hs"), F.count_if(F.col("contig").startswith("mm.")).alias("mm"))
    return rna.species_mix(c, "hs", "mm", 0.6)


# ATAC


@query(f"""WITH {A.PAIRS}, p AS (SELECT * FROM pairs WHERE flag & 2304 = 0) SELECT sample, contig, name, """ + ", ".join(f"max({c}) FILTER ({w}) AS {n}{i}" for i, w in ((1, "flag & 64 <> 0"), (2, "flag & 64 = 0")) for c, n in (("pos", "pos"), ('"end"', "end"), ("flag & 16 <> 0", "rev"), ("mapq", "mapq"))) + " FROM p GROUP BY ALL HAVING count(*) = 2 AND count(*) FILTER (flag & 64 <> 0) = 1")
def pair_mates(spark, d):
    return atac.pair_mates(A.pairs(spark, d))


@query(f"""WITH {A.PAIRS}, {SIZES}, p AS (SELECT * FROM pairs WHERE flag & 2304 = 0), m AS (SELECT contig, name, bool_or(flag & 64 <> 0 AND flag & 16 <> 0) AS r1, min(mapq) AS q, min(pos) FILTER (flag & 16 = 0) AS a, max("end") FILTER (flag & 16 <> 0) AS b FROM p GROUP BY ALL HAVING count(*) = 2)
SELECT chr, start, stop, read_name, orientation, 1::BIGINT AS support FROM (SELECT contig AS chr, least(greatest(a + CASE WHEN r1 THEN -5 ELSE 4 END, 0), length) AS start, least(greatest(b + CASE WHEN r1 THEN -5 ELSE 4 END, 0), length) AS stop, name AS read_name, CASE WHEN r1 THEN 'r2r1' ELSE 'r1r2' END AS orientation FROM m JOIN sizes ON contig = chr WHERE q >= 30) WHERE stop > start AND stop - start <= 2000""")
def fragments_of_pairs(spark, d):
    return atac.fragments_of_pairs(atac.pair_mates(A.pairs(spark, d)), sizes(spark, d))


@query(f"WITH {A.FRAG} SELECT bead, count(DISTINCT (chr, start, stop)) AS n FROM frag GROUP BY bead")
def frags_per_bead(spark, d):
    return atac.frags_per_bead(A.frag(spark, d))


@query(f"WITH {A.FRAG} SELECT bead, count(*) AS n FROM frag WHERE chr <> 'RF' GROUP BY bead")
def sum_counts(spark, d):
    return atac.sum_counts(A.frag(spark, d).groupBy("bead", "chr").agg(F.count("*").alias("n")), "RF")


@query(f"WITH {A.CELL_FRAG} SELECT chr, start, stop, cell, min(read_name) AS read_name, sum(support)::BIGINT AS support FROM cell_frag GROUP BY ALL")
def dedup_cell(spark, d):
    return atac.dedup_cell(A.cell_frag(spark, d))


@query(f"WITH {A.CELL_FRAG} SELECT cell, chr, count(*) AS total, count(DISTINCT (start, stop)) AS \"unique\" FROM cell_frag GROUP BY ALL")
def frag_sumstats(spark, d):
    return atac.frag_sumstats(A.cell_frag(spark, d))


_QC = f"""WITH RECURSIVE {A.CELL_FRAG}, s AS (SELECT cell, chr, count(*) AS t, count(DISTINCT (start, stop)) AS u FROM cell_frag GROUP BY ALL),
q AS (SELECT cell, sum(t) FILTER (chr <> 'RF')::BIGINT AS "totalNuclearFrags", sum(u) FILTER (chr <> 'RF')::BIGINT AS "uniqueNuclearFrags", coalesce(sum(t) FILTER (chr = 'RF'), 0)::BIGINT AS "totalMitoFrags", coalesce(sum(u) FILTER (chr = 'RF'), 0)::BIGINT AS "uniqueMitoFrags" FROM s GROUP BY cell),
r AS (SELECT cell, "totalNuclearFrags"::DOUBLE AS n, "uniqueNuclearFrags"::DOUBLE AS c, 1.0::DOUBLE AS lo, (SELECT min(h) FROM (SELECT pow(10, i)::DOUBLE AS h FROM range(2, 14) t(i)) WHERE c / (h * c) - 1 + exp(-n / (h * c)) <= 0) AS hi, 0 AS i FROM q
  UNION ALL SELECT cell, n, c, CASE WHEN c / ((lo + hi) / 2 * c) - 1 + exp(-n / ((lo + hi) / 2 * c)) > 0 THEN (lo + hi) / 2 ELSE lo END, CASE WHEN c / ((lo + hi) / 2 * c) - 1 + exp(-n / ((lo + hi) / 2 * c)) > 0 THEN hi ELSE (lo + hi) / 2 END, i + 1 FROM r WHERE i < 41)"""


@query(_QC + """ SELECT q.*, round(("totalNuclearFrags" - "uniqueNuclearFrags") / "totalNuclearFrags", 3) AS "duplicateProportion", CASE WHEN c < n THEN round_even(c * (lo + hi) / 2, 0)::BIGINT END AS "librarySize" FROM q JOIN r USING (cell) WHERE i = 41""")
def cell_qc(spark, d):
    return atac.advanced_qc(atac.basic_qc(atac.frag_sumstats(A.cell_frag(spark, d)), ["RF"]))


@query(f"WITH {A.CELL_FRAG} SELECT cell, avg(stop - start) AS \"meanInsertSize\", median(stop - start)::DOUBLE AS \"medianInsertSize\", avg((start % 1000 < 100)::INT) AS \"tssProportion\", avg((start % 700 < 100)::INT) AS \"FRIP\" FROM cell_frag GROUP BY cell")
def frag_qc(spark, d):
    return atac.frag_qc(A.cell_frag(spark, d).withColumn("in_tss", F.col("start") % 1000 < 100).withColumn("in_peak", F.col("start") % 700 < 100))


_FLAGS = {"total": "true", "secondary": "flag & 256 <> 0", "supplementary": "flag & 2048 <> 0", "duplicates": "flag & 1024 <> 0", "mapped": "flag & 4 = 0", "paired": "flag & 2305 = 1", "read1": "flag & 2305 = 1 AND flag & 64 <> 0", "read2": "flag & 2305 = 1 AND flag & 128 <> 0", "properly_paired": "flag & 2305 = 1 AND flag & 2 <> 0 AND flag & 4 = 0", "both_mapped": "flag & 2305 = 1 AND flag & 12 = 0", "singletons": "flag & 2305 = 1 AND flag & 4 = 0 AND flag & 8 <> 0"}


@query(f"WITH {A.PAIRS} " + " UNION ALL ".join(f"SELECT '{k}' AS metric, count(*) FILTER ({c}) AS value FROM pairs" for k, c in _FLAGS.items()))
def flagstat(spark, d):
    return atac.flagstat(A.pairs(spark, d))


@query(f"WITH {A.PAIRS} SELECT contig, count(*) AS mapped, 0::BIGINT AS unmapped FROM pairs GROUP BY contig")
def idxstats(spark, d):
    return atac.idxstats(A.pairs(spark, d))


@query(f"WITH {A.PAIRS} SELECT abs(tlen) AS size, count(*) AS n FROM pairs WHERE flag & 67 = 67 AND flag & 12 = 0 GROUP BY 1")
def insert_sizes(spark, d):
    return atac.insert_sizes(A.pairs(spark, d))


@query(f"WITH {A.PAIRS}, s AS (SELECT abs(tlen) AS size FROM pairs WHERE flag & 67 = 67 AND flag & 12 = 0) SELECT avg(size) AS mean_size, quantile_disc(size, 0.5) AS median_size FROM s")
def insert_size_metrics(spark, d):
    return atac.insert_size_metrics(atac.insert_sizes(A.pairs(spark, d)))


@query(f"""WITH {A.PAIRS}, a AS (SELECT * FROM pairs WHERE flag & 1024 = 0), v AS (SELECT (SELECT count(*) FROM pairs) / 2 AS i, (SELECT count(*) FROM a) / 2 AS o)
SELECT 'dedup' AS process, unnest(['input', 'output', 'input_mapped', 'output_mapped']) AS metric, unnest([i, o, 100.0::DOUBLE, 100.0::DOUBLE]) AS value FROM v""")
def step_counts(spark, d):
    p = A.pairs(spark, d)
    return atac.step_counts(p, p.filter(S.lacks_flag("flag", 0x400)), "dedup")


@query(f"WITH {A.DOC_READS}, n AS (SELECT sample, substr(split_part(name, '_', 1), -3) AS ti, count(*) AS count FROM doc_reads GROUP BY ALL) SELECT *, count < 10000 AS low, 100 * count / sum(count) OVER (PARTITION BY sample) AS percent FROM n")
def index_counts(spark, d):
    return atac.index_counts(A.doc_reads(spark, d), 3)


@query(f"WITH {A.DOC_READS} SELECT DISTINCT split_part(name, '_', 1) AS bead FROM doc_reads WHERE name IS NOT NULL")
def beads_of_reads(spark, d):
    return atac.beads_of_reads(A.doc_reads(spark, d))


def _by_case(spark):
    """A session like the given one in which names that differ in case alone, as n and N, are different columns."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


_CYCLE = f"WITH {A.DOC_READS}, x AS (SELECT unnest(string_split(seq, '')) AS base, ascii(unnest(string_split(qual, ''))) - 33 AS code, unnest(range(length(seq))) AS pos FROM doc_reads WHERE seq <> '')"


@query(_CYCLE + " SELECT pos::INT AS pos, count(*) AS n, avg(code) AS mean_quality, " + ", ".join(f"avg((base = '{b}')::INT) AS \"{b}\"" for b in "ACGTN") + " FROM x GROUP BY pos")
def read_qc(spark, d):
    return atac.read_qc(A.doc_reads(_by_case(spark), d).filter("seq <> ''"))


# scalar functions


@query(f"WITH {A.DOC_READS} SELECT name, split_part(name, '_', 2) AS umi, split_part(name, '_', 1) || '_' || split_part(name, '_', 3) AS rest, substr(split_part(name, '_', 1), -2) AS ti FROM doc_reads")
def name_parts(spark, d):
    return A.doc_reads(spark, d).select("name", S.name_part("name", 1).alias("umi"), S.name_rest("name", [1]).alias("rest"), S.index_of_name("name", 2).alias("ti"))


@query(f"WITH {A.DOC_READS} SELECT name, substr(seq, 6, greatest(length(seq) - 8, 0)) AS cropped, regexp_replace(seq, '^(?:ACGTACGT|CGTACGT|GTACGT|TACGT){{1,4}}', '') AS trimmed FROM doc_reads WHERE seq <> ''")
def crop_and_trim(spark, d):
    return A.doc_reads(spark, d).filter("seq <> ''").select("name", S.crop("seq", 5, 3).alias("cropped"), S.trim_adapter("seq", "ACGTACGT").alias("trimmed"))


@query(f"WITH {_MAP} SELECT bead, regexp_replace(cell, 'BC(\\d+)N', 'BC00\\1N') AS cell6 FROM m")
def repad_names(spark, d):
    return _map(spark, d).select("bead", S.repad("cell", 6).alias("cell6"))


@query("SELECT o_orderkey, CASE WHEN x = 0 THEN 0 ELSE round(x * pow(10.0, 2 - floor(log10(abs(x))))) / pow(10.0, 2 - floor(log10(abs(x)))) END AS three, CASE WHEN o_custkey % 100 <= 10 THEN 'species2' WHEN o_custkey % 100 <= 90 THEN 'mixed' ELSE 'species1' END AS kind, (CASE WHEN o_custkey % 2 = 0 THEN o_custkey - 1 ELSE o_custkey END) AS odd FROM (SELECT *, floor(o_totalprice) AS x FROM orders)")
def report_numbers(spark, d):
    o = A.table(spark, d, "orders")
    return o.select("o_orderkey", S.signif(F.floor("o_totalprice").cast("double"), 3).alias("three"), S.cell_type((F.col("o_custkey") % 100) / 100, 0.9).alias("kind"), S.odd_below("o_custkey").alias("odd"))


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 7 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k IN (0, 1, 5) THEN 'G' || l_partkey WHEN k IN (2, 6) THEN 'Unassigned_Ambiguous' WHEN k = 3 THEN 'INTRON' ELSE 'INTERGENIC' END AS gene,
  CASE WHEN k IN (0, 5) THEN 'EXON' WHEN k = 1 THEN 'UTR' END AS feature, CASE WHEN k < 2 THEN 1 WHEN k IN (2, 5) THEN 2 ELSE 0 END AS hits,
  CASE WHEN k IN (0, 1, 5) THEN 'G' || l_partkey WHEN k IN (2, 6) THEN 'Unassigned_Ambiguous' WHEN k = 3 THEN 'H_x' || l_suppkey ELSE 'INTERGENIC' END AS gene_introns FROM t""")
def assign_gene(spark, d):
    g, h, k = F.concat(F.lit("G"), F.col("l_partkey").cast("string")), F.concat(F.lit("H_x"), F.col("l_suppkey").cast("string")), F.col("l_linenumber") % 7
    tag = F.when(k == 0, F.concat(g, F.lit("_EXON,"), h, F.lit("_INTRON"))).when(k == 1, F.concat(g, F.lit("_EXON,"), g, F.lit("_UTR"))).when(k == 2, F.concat(g, F.lit("_EXON,"), h, F.lit("_EXON"))).when(k == 3, F.concat(h, F.lit("_INTRON")))
    tag = tag.when(k == 5, F.concat(g, F.lit("_EXON,"), h, F.lit("_UTR"))).when(k == 6, F.concat(g, F.lit("_INTRON,"), h, F.lit("_INTRON"))).otherwise("INTERGENIC")
    li = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tag.alias("tag"))
    return li.select("l_orderkey", "l_linenumber", S.assign_feature("tag").alias("a"), S.assign_feature("tag", True)["gene"].alias("gene_introns")).select("l_orderkey", "l_linenumber", "a.*", "gene_introns")


# antibodies


def _tags(spark, d):
    """Tags of 15 bases from part names, one per brand."""
    t = A.table(spark, d, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("k"))
    seq = F.translate(F.substring(F.md5(F.col("p_brand").cast("binary")), 1, 15), "0123456789abcdef", "ACGTACGTACGTACGT")
    return t.select(seq.alias("sequence"), F.col("p_brand").alias("label"))


_TAGS = "tags AS (SELECT DISTINCT translate(substr(md5(p_brand), 1, 15), '0123456789abcdef', 'ACGTACGTACGTACGT') AS sequence, p_brand AS label FROM part)"


@query(f"""WITH {_TAGS}, x AS (SELECT label, sequence, i, b FROM tags, range(1, 16) t(i), (SELECT unnest(['A', 'C', 'G', 'T']) AS b) WHERE substr(sequence, i, 1) <> b)
SELECT sequence AS seq, label, label AS key FROM tags UNION ALL SELECT substr(sequence, 1, i - 1) || b || substr(sequence, i + 1), label, label || '-' || i || '-' || b FROM x""")
def mismatch_map(spark, d):
    return adt.mismatch_map(_tags(spark, d))


@query(f"WITH {_TAGS} SELECT min(levenshtein(a.sequence, b.sequence))::INT AS min_distance FROM tags a JOIN tags b ON a.label < b.label")
def min_edit_distance(spark, d):
    return adt.min_edit_distance(_tags(spark, d))


@query(f"WITH {_TAGS} SELECT upper(sequence) AS sequence, regexp_replace(label, '[^A-Za-z0-9.]+', '.', 'g') AS label FROM tags")
def clean_tags(spark, d):
    return adt.clean_tags(_tags(spark, d).select("label", "sequence"))


def _tag_reads(spark, d):
    """Reads whose first bases are a tag, with a substitution in every third."""
    t = _tags(spark, d).withColumnRenamed("label", "p_brand")
    j = A.table(spark, d, "lineitem").join(A.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(t, "p_brand")
    seq = F.when(F.col("l_linenumber") % 3 == 0, F.overlay("sequence", F.lit("N"), F.lit(4))).when(F.col("l_linenumber") % 3 == 1, F.overlay("sequence", F.lit("A"), F.lit(7))).otherwise(F.col("sequence"))
    return j.select(F.col("l_suppkey").cast("string").alias("cell"), F.col("l_orderkey").cast("string").alias("umi"), F.concat(seq, F.lit("TTTT")).alias("seq"))


_TAG_READS = f"""{_TAGS}, tr AS (SELECT l_suppkey::VARCHAR AS cell, l_orderkey::VARCHAR AS umi, label FROM lineitem JOIN part ON l_partkey = p_partkey JOIN tags ON label = p_brand WHERE l_linenumber % 3 <> 0)"""


@query(f"WITH {_TAG_READS} SELECT cell, label AS feature, count(DISTINCT umi) AS n FROM tr GROUP BY ALL")
def adt_matrix(spark, d):
    return adt.adt_matrix(adt.match_tags(_tag_reads(spark, d), _tags(spark, d), 15))


@query(f"WITH {_TAG_READS}, m AS (SELECT cell, label, count(DISTINCT umi) AS n FROM tr GROUP BY ALL), c AS (SELECT cell, sum(n) AS u, count(*) AS f FROM m GROUP BY cell) SELECT sum(u)::BIGINT AS total, median(u)::DOUBLE AS median_umi, median(f)::DOUBLE AS median_adts FROM c")
def adt_metrics(spark, d):
    return adt.adt_metrics(adt_matrix(spark, d))


@query(f"WITH {_TAG_READS}, m AS (SELECT cell, label, count(DISTINCT umi) AS n FROM tr GROUP BY ALL) SELECT label AS feature, round(sum(n) / (SELECT count(DISTINCT cell) FROM m), 1) AS mean_count FROM m GROUP BY label")
def adt_per_cell(spark, d):
    return adt.adt_per_cell(adt_matrix(spark, d))


@query(f"WITH {_TAG_READS}, m AS (SELECT cell, label, count(DISTINCT umi) AS n FROM tr GROUP BY ALL) SELECT label AS feature, min(n) AS min, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, max(n) AS max, avg(n) AS mean FROM m GROUP BY label")
def feature_summary(spark, d):
    return adt.feature_summary(adt_matrix(spark, d))


@query("SELECT count(DISTINCT l_orderkey) FILTER (l_shipmode = 'r') AS mito, count(DISTINCT l_orderkey) FILTER (l_shipmode = 'a') AS ribo, count(DISTINCT l_orderkey) FILTER (l_shipmode IS NULL) AS unmapped, count(DISTINCT l_orderkey) AS total FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN 'r' WHEN 'A' THEN 'a' END AS l_shipmode FROM lineitem)")
def contaminants(spark, d):
    r = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("name"), F.when(F.col("l_returnflag") == "R", "mito_1").when(F.col("l_returnflag") == "A", "ribo_1").alias("reference"))
    return adt.contaminants(r, {"mito": "^mito", "ribo": "^ribo"})


@query(f"WITH {A.CELL_GENE}, r AS (SELECT cell, gene AS feature, n FROM cell_gene), t AS (SELECT o_custkey::VARCHAR AS cell, o_orderpriority AS feature, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) SELECT *, 'Gene Expression' AS type FROM r WHERE cell IN (SELECT cell FROM t) UNION ALL SELECT *, 'Antibody Capture' FROM t WHERE cell IN (SELECT cell FROM r)")
def align_modalities(spark, d):
    t = A.table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").cast("string").alias("cell"), F.col("o_orderpriority").alias("feature")).agg(F.count("*").alias("n"))
    return adt.align_modalities(A.cell_gene(spark, d).withColumnRenamed("gene", "feature"), t)


@query("SELECT o_orderpriority AS cluster, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY 1")
def cluster_freq(spark, d):
    return adt.cluster_freq(A.table(spark, d, "orders").withColumnRenamed("o_orderpriority", "cluster"))


# metrics, sets and checks


@query(f"WITH {A.METRICS} SELECT sample, split_part(process, '-', 1) AS process, metric, sum(value) AS value FROM metrics_long GROUP BY ALL")
def sum_by_process(spark, d):
    return metrics.sum_by_process(A.metrics_long(spark, d))


@query("SELECT l_returnflag AS sample, count(*) AS reads, count(*) FILTER (l_tax > 0.07) AS duplicates, 100 * count(*) FILTER (l_tax > 0.07) / count(*) AS percent FROM lineitem GROUP BY 1")
def dup_rollup(spark, d):
    parts = A.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), "l_linestatus").agg(F.count("*").alias("reads"), F.count_if(F.col("l_tax") > 0.07).alias("duplicates"))
    return metrics.dup_rollup(parts)


@query("""WITH c AS (SELECT o_orderstatus AS sample, (o_custkey % 4)::VARCHAR AS ti, o_custkey AS cell, count(*) AS frags FROM orders GROUP BY ALL), r AS (SELECT o_orderstatus AS sample, (o_custkey % 4)::VARCHAR AS ti, count(*) AS reads FROM orders GROUP BY ALL),
a AS (SELECT sample, ti, count(DISTINCT cell) AS cells, median(frags)::DOUBLE AS median_frags FROM c GROUP BY GROUPING SETS ((sample, ti), (sample))), b AS (SELECT sample, ti, sum(reads)::BIGINT AS reads FROM r GROUP BY GROUPING SETS ((sample, ti), (sample)))
SELECT a.sample, a.ti, cells, reads, reads / cells AS mean_reads_per_cell, median_frags FROM a JOIN b ON a.sample = b.sample AND a.ti IS NOT DISTINCT FROM b.ti""")
def bead_filt_summary(spark, d):
    o = A.table(spark, d, "orders").select(F.col("o_orderstatus").alias("sample"), (F.col("o_custkey") % 4).cast("string").alias("ti"), F.col("o_custkey").alias("cell"))
    return metrics.bead_filt_summary(o.groupBy("sample", "ti", "cell").agg(F.count("*").alias("frags")), o.groupBy("sample", "ti").agg(F.count("*").alias("reads")))


@query(f"WITH {A.METRICS}, p AS (SELECT sample, sum(value) FILTER (metric = 'click') AS click, sum(value) FILTER (metric = 'view') AS view FROM metrics_long GROUP BY sample) SELECT sample, click, view, round(100 * view / click, 2) AS view_pct FROM p")
def funnel(spark, d):
    return metrics.funnel(A.metrics_long(spark, d), ["click", "view"])


@query(f"WITH {A.METRICS} SELECT sample, 'view_rate' AS metric, 100 * sum(value) FILTER (metric = 'view') / nullif(sum(value) FILTER (metric = 'click'), 0) AS value FROM metrics_long GROUP BY sample")
def summary_metrics(spark, d):
    return metrics.summary_metrics(A.metrics_long(spark, d), {"view_rate": ("view", "click")})


@query("SELECT c_custkey, unnest(['c_acctbal', 'c_nationkey']) AS metric, unnest([c_acctbal, c_nationkey::DOUBLE]) AS value FROM customer")
def to_tidy(spark, d):
    return metrics.to_tidy(A.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), ["c_custkey"])


@query(f"WITH {A.CELL_GENE} SELECT cell, " + ", ".join(f"sum(n) FILTER (gene = 'Brand#{i}{i}')::BIGINT AS \"Brand#{i}{i}\"" for i in (1, 2)) + " FROM cell_gene GROUP BY cell")
def to_wide(spark, d):
    return metrics.to_wide(A.cell_gene(spark, d), "cell", "gene", "n", ["Brand#11", "Brand#22"])


@query("SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def common_keys(spark, d):
    return metrics.common(A.table(spark, d, "customer").select("c_nationkey"), A.table(spark, d, "supplier").select(F.col("s_nationkey").alias("c_nationkey")))


@query("SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def missing_keys(spark, d):
    return metrics.missing(A.table(spark, d, "customer").select("c_nationkey"), A.table(spark, d, "supplier").select("s_nationkey"))


@query("""WITH f AS (SELECT DISTINCT o_custkey AS k FROM orders), c AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 7 <> 0) SELECT k, CASE WHEN c.k IS NULL THEN 'not declared' ELSE 'not found' END AS issue
FROM (SELECT coalesce(f.k, c.k) AS k, f.k AS a, c.k AS b FROM f FULL JOIN c ON f.k = c.k) x LEFT JOIN c USING (k) WHERE a IS NULL OR b IS NULL""")
def reconcile(spark, d):
    return metrics.reconcile(A.table(spark, d, "orders").select(F.col("o_custkey").alias("k")), A.table(spark, d, "customer").filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("k")), ["k"])


@query("SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 'A' ELSE 'SuperloadedSample' END AS sample FROM orders")
def regroup(spark, d):
    o = A.table(spark, d, "orders").select("o_orderkey", F.lit("f").alias("fastq"), (F.col("o_custkey") % 5).alias("ti"))
    return metrics.regroup(o, o.filter("ti = 0").select("fastq", "ti", F.lit("A").alias("sample"))).select("o_orderkey", "sample")


def _features(spark, d):
    p = A.table(spark, d, "part")
    start = F.col("p_partkey") * 40
    base = p.select(F.concat(F.lit("G"), F.floor(F.col("p_partkey") / 4).cast("string")).alias("gene_id"), F.concat(F.lit("chr"), (F.floor(F.col("p_partkey") / 4) % 5).cast("string")).alias("chr"), F.when(F.floor(F.col("p_partkey") / 4) % 2 == 0, "+").otherwise("-").alias("strand"), F.when(F.col("p_size") > 30, "exon").otherwise("five_prime_utr").alias("kind"), start.alias("start"), (start + F.col("p_size")).alias("stop"), F.when(F.col("p_size") > 25, F.col("p_name")).alias("gene_name"), F.col("p_type").alias("biotype"))
    gene = base.groupBy("gene_id", "chr", "strand").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).select("gene_id", "chr", "strand", F.lit("gene").alias("kind"), "start", "stop", F.lit(None).cast("string").alias("gene_name"), F.lit(None).cast("string").alias("biotype"))
    return base.unionByName(gene)


@query()
def build_saf(spark, d):
    sizes_ = _features(spark, d).groupBy("chr").agg((F.max("stop") + 100).alias("length"))
    return checks.build_saf(_features(spark, d), sizes_)


@query("SELECT DISTINCT 'G' || p_partkey // 4 AS gene_id, coalesce(CASE WHEN p_size > 25 THEN p_name END, 'G' || p_partkey // 4) AS gene_name FROM part")
def gene_symbols(spark, d):
    return checks.gene_symbols(_features(spark, d))


@query("SELECT * FROM (SELECT 'strand' AS rule, count(*) AS n FROM part WHERE p_size % 9 = 0 UNION ALL SELECT 'contig', count(*) FROM part WHERE p_partkey // 4 % 5 = 4 UNION ALL SELECT 'no_stop_codon', 1) WHERE n > 0")
def check_reference(spark, d):
    f = _features(spark, d).filter("kind <> 'gene'").withColumn("strand", F.when((F.col("stop") - F.col("start")) % 9 == 0, ".").otherwise(F.col("strand")))
    return checks.check_reference(f, spark.range(4).select(F.concat(F.lit("chr"), "id").alias("chr")), ("exon", "stop_codon"))


@query(f"WITH {A.FRAG} SELECT * FROM frag WHERE chr IN ('AF', 'NO')")
def restrict_contigs(spark, d):
    return checks.restrict_contigs(A.frag(spark, d), sizes(spark, d).filter("chr in ('AF', 'NO')"))


@query(f"WITH {A.PAIRS}, s AS (SELECT name FROM pairs WHERE NOT (flag & 128 <> 0 AND mapq = 25) GROUP BY name HAVING count(*) FILTER (flag & 64 <> 0) <> 1 OR count(*) FILTER (flag & 64 = 0) <> 1) SELECT 'unpaired' AS rule, count(*) AS n FROM s HAVING count(*) > 0")
def check_pairs(spark, d):
    r = A.pairs(spark, d).withColumn("mate", F.when(S.has_flag("flag", 0x40), 1).otherwise(2)).filter("not (mate = 2 and mapq = 25)").withColumn("seq", F.lit("A")).withColumn("qual", F.lit("I"))
    return checks.check_pairs(r)


# matrices


@query(f"WITH {A.CELL_GENE} SELECT sample, cell, gene, n, ln(1 + n * 10000.0::DOUBLE / sum(n) OVER (PARTITION BY cell)) AS x FROM cell_gene")
def log_normalize(spark, d):
    return ml.log_normalize(A.cell_gene(spark, d)).withColumn("x", F.round("x", 9))


ORACLE_SQL["log_normalize"] = ORACLE_SQL["log_normalize"].replace("ln(1", "round(ln(1").replace("PARTITION BY cell))", "PARTITION BY cell)), 9)")


@query(f"""WITH {A.CELL_GENE}, s AS (SELECT gene AS feature, sum(n)::DOUBLE AS s, sum(n * n)::DOUBLE AS q, (SELECT count(DISTINCT cell) FROM cell_gene)::DOUBLE AS c FROM cell_gene GROUP BY 1),
v AS (SELECT feature, s / c AS mean, (q - s * (s / c)) / (c - 1) / (s / c) AS dispersion FROM s) SELECT feature, round(mean, 9) AS mean, round(dispersion, 9) AS dispersion, row_number() OVER (ORDER BY dispersion DESC, feature)::INT AS rank FROM v QUALIFY rank <= 10""")
def variable_features(spark, d):
    v = ml.variable_features(A.cell_gene(spark, d).withColumnRenamed("gene", "feature"), 10)
    return v.withColumn("mean", F.round("mean", 9)).withColumn("dispersion", F.round("dispersion", 9))


def _normal(spark, d):
    return ml.log_normalize(A.cell_gene(spark, d).withColumnRenamed("gene", "feature"))


@query()
def pca_clusters(spark, d):
    m = checkpoint(_normal(spark, d))
    top = [r["feature"] for r in ml.variable_features(m, 12).collect()]  # 12 names
    return ml.cluster(ml.pca(ml.feature_vectors(m, top), 5), 4)


@query()
def markers(spark, d):
    m = _normal(spark, d)
    clusters = m.select("cell", (F.col("cell").cast("long") % 3).alias("cluster")).distinct()
    return ml.markers(m, clusters, 0.0, -9.0)
