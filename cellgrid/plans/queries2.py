"""More registered queries: joins of annotations, debarcoding, checks, file round trips, and SQL for derived curves."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import adt, atac, checks, merge_atac, metrics, ml, rna
from ..sources import files
from . import adapters as A
from . import queries as Q
from .queries import ORACLE_SQL, query


def _folder(spark) -> str:
    """A new folder in the space that the cluster shares."""
    from ..operators.graph import shared_dir

    return f"{shared_dir(spark).rstrip('/')}/cellgrid-{uuid.uuid4().hex}"


# joins of annotations

_BEADS = "b AS (SELECT 'S' || s_suppkey AS bead, 'C' || (s_suppkey % 7) AS cell FROM supplier WHERE s_acctbal > 0)"


def _beads(spark, d):
    s = A.table(spark, d, "supplier").filter("s_acctbal > 0")
    return s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("bead"), F.concat(F.lit("C"), (F.col("s_suppkey") % 7).cast("string")).alias("cell"))


@query(f"WITH {A.CELL_FRAG} SELECT read_name, chr, start, stop, bead FROM cell_frag WHERE substr(bead, 2)::BIGINT % 3 <> 0")
def annotate_bead(spark, d):
    f = A.cell_frag(spark, d)
    named = f.select("read_name", F.when(F.substring("bead", 2, 20).cast("long") % 3 != 0, F.col("bead")).alias("bead"))
    return atac.annotate_bead(f.select("read_name", "chr", "start", "stop"), named.union(named))


@query(f"WITH {A.FRAG}, {_BEADS} SELECT frag.*, cell FROM frag JOIN b USING (bead)")
def annotate_cell(spark, d):
    return atac.annotate_cell(A.frag(spark, d), _beads(spark, d)).select("chr", "start", "stop", "bead", "support", "cell")


@query(f"""WITH {A.PAIRS}, {_BEADS}, good AS MATERIALIZED (SELECT DISTINCT name AS good_name FROM pairs WHERE mapq >= 40), hit AS MATERIALIZED (SELECT name, flag, cell FROM pairs JOIN b USING (bead))
SELECT name, flag, cell FROM hit JOIN good ON name = good_name""")
def keep_deduped(spark, d):
    p = A.pairs(spark, d)
    return atac.keep_deduped(p, _beads(spark, d), p.filter("mapq >= 40")).select("name", "flag", "cell")


@query("SELECT c_custkey, c_nationkey AS ti, n_name AS sequence FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2")
def resolve_index(spark, d):
    index = A.table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("ti"), F.col("n_name").alias("sequence"))
    return metrics.resolve_index(A.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("ti")), index)


@query("SELECT c_custkey AS barcode, c_mktsegment AS cluster, n_name AS x, c_acctbal AS y FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 0")
def join_embeddings(spark, d):
    c, n = A.table(spark, d, "customer"), A.table(spark, d, "nation")
    x = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("barcode"), F.col("n_name").alias("x"))
    y = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("barcode"), F.col("c_acctbal").alias("y"))
    return adt.join_embeddings(c.select(F.col("c_custkey").alias("barcode"), F.col("c_mktsegment").alias("cluster")), [x, y])


# debarcoding: a barcode of 15 bases with at most one substitution, a constant of 4, a UMI of 6


def _packed(spark, d):
    t = Q._tags(spark, d)
    j = A.table(spark, d, "lineitem").join(A.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(t, F.col("label") == F.col("p_brand"))
    k = F.col("l_linenumber")
    code = F.when(k == 1, F.overlay("sequence", F.lit("N"), F.lit(4))).when(k == 2, F.overlay("sequence", F.lit("NN"), F.lit(4))).otherwise(F.col("sequence"))
    const = F.when(k == 3, "ACGA").when(k == 4, "TTTT").otherwise("ACGT")
    umi = F.translate(F.lpad((F.col("l_orderkey") % 1000000).cast("string"), 6, "0"), "0123456789", "ACGTACGTAC")
    return j.select(F.concat_ws("_", "l_orderkey", "l_linenumber").alias("name"), F.concat(code, const, umi, F.lit("GG")).alias("seq"))


@query(f"""WITH {Q._TAGS} SELECT l_orderkey || '_' || l_linenumber AS name, sequence AS barcode, translate(lpad((l_orderkey % 1000000)::VARCHAR, 6, '0'), '0123456789', 'ACGTACGTAC') AS umi
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN tags ON label = p_brand WHERE l_linenumber IN (3, 5, 6, 7)""")
def debarcode(spark, d):
    segments = [{"kind": "Barcode", "start": 0, "length": 15, "list": "tags"}, {"kind": "Const", "start": 15, "length": 4, "seq": "ACGT"}, {"kind": "Umi", "start": 19, "length": 6}]
    return adt.debarcode(_packed(spark, d), segments, {"tags": Q._tags(spark, d).select(F.col("sequence").alias("seq"))}).select("name", "barcode", "umi")


@query("SELECT count(*) AS total, count(*) FILTER (l_linenumber IN (3, 5, 6, 7)) AS good FROM lineitem")
def debarcode_counts(spark, d):
    return adt.debarcode_counts(_packed(spark, d), debarcode(spark, d))


# scalar functions


@query("""WITH q AS (SELECT doc_id, upper(regexp_replace(text, '[^a-zA-Z]', '', 'g')) AS t FROM documents), x AS (SELECT doc_id, length(t) AS n, unnest(range(length(t), 0, -1)) AS i, unnest(list_reverse(string_split(t, ''))) AS c FROM q WHERE t <> ''),
s AS (SELECT doc_id, n, i, sum(56 - (ascii(c) - 33)) OVER (PARTITION BY doc_id ORDER BY i DESC) AS s FROM x), k AS (SELECT *, min(s) OVER (PARTITION BY doc_id ORDER BY i DESC) AS low FROM s)
SELECT doc_id, coalesce(arg_max(i - 1, (s, i)) FILTER (low >= 0 AND s > 0), any_value(n))::INT AS keep FROM k GROUP BY doc_id UNION ALL SELECT doc_id, 0 FROM q WHERE t = ''""")
def quality_cut(spark, d):
    t = F.upper(F.regexp_replace("text", "[^a-zA-Z]", ""))
    return A.table(spark, d, "documents").select("doc_id", S.quality_cut(t, 56).alias("keep"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'HSA' WHEN 1 THEN 'MUS' END AS species FROM part")
def species_of_gene(spark, d):
    g = F.when(F.col("p_size") % 3 == 0, "ENSG").when(F.col("p_size") % 3 == 1, "ENSMUSG").otherwise("gene")
    return A.table(spark, d, "part").select("p_partkey", S.species_of_gene(F.concat(g, F.lpad(F.col("p_partkey").cast("string"), 8, "0"))).alias("species"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 'status ' || o_orderstatus ELSE 'g' || o_custkey END AS gene FROM orders")
def assignment(spark, d):
    o = A.table(spark, d, "orders")
    return o.select("o_orderkey", S.assignment(F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("g"), F.col("o_custkey").cast("string"))), F.concat(F.lit("status "), "o_orderstatus")).alias("gene"))


# checks and unions


@query("""WITH c AS (SELECT o_orderstatus AS sample, o_orderpriority AS ti FROM orders), i AS (SELECT DISTINCT o_orderpriority AS ti FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT * FROM (SELECT 'repeated' AS rule, (SELECT count(*) FROM (SELECT 1 FROM c GROUP BY sample, ti HAVING count(*) > 1)) AS n UNION ALL SELECT 'unknown_index', (SELECT count(*) FROM c WHERE ti NOT IN (SELECT ti FROM i))
  UNION ALL SELECT 'unequal_length', (SELECT count(DISTINCT length(ti)) - 1 FROM i)) WHERE n > 0""")
def check_config(spark, d):
    c = A.table(spark, d, "orders").select(F.col("o_orderstatus").alias("sample"), F.col("o_orderpriority").alias("ti"))
    index = c.select("ti", F.col("ti").alias("sequence")).distinct().filter("ti <> '5-LOW'")
    return checks.check_config(c, index)


@query(f"WITH {A.FRAG} SELECT count(*) FILTER (chr = 'NO') > 0 AS present FROM frag")
def has_contig(spark, d):
    return checks.has_contig(A.frag(spark, d), "NO")


@query(f"WITH {A.PEAKS} SELECT 'hs.' || chr AS chr, start, stop, name, score FROM peaks")
def prefix_species(spark, d):
    return checks.prefix_species(A.peaks(spark, d), "hs")


@query("SELECT DISTINCT 'G' || p_partkey // 4 AS gene_id FROM part WHERE p_type LIKE '%PROMO%'")
def ribosomal_genes(spark, d):
    f = Q._features(spark, d)
    return checks.ribosomal_genes(f.withColumn("biotype", F.regexp_replace("biotype", "PROMO", "rRNA")))


@query("SELECT c_custkey AS k, c_acctbal AS a, NULL::DOUBLE AS b, 'x' AS sample FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal, 'y' FROM supplier")
def concat_samples(spark, d):
    x = A.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("a"))
    y = A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("b"))
    return metrics.concat_samples({"x": x, "y": y})


@query(f"WITH {A.CELL_GENE} SELECT cell, gene AS feature, n, 'Gene Expression' AS type FROM cell_gene UNION ALL SELECT o_custkey::VARCHAR, o_orderpriority, count(*), 'Antibody Capture' FROM orders GROUP BY ALL")
def merge_modalities(spark, d):
    t = A.table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("cell"), F.col("o_orderpriority").alias("feature")).agg(F.count("*").alias("n"))
    return adt.merge_modalities(A.cell_gene(spark, d).withColumnRenamed("gene", "feature"), t)


# file round trips


@query(f"WITH {A.CELL_GENE} SELECT cell, gene AS feature, n FROM cell_gene")
def mtx_round_trip(spark, d):
    path, counts = _folder(spark), A.cell_gene(spark, d).select("cell", F.col("gene").alias("feature"), "n")
    files.write_mtx(counts, path)
    return files.read_mtx(spark, [f"{path}/matrix_head", f"{path}/matrix"], f"{path}/barcodes", f"{path}/features")


@query(f"WITH {A.CELL_FRAG} SELECT chr, start, stop, read_name, 'r1r2' AS orientation, support FROM cell_frag")
def fragments_round_trip(spark, d):
    path = _folder(spark)
    files.write_fragments(A.cell_frag(spark, d).select("chr", "start", "stop", "read_name", F.lit("r1r2").alias("orientation"), "support"), path)
    return files.read_fragments(spark, path)


@query(f"WITH {A.FRAG} SELECT start, stop, bead, support, chr FROM frag WHERE chr IN ('AF', 'NO')")
def split_round_trip(spark, d):
    path = _folder(spark)
    files.split_by(A.frag(spark, d), "chr", path, ["AF", "NO"])
    return spark.read.schema("start long, stop long, bead string, support long, chr string").parquet(path)


@query(f"WITH {A.METRICS} SELECT * FROM metrics_long")
def metrics_round_trip(spark, d):
    path = _folder(spark)
    files.write_table(A.metrics_long(spark, d), path)
    return files.read_metrics(spark, path)


@query(f"WITH {A.DOC_READS} SELECT name, seq, qual FROM doc_reads WHERE seq <> ''")
def fastq_round_trip(spark, d):
    path, r = _folder(spark), A.doc_reads(spark, d).filter("seq <> ''")
    r.select(F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.text(path)
    return files.read_fastq(spark, path).select("name", "seq", "qual")


@query(f"WITH {A.PAIRS} SELECT name, flag, contig, pos, mapq, tlen, pos + 40 AS \"end\", bead AS \"XB\" FROM pairs")
def sam_round_trip(spark, d):
    path = _folder(spark)
    row = F.concat_ws("\t", "name", "flag", "contig", F.col("pos") + 1, "mapq", F.lit("20M5D3I15M"), F.lit("="), F.lit("0"), "tlen", F.lit("*"), F.lit("*"), F.concat(F.lit("XB:Z:"), "bead"))
    A.pairs(spark, d).select(row.alias("value")).write.text(path)
    return files.read_sam(spark, path).select("name", "flag", "contig", "pos", "mapq", "tlen", "end", "XB")


# SQL for queries that have none yet

ORACLE_SQL["subtract_intervals"] = f"""WITH {A.FRAG}, {A.PEAKS},
e AS (SELECT chr, start AS pos, 1 AS a, 0 AS b FROM frag UNION ALL SELECT chr, stop, -1, 0 FROM frag UNION ALL SELECT chr, start, 0, 1 FROM peaks UNION ALL SELECT chr, stop, 0, -1 FROM peaks),
s AS (SELECT chr, pos, sum(a) AS a, sum(b) AS b FROM e GROUP BY chr, pos), w AS (SELECT chr, pos AS start, lead(pos) OVER o AS stop, sum(a) OVER o AS a, sum(b) OVER o AS b FROM s WINDOW o AS (PARTITION BY chr ORDER BY pos)),
k AS (SELECT *, sum(CASE WHEN start = prev THEN 0 ELSE 1 END) OVER (PARTITION BY chr ORDER BY start) AS g FROM (SELECT *, lag(stop) OVER (PARTITION BY chr ORDER BY start) AS prev FROM w WHERE a > 0 AND b <= 0 AND stop > start))
SELECT chr, min(start) AS start, max(stop) AS stop FROM k GROUP BY chr, g"""

ORACLE_SQL["kneedle_recall"] = Q._RANKED + """, r2 AS (SELECT r.* FROM r JOIN k USING (sample) WHERE rank <= 12.5 * knee),
z2 AS (SELECT *, (rank - min(rank) OVER s)::DOUBLE / (max(rank) OVER s - min(rank) OVER s) AS x, (cum_fraction - min(cum_fraction) OVER s) / (max(cum_fraction) OVER s - min(cum_fraction) OVER s) AS y FROM r2 WINDOW s AS (PARTITION BY sample))
SELECT sample, arg_max(rank, round(y - x, 12) - rank * 1e-15) AS knee FROM z2 GROUP BY sample"""

_JAC = Q._SITES + """, v AS (SELECT log10(jaccard_frag) AS v FROM j WHERE jaccard_frag > 0), m AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, (max(v) - min(v)) / 9999 AS step FROM v),
q AS (SELECT (v - lo) / step AS q FROM v, m), w AS (SELECT least(floor(q), 9999)::INT AS c, q - floor(q) AS f FROM q), cells AS (SELECT c, sum(k) AS k FROM (SELECT c, 1 - f AS k FROM w UNION ALL SELECT c + 1, f FROM w) GROUP BY c HAVING sum(k) > 0),
d AS (SELECT i::INT AS i, any_value(lo + i * step) AS x, sum(k * exp(-((i - c) * step / 0.1::DOUBLE) * ((i - c) * step / 0.1::DOUBLE) / 2)) / any_value(n) / (0.1::DOUBLE * sqrt(2 * pi())) AS density
  FROM range(10000) t(i), m, cells WHERE abs((i - c) * step / 0.1::DOUBLE) <= 5 GROUP BY i)"""


@query(_JAC + " SELECT i, round(x, 9) AS x, round(density, 7) AS density FROM d")
def jaccard_density_rounded(spark, d):
    g = Q.jaccard_density(spark, d)
    return g.select("i", F.round("x", 9).alias("x"), F.round("density", 7).alias("density"))


ORACLE_SQL["density_threshold"] = _JAC + """, l AS (SELECT *, lag(density) OVER o AS before, lead(density) OVER o AS after, max(density) OVER () AS peak FROM d WINDOW o AS (ORDER BY i)),
t AS (SELECT pow(10, arg_max(x, i)) AS raw FROM l WHERE density < before AND density <= after AND i >= 0.2 * 9999 AND density < 0.5 * peak)
SELECT round(raw, 9) AS raw, round(CASE WHEN raw > 1e-6 AND raw < 0.5 THEN raw ELSE 0.005 END, 9) AS safe FROM t"""

ORACLE_SQL["thin_curve"] = Q._RANKED + """, t AS (SELECT *, max(rank) OVER s AS last, greatest(max(rank) OVER s - min(rank) OVER s, 1e-12) AS s0, greatest(max(cum_fraction) OVER s - min(cum_fraction) OVER s, 1e-12) AS s1 FROM r WINDOW s AS (PARTITION BY sample)),
g AS (SELECT *, coalesce(sqrt(pow((rank - lag(rank) OVER o) / s0, 2) + pow((cum_fraction - lag(cum_fraction) OVER o) / s1, 2)), 0) AS step FROM t WINDOW o AS (PARTITION BY sample ORDER BY rank, cum_fraction)),
b AS (SELECT *, floor(round(sum(step) OVER (PARTITION BY sample ORDER BY rank, cum_fraction ROWS UNBOUNDED PRECEDING) / sum(step) OVER (PARTITION BY sample), 9) * 100) AS bucket FROM g)
SELECT sample, barcode, n, rank, fraction, cum_fraction FROM b QUALIFY rank = last OR row_number() OVER (PARTITION BY sample, bucket ORDER BY rank, cum_fraction) = 1"""

ORACLE_SQL["subsample"] = f"WITH {A.PAIRS} SELECT name, flag FROM pairs WHERE ('0x' || substr(md5(name), 1, 8))::BIGINT % 1000000 < 100000"

ORACLE_SQL["clean_peaks"] = f"""WITH RECURSIVE {A.PEAKS}, {Q.SIZES}, c AS (SELECT chr, (start + stop) // 2 - 125 AS start, (start + stop) // 2 + 125 AS stop, name, score FROM peaks),
k AS (SELECT c.* FROM c JOIN sizes USING (chr) WHERE score >= 2 AND start >= 0 AND stop <= length AND NOT EXISTS (SELECT 1 FROM peaks p WHERE p.score > 1400 AND p.chr = c.chr AND c.start < p.stop AND p.start + 200 < c.stop)),
l AS (SELECT chr, list({{'start': start, 'stop': stop, 'name': name, 'score': score}} ORDER BY start, name) AS l FROM k GROUP BY chr UNION ALL
  SELECT chr, n FROM (SELECT chr, l, list_filter(l, lambda x, i: NOT (coalesce(i > 1 AND l[i - 1].stop > x.start AND l[i - 1].score >= x.score, false) OR coalesce(l[i + 1].start < x.stop AND l[i + 1].score > x.score, false))) AS n FROM l) WHERE len(n) < len(l))
SELECT chr, x.start AS start, x.stop AS stop, x.name AS name, x.score AS score FROM (SELECT chr, unnest(arg_min(l, len(l))) AS x FROM l GROUP BY chr)"""

ORACLE_SQL["correct_edge_umis"] = f"""WITH RECURSIVE {A.EDGES}, {A.CANON}, u AS (SELECT *, count(*) AS n FROM canon GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY bead1, bead2 ORDER BY n DESC, umi1, umi2) AS r FROM u),
near AS (SELECT a.bead1, a.bead2, a.r AS ra, b.r AS rb, a.umi1 AS a1, b.umi1 AS b1, a.umi2 AS a2, b.umi2 AS b2 FROM k a JOIN k b ON a.bead1 = b.bead1 AND a.bead2 = b.bead2 AND a.r <> b.r AND a.n >= 2 * b.n - 1 AND length(a.umi1) = length(b.umi1) AND length(a.umi2) = length(b.umi2)),
link AS (SELECT bead1, bead2, ra, rb FROM near WHERE CASE WHEN length(a1) = length(b1) AND length(a2) = length(b2) THEN hamming(a1, b1) + hamming(a2, b2) <= 1 ELSE false END),
reach AS (SELECT bead1, bead2, rb AS node, ra AS first FROM link UNION SELECT reach.bead1, reach.bead2, rb, first FROM reach JOIN link ON reach.bead1 = link.bead1 AND reach.bead2 = link.bead2 AND node = ra),
t AS (SELECT k.*, least(coalesce(f.first, r), r) AS head FROM k LEFT JOIN (SELECT bead1, bead2, node, min(first) AS first FROM reach GROUP BY ALL) f ON k.bead1 = f.bead1 AND k.bead2 = f.bead2 AND k.r = f.node)
SELECT t.bead1, h.umi1, t.bead2, h.umi2, sum(t.n)::BIGINT AS n, coalesce(sum(t.n) FILTER (t.r <> t.head), 0)::BIGINT AS corrected FROM t JOIN k h ON t.bead1 = h.bead1 AND t.bead2 = h.bead2 AND t.head = h.r GROUP BY ALL"""


@query(f"""WITH {A.CELL_GENE}, l AS (SELECT *, 1 - pow(1 - (('0x' || substr(md5('1|' || sample || '|' || cell || '|' || gene), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE, 1.0::DOUBLE / n) AS least FROM cell_gene),
m AS (SELECT (SELECT count(*) FROM lineitem)::DOUBLE / count(DISTINCT cell) AS mean FROM cell_gene), f AS (SELECT i / 25.0::DOUBLE AS fraction, round(i / 25.0::DOUBLE * mean)::BIGINT AS mean_depth FROM range(1, 26) t(i), m UNION ALL SELECT 20 / mean, 20 FROM m WHERE mean >= 20),
c AS (SELECT sample, cell, fraction, mean_depth, count(*) FILTER (least <= fraction) AS k FROM l, f GROUP BY ALL) SELECT sample, round(fraction, 9) AS fraction, mean_depth, median(k) AS median_features, count(*) AS cells FROM c GROUP BY ALL""")
def saturation_at_depth(spark, d):
    reads = A.table(spark, d, "lineitem").agg(F.count("*").alias("reads")).select(F.lit("s1").alias("sample"), "reads")
    out = rna.saturation(A.cell_gene(spark, d), total_reads=reads, depth=20)
    return out.withColumn("fraction", F.round("fraction", 9))


@query(f"WITH {A.FRAG} SELECT chr, start, stop, bead, support FROM frag")
def dedup_bead(spark, d):
    f = A.frag(spark, d)
    return merge_atac.dedup_bead(f.unionByName(f.filter("support > 2")).unionByName(f))


# the greedy star merge in order of counts: heads by a walk over the beads, droplets as what the edges of heads join
_MERGED = Q._SITES.replace("WITH ", "WITH RECURSIVE ", 1) + """, cut AS (SELECT quantile_cont(jaccard_frag, 0.99) AS cut FROM j WHERE jaccard_frag > 0), g AS (SELECT barc1 AS a, barc2 AS b FROM j, cut WHERE jaccard_frag > 0 AND jaccard_frag >= cut),
k AS (SELECT bead, row_number() OVER (ORDER BY n DESC, bead) AS r FROM c), e AS (SELECT x.r AS a, y.r AS b FROM g JOIN k x ON a = x.bead JOIN k y ON b = y.bead UNION SELECT y.r, x.r FROM g JOIN k x ON a = x.bead JOIN k y ON b = y.bead),
near AS (SELECT r, coalesce(list(b) FILTER (b IS NOT NULL), []) AS near FROM k LEFT JOIN e ON a = r GROUP BY r),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS heads UNION ALL SELECT i + 1, CASE WHEN list_has_any(near, heads) THEN heads ELSE list_append(heads, r) END FROM walk JOIN near ON r = i + 1),
h AS (SELECT unnest(arg_max(heads, i)) AS r FROM walk), t AS (SELECT a, b FROM e WHERE a IN (FROM h) OR b IN (FROM h)),
reach AS (SELECT r AS a, r AS b FROM k UNION SELECT reach.a, t.b FROM reach JOIN t ON reach.b = t.a), comp AS (SELECT a AS r, min(b) AS g FROM reach GROUP BY a),
d AS (SELECT g, max(r) FILTER (r IN (FROM h)) AS head, count(*) AS n_beads FROM comp GROUP BY g),
merged AS (SELECT k.bead, hk.bead AS droplet, n_beads FROM comp JOIN k USING (r) JOIN d USING (g) JOIN k hk ON hk.r = d.head)"""

ORACLE_SQL["merge_by_jaccard"] = _MERGED + " SELECT * FROM merged"
ORACLE_SQL["merged_cell_names"] = _MERGED + """, x AS (SELECT droplet, n_beads, row_number() OVER (ORDER BY n_beads DESC, droplet) AS number FROM (SELECT DISTINCT droplet, n_beads FROM merged))
SELECT bead, 'DemoS1BC' || lpad(number::VARCHAR, (SELECT length(max(number)::VARCHAR) FROM x)::INT, '0') || 'N' || n_beads AS cell, n_beads FROM merged JOIN x USING (droplet, n_beads)"""
ORACLE_SQL["deconvolution_metrics"] = _MERGED + """, v AS (SELECT (SELECT count(*) FROM j WHERE jaccard_frag > 0)::DOUBLE AS p, (SELECT count(*) FROM g)::DOUBLE AS a, (SELECT max(jaccard_frag) FROM j)::DOUBLE AS hi,
  (SELECT count(DISTINCT droplet) FROM merged)::DOUBLE AS d, (SELECT count(*) FROM merged)::DOUBLE AS b, (SELECT count(*) FROM merged WHERE n_beads > 1)::DOUBLE AS m, (SELECT sum(n) FROM c)::DOUBLE AS f)
SELECT unnest(['pairs_scored', 'pairs_above_threshold', 'highest_jaccard', 'droplets', 'beads', 'beads_in_multiplets', 'fragments']) AS metric, unnest([p, a, hi, d, b, m, f]) AS value FROM v"""


@query(f"WITH {A.FRAG}, b AS (SELECT DISTINCT bead FROM frag) SELECT bead, 'DemoS1BC' || lpad((row_number() OVER (ORDER BY bead))::VARCHAR, length((SELECT count(*) FROM b)::VARCHAR)::INT, '0') || 'N1' AS cell, 1::BIGINT AS n_beads FROM b")
def unmerged_cell_names(spark, d):
    return merge_atac.number_cells(merge_atac.merge_none(A.frag(spark, d)), "Demo_S1")


@query(f"""WITH {A.CELL_GENE}, c AS (SELECT cell, count(*) AS f FROM cell_gene GROUP BY cell) SELECT cell, f AS features, count(*) OVER () AS cells FROM c""")
def features_per_cell(spark, d):
    n = A.cell_gene(spark, d).groupBy("cell").agg(F.count("*").alias("features"))
    return n.crossJoin(F.broadcast(n.agg(F.count("*").alias("cells"))))  # one row


@query(f"""WITH {A.CELL_GENE}, x AS (SELECT cell, gene AS feature, ln(1 + n * 10000.0::DOUBLE / sum(n) OVER (PARTITION BY cell)) AS x FROM cell_gene), q AS (SELECT DISTINCT cell, cell::BIGINT % 3 AS cluster FROM cell_gene),
m AS (SELECT feature, cluster, count(*) AS k, sum(exp(x) - 1) AS s FROM x JOIN q USING (cell) GROUP BY ALL), n AS (SELECT cluster, count(*) AS n_in, (SELECT count(*) FROM q) AS n FROM q GROUP BY cluster), t AS (SELECT feature, sum(k) AS k, sum(s) AS s FROM m GROUP BY feature)
SELECT cluster, feature, round(m.k / n_in, 9) AS pct_in, round((t.k - m.k) / (n - n_in), 9) AS pct_out, round(log2((m.s / n_in + 1) / ((t.s - m.s) / (n - n_in) + 1)), 6) AS log2fc FROM m JOIN n USING (cluster) JOIN t USING (feature)""")
def marker_folds(spark, d):
    m = Q._normal(spark, d)
    clusters = m.select("cell", (F.col("cell").cast("long") % 3).alias("cluster")).distinct()
    out = ml.markers(m, clusters, 0.0, -99.0)
    return out.select("cluster", "feature", F.round("pct_in", 9).alias("pct_in"), F.round("pct_out", 9).alias("pct_out"), F.round("log2fc", 6).alias("log2fc"))


@query(f"WITH {A.PEAKS} SELECT *, row_number() OVER (ORDER BY score DESC, chr, start) AS place FROM peaks QUALIFY place <= 100")
def top_peaks(spark, d):
    from ..operators.barcodes import top_k

    best = top_k(A.peaks(spark, d), [], [F.desc("score"), "chr", "start"], 100)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("score"), "chr", "start")).cast("long"))  # 100 rows



_LOGLOG = Q._RANKED + ", c AS (SELECT sample, log10(rank) AS lx, log10(n) AS ly, max(log10(rank)) OVER s AS tx, max(log10(n)) OVER s AS ty FROM r WHERE n > 0 WINDOW s AS (PARTITION BY sample))"

ORACLE_SQL["kneedle_loglog"] = _LOGLOG + """, b AS (SELECT sample, tx, tx - lx AS rx, ty - ly AS ry FROM c),
q AS (SELECT *, (rx - min(rx) OVER s) / (max(rx) OVER s - min(rx) OVER s) AS x, (ry - min(ry) OVER s) / (max(ry) OVER s - min(ry) OVER s) AS y FROM b WINDOW s AS (PARTITION BY sample))
SELECT sample, round(pow(10.0::DOUBLE, any_value(tx) - arg_max(rx, (y - x, -rx))))::BIGINT AS knee FROM q GROUP BY sample"""

ORACLE_SQL["inflection"] = _LOGLOG + """, g AS (SELECT sample, floor(lx / greatest(tx, 1e-9::DOUBLE) * 50) AS b, avg(lx) AS lx, avg(ly) AS ly FROM c GROUP BY ALL),
s AS (SELECT sample, b, lx, (lead(ly) OVER w - lag(ly) OVER w) / (lead(lx) OVER w - lag(lx) OVER w) AS s FROM g WINDOW w AS (PARTITION BY sample ORDER BY b))
SELECT sample, round(pow(10.0::DOUBLE, arg_min(lx, (s, b))))::BIGINT AS inflection FROM s WHERE s IS NOT NULL GROUP BY sample"""

# components: each node takes the least label of its neighbours until none changes
ORACLE_SQL["merge_beads"] = """WITH RECURSIVE e AS (SELECT DISTINCT a.l_partkey::VARCHAR AS a, b.l_partkey::VARCHAR AS b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey),
cc(node, label) USING KEY (node) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, min(cc.label) FROM cc JOIN e ON cc.node = e.a JOIN recurring.cc AS old ON old.node = e.b WHERE cc.label < old.label GROUP BY e.b)
SELECT node AS bead, label AS droplet, count(*) OVER (PARTITION BY label) AS n_beads FROM cc"""

_ISLANDS = "sum(CASE WHEN start = prev THEN 0 ELSE 1 END) OVER (PARTITION BY {0} ORDER BY start) AS island FROM (SELECT *, lag(stop) OVER (PARTITION BY {0} ORDER BY start) AS prev FROM {1})"

ORACLE_SQL["build_saf"] = f"""WITH p AS (SELECT 'G' || p_partkey // 4 AS gene_id, 'chr' || ((p_partkey // 4) % 5) AS chr, CASE WHEN (p_partkey // 4) % 2 = 0 THEN '+' ELSE '-' END AS strand, (p_size > 30)::INT AS exon, p_partkey * 40 AS start, p_partkey * 40 + p_size AS stop FROM part),
g AS (SELECT gene_id, chr, strand, min(start) AS start, max(stop) AS stop FROM p GROUP BY ALL), z AS (SELECT chr, max(stop) + 100 AS length FROM g GROUP BY chr),
v AS (SELECT gene_id, chr, strand, unnest([start, stop]) AS pos, unnest([1, -1]) * exon AS x, unnest([1, -1]) * (1 - exon) AS u, 0 AS g FROM p UNION ALL SELECT gene_id, chr, strand, unnest([start, stop]), 0, 0, unnest([1, -1]) FROM g),
w AS (SELECT gene_id, chr, strand, pos AS start, lead(pos) OVER o AS stop, sum(sum(x)) OVER o AS x, sum(sum(u)) OVER o AS u, sum(sum(g)) OVER o AS g FROM v GROUP BY gene_id, chr, strand, pos WINDOW o AS (PARTITION BY gene_id, chr, strand ORDER BY pos)),
c AS (SELECT gene_id || '_' || CASE WHEN u > 0 THEN 'UTR' WHEN x > 0 THEN 'EXON' ELSE 'INTRON' END AS name, chr, strand, start, stop FROM w WHERE stop > start AND g > 0),
n AS (SELECT chr, strand, pos AS start, lead(pos) OVER o AS stop, sum(sum(a)) OVER o AS a, sum(sum(b)) OVER o AS b FROM (SELECT chr, strand, unnest([start, stop]) AS pos, unnest([1, -1]) AS a, 0 AS b FROM g
  UNION ALL SELECT chr, strand, unnest([0, length]), 0, unnest([1, -1]) FROM z, (SELECT unnest(['+', '-']) AS strand)) GROUP BY chr, strand, pos WINDOW o AS (PARTITION BY chr, strand ORDER BY pos)),
i AS (SELECT * FROM c UNION ALL SELECT 'INTERGENIC', chr, strand, start, stop FROM n WHERE stop > start AND a = 0 AND b > 0)
SELECT name, chr, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop, strand FROM (SELECT *, {_ISLANDS.format("name, chr, strand", "i")}) GROUP BY name, chr, strand, island"""
