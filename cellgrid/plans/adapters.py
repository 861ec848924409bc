"""Views of the driver's tables as fragments, peaks, edges, counts and reads, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHRS = ["AF", "AO", "NF", "NO", "RF", "RO"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frag(spark, d) -> DataFrame:
    """(chr, start, stop, bead, support), distinct but for support."""
    li = table(spark, d, "lineitem")
    start = F.col("l_partkey") * 100
    return li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("chr"), start.alias("start"), (start + 50 + F.col("l_quantity").cast("long")).alias("stop"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("bead")).agg(F.max("l_linenumber").cast("long").alias("support"))


FRAG = """frag AS (SELECT l_returnflag || l_linestatus AS chr, l_partkey * 100 AS start, l_partkey * 100 + 50 + l_quantity::BIGINT AS stop,
  'S' || l_suppkey AS bead, max(l_linenumber)::BIGINT AS support FROM lineitem GROUP BY 1, 2, 3, 4)"""


def peaks(spark, d) -> DataFrame:
    """(chr, start, stop, name, score), overlapping, on every contig."""
    p = table(spark, d, "part").filter("p_size > 40")
    return p.select(F.explode(F.array(*map(F.lit, CHRS))).alias("chr"), (F.col("p_partkey") * 100 - 125).alias("start"), (F.col("p_partkey") * 100 + 125).alias("stop"), "p_partkey", F.col("p_retailprice").alias("score")).select("chr", "start", "stop", F.concat_ws("-", "chr", "p_partkey").alias("name"), "score")


PEAKS = """peaks AS (SELECT chr, p_partkey * 100 - 125 AS start, p_partkey * 100 + 125 AS stop, chr || '-' || p_partkey AS name, p_retailprice AS score
  FROM part, (SELECT unnest(['AF', 'AO', 'NF', 'NO', 'RF', 'RO']) AS chr) WHERE p_size > 40)"""


def cell_frag(spark, d) -> DataFrame:
    """Fragments with a cell, several beads each, and a read name."""
    number = F.substring("bead", 2, 20).cast("long")
    return frag(spark, d).withColumn("cell", F.concat(F.lit("C"), (number % 37).cast("string"))).withColumn("read_name", F.concat_ws(":", "chr", "start", "stop", "bead"))


CELL_FRAG = FRAG + """, cell_frag AS (SELECT *, 'C' || (substr(bead, 2)::BIGINT % 37) AS cell, chr || ':' || start || ':' || stop || ':' || bead AS read_name FROM frag)"""


def edges(spark, d) -> DataFrame:
    """Beads (suppliers) that meet in an order, with UMIs (parts); some UMIs hold an N."""
    li = table(spark, d, "lineitem")
    umi = F.concat(F.when(F.col("l_partkey") % 17 == 0, "N").otherwise("A"), F.col("l_partkey").cast("string"))
    side = lambda i: li.select("l_orderkey", F.col("l_linenumber").alias(f"n{i}"), F.col("l_suppkey").cast("string").alias(f"bead{i}"), umi.alias(f"umi{i}"))
    return side(1).join(side(2), "l_orderkey").filter("n1 < n2").select("bead1", "umi1", "bead2", "umi2")


EDGES = """edges AS (SELECT a.l_suppkey::VARCHAR AS bead1, (CASE WHEN a.l_partkey % 17 = 0 THEN 'N' ELSE 'A' END) || a.l_partkey AS umi1,
  b.l_suppkey::VARCHAR AS bead2, (CASE WHEN b.l_partkey % 17 = 0 THEN 'N' ELSE 'A' END) || b.l_partkey AS umi2
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber)"""

CANON = """canon AS (SELECT CASE WHEN (bead1, umi1) <= (bead2, umi2) THEN bead1 ELSE bead2 END AS bead1, CASE WHEN (bead1, umi1) <= (bead2, umi2) THEN umi1 ELSE umi2 END AS umi1,
  CASE WHEN (bead1, umi1) <= (bead2, umi2) THEN bead2 ELSE bead1 END AS bead2, CASE WHEN (bead1, umi1) <= (bead2, umi2) THEN umi2 ELSE umi1 END AS umi2 FROM edges)"""


def reads(spark, d) -> DataFrame:
    """RNA reads: cell, contig with species, gene, feature class, status, UMI, mapq."""
    li, o, p = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "part")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    kind = F.substring_index("p_type", " ", 1)
    sp = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "hs").otherwise("mm")
    feature = F.when(kind == "STANDARD", "EXON").when(kind == "SMALL", "UTR").when(kind == "MEDIUM", "INTRON").when(kind == "LARGE", "INTERGENIC")
    gene = F.when(feature.isin("EXON", "UTR"), F.col("p_brand")).otherwise(feature)
    status = F.when(kind == "ECONOMY", "Unassigned_Ambiguity").when(kind == "PROMO", "Unassigned_MappingQuality").otherwise("Assigned")
    return j.select(
        F.col("o_custkey").cast("string").alias("cell"), F.concat(F.lit("B"), F.col("l_suppkey").cast("string")).alias("bead"),
        F.concat_ws(".", sp, F.when(F.col("l_linenumber") == 7, "MT").otherwise(F.concat(F.lit("chr"), F.col("l_returnflag")))).alias("contig"),
        gene.alias("gene"), feature.alias("feature"), status.alias("status"), F.col("l_orderkey").cast("string").alias("umi"), (F.col("p_size") > 45).alias("ribosomal"),
        F.col("p_size").alias("mapq"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("name"),
    )


READS = """reads AS (SELECT o_custkey::VARCHAR AS cell, 'B' || l_suppkey AS bead,
    (CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'hs' ELSE 'mm' END) || '.' || (CASE WHEN l_linenumber = 7 THEN 'MT' ELSE 'chr' || l_returnflag END) AS contig,
    CASE WHEN kind IN ('STANDARD', 'SMALL') THEN p_brand WHEN kind = 'MEDIUM' THEN 'INTRON' WHEN kind = 'LARGE' THEN 'INTERGENIC' END AS gene,
    CASE kind WHEN 'STANDARD' THEN 'EXON' WHEN 'SMALL' THEN 'UTR' WHEN 'MEDIUM' THEN 'INTRON' WHEN 'LARGE' THEN 'INTERGENIC' END AS feature,
    CASE kind WHEN 'ECONOMY' THEN 'Unassigned_Ambiguity' WHEN 'PROMO' THEN 'Unassigned_MappingQuality' ELSE 'Assigned' END AS status,
    l_orderkey::VARCHAR AS umi, p_size > 45 AS ribosomal, p_size AS mapq, l_orderkey || '_' || l_linenumber AS name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN (SELECT *, split_part(p_type, ' ', 1) AS kind FROM part) ON l_partkey = p_partkey)"""


def cell_gene(spark, d) -> DataFrame:
    """(sample, cell, gene, n): distinct UMIs per cell and gene."""
    from ..operators.rna import umi_matrix

    return umi_matrix(reads(spark, d)).select(F.lit("s1").alias("sample"), "cell", "gene", "n")


CELL_GENE = READS + """, cell_gene AS (SELECT 's1' AS sample, cell, gene, count(DISTINCT umi) AS n FROM reads WHERE feature IN ('EXON', 'UTR') GROUP BY ALL)"""


def bead_counts(spark, d) -> DataFrame:
    """(sample, barcode, n): orders per customer, by order status as the sample."""
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("sample"), F.col("o_custkey").cast("string").alias("barcode")).agg(F.sum(F.floor(F.col("o_totalprice") / 1000)).alias("n"))


BEAD_COUNTS = """bead_counts AS (SELECT o_orderstatus AS sample, o_custkey::VARCHAR AS barcode, sum(floor(o_totalprice / 1000))::BIGINT AS n FROM orders GROUP BY 1, 2)"""


def pairs(spark, d) -> DataFrame:
    """Read pairs as alignments: two mates per order line, with flags."""
    li = table(spark, d, "lineitem")
    m = F.explode(F.array(F.lit(1), F.lit(2)))
    a = li.select("*", m.alias("mate"))
    swap = F.col("l_linenumber") % 3 == 0
    back = F.when(swap, F.col("mate") == 1).otherwise(F.col("mate") == 2)
    flag = F.lit(0x3) + F.when(F.col("mate") == 1, 0x40).otherwise(0x80) + F.when(back, 0x10).otherwise(0x20) + F.when(F.col("l_tax") > 0.07, 0x400).otherwise(0) + F.when((F.col("l_discount") > 0.09) & (F.col("mate") == 2), 0x100).otherwise(0)
    pos = F.col("l_partkey") * 100 + F.when(back, 50 + F.col("l_quantity").cast("long")).otherwise(0)
    return a.select(
        F.lit("s1").alias("sample"), F.concat("l_returnflag", "l_linestatus").alias("contig"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("name"), flag.cast("int").alias("flag"),
        pos.alias("pos"), (pos + 40).alias("end"), (F.col("l_suppkey") % 40 + 21).cast("int").alias("mapq"), (F.when(back, -1).otherwise(1) * (90 + F.col("l_quantity").cast("int"))).alias("tlen"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("bead"),
    )


PAIRS = """pairs AS (SELECT 's1' AS sample, l_returnflag || l_linestatus AS contig, l_orderkey || '_' || l_linenumber AS name,
    (3 + CASE WHEN mate = 1 THEN 64 ELSE 128 END + CASE WHEN back THEN 16 ELSE 32 END + CASE WHEN l_tax > 0.07 THEN 1024 ELSE 0 END + CASE WHEN l_discount > 0.09 AND mate = 2 THEN 256 ELSE 0 END)::INT AS flag,
    l_partkey * 100 + CASE WHEN back THEN 50 + l_quantity::BIGINT ELSE 0 END AS pos, l_partkey * 100 + CASE WHEN back THEN 50 + l_quantity::BIGINT ELSE 0 END + 40 AS "end",
    (l_suppkey % 40 + 21)::INT AS mapq, (CASE WHEN back THEN -1 ELSE 1 END * (90 + l_quantity::INT))::INT AS tlen, 'S' || l_suppkey AS bead
  FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN mate = 1 ELSE mate = 2 END AS back FROM lineitem, (SELECT unnest([1, 2]) AS mate)))"""


def metrics_long(spark, d) -> DataFrame:
    return table(spark, d, "events").select((F.col("user_id") % 20).cast("string").alias("sample"), F.concat_ws("-", "event_type", F.col("user_id") % 3).alias("process"), F.col("event_type").alias("metric"), F.floor("value").cast("double").alias("value"))


METRICS = """metrics_long AS (SELECT (user_id % 20)::VARCHAR AS sample, event_type || '-' || (user_id % 3) AS process, event_type AS metric, floor(value)::DOUBLE AS value FROM events)"""


def doc_reads(spark, d) -> DataFrame:
    """Reads with a packed name: plate and bead, UMI, number; letters of texts as bases. Qualities are 40, 31, 20 and 10 by base."""
    t = F.upper(F.regexp_replace("text", "[^a-zA-Z]", ""))
    seq = F.translate(F.translate(t, "BDEFHIJKLM", "ACGTACGTAC"), "NOPQRSUVWXYZ", "GTACGTACGTAC")
    return table(spark, d, "documents").select(F.lower("source").alias("sample"), F.concat_ws("_", F.concat(F.lit("BEAD"), F.lpad((F.col("doc_id") % 23).cast("string"), 4, "0")), F.col("lang"), F.col("doc_id").cast("string")).alias("name"), seq.alias("seq"), F.translate(seq, "ACGT", "I@5+").alias("qual"))


DOC_READS = """doc_reads AS (SELECT lower(source) AS sample, 'BEAD' || lpad((doc_id % 23)::VARCHAR, 4, '0') || '_' || lang || '_' || doc_id AS name, seq, translate(seq, 'ACGT', 'I@5+') AS qual
  FROM (SELECT *, translate(translate(upper(regexp_replace(text, '[^a-zA-Z]', '', 'g')), 'BDEFHIJKLM', 'ACGTACGTAC'), 'NOPQRSUVWXYZ', 'GTACGTACGTAC') AS seq FROM documents))"""
