"""Readers and writers of the text formats of the field. Each gives a DataFrame with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import numbered


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(name, seq, qual, path) of FASTQ files with records of four lines, in any store that Spark reads.

    Text is split where a line starts with @, which a quality line may do as well: such a record comes in two pieces, of
    three lines and of one. Only these pieces are ordered, within their split of the file, and put together again; what a
    split's end has torn meets over the splits of the file, two pieces each at most.
    """
    text = spark.read.option("lineSep", "\n@").text(path)
    place = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_i")
    lines = F.split(F.regexp_replace("value", "\n$", ""), "\n")
    # the first piece of a file still has its @; a piece of one line is the rest of a quality, and keeps it
    named = F.when(F.size("l") > 1, F.concat(F.array(F.regexp_replace(F.col("l")[0], "^@", "")), F.slice("l", 2, 3))).otherwise(F.col("l"))
    pieces = text.select(lines.alias("l"), *place).withColumn("l", named)

    def met(torn: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy("path", *keys).orderBy("_block", "_i")
        after, before = F.lead("l").over(w), F.lag("l").over(w)
        return torn.withColumn("_next", F.when((F.size("l") == 3) & (F.size(after) == 1), after)).withColumn("_used", F.coalesce((F.size("l") == 1) & (F.size(before) == 3), F.lit(False)))

    within = met(pieces.filter(F.size("l") < 4), "_block")
    across = met(within.filter(F.col("_next").isNull() & ~F.col("_used")).drop("_next", "_used"))
    torn = within.unionByName(across).filter(F.col("_next").isNotNull())
    mended = torn.select(F.concat("l", F.array(F.concat(F.lit("@"), F.col("_next")[0]))).alias("l"), "path")
    whole = pieces.filter(F.size("l") >= 4).select("l", "path").unionByName(mended)
    return whole.select(F.split(F.col("l")[0], " ")[0].alias("name"), F.col("l")[1].alias("seq"), F.col("l")[3].alias("qual"), "path")


def merge_lanes(reads: DataFrame) -> DataFrame:
    """Adds sample (the file name without its lane and mate) and mate to reads with a path."""
    file = F.element_at(F.split("path", "/"), -1)
    return reads.withColumn("sample", F.regexp_replace(file, r"_L\d{3}|_R[12](_\d{3})?|\.(fastq|fq)(\.gz)?$", "")).withColumn("mate", F.regexp_extract(file, r"_R([12])", 1).cast("int"))


def mixed_compression(reads: DataFrame) -> DataFrame:
    """Samples whose lanes are partly compressed."""
    return reads.groupBy("sample").agg(F.countDistinct(F.col("path").endswith(".gz")).alias("kinds")).filter("kinds > 1").select("sample")


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments of SAM text with flags, positions from 0, and tags as a map (S3). Hot tags are columns by their names."""
    f = F.split("value", "\t")
    tags = F.map_from_entries(F.transform(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 20))))
    # the reference bases that an alignment spans: M, D, N, = and X of its CIGAR string
    span = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), 1), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    a = spark.read.text(path).filter(~F.col("value").startswith("@")).select(F.col("value"), f[0].alias("name"), f[1].cast("int").alias("flag"), f[2].alias("contig"), (f[3].cast("long") - 1).alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[8].cast("int").alias("tlen"), tags.alias("tags")).drop("value")
    return a.withColumn("end", F.col("pos") + span).select("*", *[F.col("tags")[t].alias(t) for t in ("XB", "XC", "XM", "XT", "XS")])


def _tsv(spark: SparkSession, path, schema: str, **options) -> DataFrame:
    return spark.read.csv(path, schema=schema, sep="\t", **options)


def read_fragments(spark: SparkSession, path) -> DataFrame:
    """Bead-level fragments."""
    return _tsv(spark, path, "chr string, start long, stop long, read_name string, orientation string, support long")


def read_bed(spark: SparkSession, path) -> DataFrame:
    """Intervals; lines that start with # are comments."""
    return _tsv(spark, path, "chr string, start long, stop long, name string, score double, strand string", comment="#")


def read_gtf(spark: SparkSession, path) -> DataFrame:
    """Features with their ids; starts count from 0, kinds are in lower case."""
    raw = _tsv(spark, path, "chr string, source string, kind string, start long, stop long, score string, strand string, frame string, attr string", comment="#", quote="")
    get = lambda k: F.nullif(F.regexp_extract("attr", f'(?:^|[ ;]){k} "([^"]+)"', 1), F.lit(""))
    return raw.select("chr", (F.col("start") - 1).alias("start"), "stop", "strand", F.lower("kind").alias("kind"), get("gene_id").alias("gene_id"), get("gene_name").alias("gene_name"), F.coalesce(get("gene_biotype"), get("gene_type")).alias("biotype"))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(chr, length) of a FASTA index, or (chr, null) of a FASTA file's headers."""
    if path.endswith(".fai"):
        return _tsv(spark, path, "chr string, length long, o long, b long, w long").select("chr", "length")
    return spark.read.text(path).filter(F.col("value").startswith(">")).select(F.regexp_extract("value", r"^>(\S+)", 1).alias("chr"), F.lit(None).cast("long").alias("length"))


def read_edges(spark: SparkSession, path) -> DataFrame:
    """The first four columns of edge lists, as strings."""
    return _tsv(spark, path, "bead1 string, umi1 string, bead2 string, umi2 string", mode="PERMISSIVE")


def read_barcode_map(spark: SparkSession, path, dialect: str = "rna") -> DataFrame:
    """(bead, cell, n_beads): commas with a header, or (dialect "atac") two tab columns without one."""
    if dialect == "rna":
        return spark.read.csv(path, schema="bead string, cell string, n_beads long", header=True, enforceSchema=True)
    m = _tsv(spark, path, "bead string, cell string")
    return m.join(m.groupBy("cell").agg(F.count("*").alias("n_beads")), "cell").select("bead", "cell", "n_beads")


def line_numbers(spark: SparkSession, path, name: str = "n") -> DataFrame:
    """(value, n): the lines of text files and their numbers from 1, by path and then by place, over all files."""
    place = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")]
    return numbered(spark.read.text(path).select("value", *place), ["_path", "_block", "_row"], name).select("value", name)


def read_allowlist(spark: SparkSession, path) -> DataFrame:
    """(bead, rank): line numbers from 1, by the line's place in its file; what follows a comma, and empty lines, are left out."""
    return line_numbers(spark, path, "rank").select(F.trim(F.split("value", ",")[0]).alias("bead"), "rank").filter("bead <> ''")


def read_mtx(spark: SparkSession, mtx: str | list[str], barcodes: str, features: str) -> DataFrame:
    """(cell, feature, n) of a coordinate matrix with its label files (S11). Labels in several part files count in the order
    of the files' names."""
    labels = lambda path, name, i: line_numbers(spark, path, i).select(F.split("value", "\t")[0].alias(name), i)
    f = F.split(F.trim("value"), " +")
    # the line of dimensions is the one right after the header in the file that has a header
    head = F.col("value").startswith("%")
    body = spark.read.text(mtx).select("value", F.input_file_name().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    dims = body.groupBy("_p").agg(F.count_if(head).alias("_h"), F.min(F.when(~head, F.col("_m"))).alias("_first")).filter("_h > 0").select(F.col("_first").alias("_m"))
    triples = body.filter(~head).join(F.broadcast(dims), "_m", "left_anti").select(f.alias("f")).select(F.col("f")[0].cast("long").alias("_f"), F.col("f")[1].cast("long").alias("_c"), F.col("f")[2].cast("long").alias("n"))  # a line per file
    return triples.join(labels(features, "feature", "_f"), "_f").join(labels(barcodes, "cell", "_c"), "_c").select("cell", "feature", "n")


def read_metrics(spark: SparkSession, path, schema: str = "sample string, process string, metric string, value double") -> DataFrame:
    """All metric files under a path; files that hold a header only add nothing."""
    return spark.read.csv(path, schema=schema, header=True)


REPORTS = {
    "flagstat": r"(?m)^(\d+) \+ \d+ ([a-z][^(\n]*?) *(?:\(|$)",
    "cutadapt": r"(?m)^((?:Total|Reads|Pairs)[^:\n]*): +([\d,]+)",
}


def parse_report(spark: SparkSession, kind: str, path) -> DataFrame:
    """(sample, metric, value) of many tool reports at once; the sample is the file name up to its first dot."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/.]+)[^/]*$", 1).alias("sample"), "value")
    if kind in ("flagstat", "cutadapt"):
        p = REPORTS[kind]
        n, m = (1, 2) if kind == "flagstat" else (2, 1)
        rows = F.explode(F.arrays_zip(F.regexp_extract_all("value", F.lit(p), m).alias("metric"), F.regexp_extract_all("value", F.lit(p), n).alias("value"))).alias("r")
        return whole.select("sample", rows).select("sample", F.trim("r.metric").alias("metric"), F.regexp_replace("r.value", ",", "").cast("double").alias("value"))
    # tables: a header line and a line of values below a line that starts with ## METRICS CLASS
    head, body = (F.split(F.regexp_extract("value", r"(?m)^## METRICS CLASS.*\n(.*)\n(.*)", i), "\t") for i in (1, 2))
    rows = whole.select("sample", F.explode(F.arrays_zip(head.alias("metric"), body.alias("value"))).alias("r"))
    return rows.select("sample", "r.metric", F.expr("try_cast(r.value as double)").alias("value")).filter("value is not null")


# sinks


def write_mtx(counts: DataFrame, path: str) -> None:
    """matrix, barcodes and features under a path, with ids from 1 in the order of the labels (S14). Labels come in part
    files whose names keep that order."""
    cells, features = (numbered(counts.select(c).distinct(), [c], i) for c, i in (("cell", "_c"), ("feature", "_f")))
    cells.orderBy("_c").select("cell").write.text(f"{path}/barcodes")
    features.orderBy("_f").select("feature").write.text(f"{path}/features")
    dims = f"{features.count()} {cells.count()} {counts.count()}"
    counts.sparkSession.range(1).select(F.concat(F.lit(f"%%MatrixMarket matrix coordinate integer general\n{dims}")).alias("value")).coalesce(1).write.text(f"{path}/matrix_head")
    counts.join(cells, "cell").join(features, "feature").select(F.concat_ws(" ", "_f", "_c", "n")).write.text(f"{path}/matrix")


def write_fragments(frags: DataFrame, path: str) -> None:
    """Fragments in coordinate order over files."""
    frags.repartitionByRange("chr", "start").sortWithinPartitions("chr", "start", "stop").write.csv(path, sep="\t", compression="gzip")


def split_by(df: DataFrame, key: str, path: str, known: list | None = None) -> None:
    """A folder per value of key; rows of an unknown key are left out."""
    (df if known is None else df.filter(F.col(key).isin(known))).write.partitionBy(key).parquet(path)


def write_table(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.csv(path, header=True, sep=sep)
