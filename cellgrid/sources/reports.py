"""Readers of tool reports, many files at once: tables in sections, histograms, contig counts, all as tidy rows.

A report is a few kilobytes, so a file is read as one value and its lines are told apart by their places in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a row of an alignment summary is about.
MATES = {"FIRST_OF_PAIR": "r1", "SECOND_OF_PAIR": "r2", "PAIR": "pair"}


def sample_of(path: Column) -> Column:
    """A file's name up to its first dot."""
    return F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)


def _lines(spark: SparkSession, path, sample) -> DataFrame:
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))
    return whole.withColumn("sample", (sample or sample_of)(F.col("path")))


def read_sections(spark: SparkSession, path, sample=None) -> DataFrame:
    """(sample, section, row, key, metric, text, value) of reports with sections: a line that starts with ## names one, and its
    first line that is neither empty nor a comment is the header of a tab-separated table.

    row counts from 1; key is the row's first field, metric the name of a field, text the field and value its number, or null
    if it is none. Fields beyond the header are left out, missing ones are null; a section without rows gives none, and so
    does a file without sections. sample: a function of the path's column, if not the file's name up to its first dot.
    """
    w = Window.partitionBy("path").orderBy("pos")
    named = F.when(F.col("line").startswith("##"), F.trim(F.regexp_extract("line", r"^##\s*([^\t]*)", 1)))
    marked = _lines(spark, path, sample).withColumn("section", F.last(named, True).over(w)).withColumn("_s", F.sum(F.col("line").startswith("##").cast("int")).over(w))
    body = marked.filter(~F.col("line").startswith("#") & (F.trim("line") != "") & (F.col("_s") > 0))
    own = Window.partitionBy("path", "_s").orderBy("pos")
    rows = body.withColumn("_head", F.split(F.first("line").over(own), "\t")).withColumn("row", F.row_number().over(own) - 1).filter("row > 0")
    field = F.split("line", "\t")
    cells = rows.select("sample", "section", "row", field[0].alias("key"), F.explode(F.transform("_head", lambda h, i: F.struct(h.alias("metric"), F.nullif(F.get(field, i), F.lit("")).alias("text")))).alias("c"))
    return cells.select("sample", "section", "row", "key", "c.metric", "c.text", F.expr("try_cast(c.text AS double)").alias("value"))


def alignment_summary(sections: DataFrame) -> DataFrame:
    """(sample, process, read, metric, value): the rows of tables whose first field is CATEGORY, by mate; shares in percent."""
    first = sections.filter("metric = 'CATEGORY'").select("sample", "section", "row")
    mate = F.coalesce(*[F.when(F.col("key") == k, v) for k, v in MATES.items()])
    value = F.when(F.contains("metric", F.lit("PCT")), 100 * F.col("value")).otherwise(F.col("value"))
    rows = sections.join(first, ["sample", "section", "row"], "left_semi").filter("metric <> 'CATEGORY' and value is not null")
    return rows.select("sample", F.lit("alignment_summary").alias("process"), mate.alias("read"), F.lower("metric").alias("metric"), value.alias("value"))


def insert_size_histogram(sections: DataFrame) -> DataFrame:
    """(sample, size, kind, n): the histogram by insert size; kind is the name of the counted column without its prefix."""
    rows = sections.filter(F.col("section").startswith("HISTOGRAM") & (F.col("metric") != "insert_size") & F.col("value").isNotNull())
    return rows.select("sample", F.expr("try_cast(key AS long)").alias("size"), F.regexp_replace("metric", r"^.*\.", "").alias("kind"), F.col("value").cast("long").alias("n")).filter("size is not null")


def one_row_metrics(sections: DataFrame) -> DataFrame:
    """(sample, metric, value) of the first row of each sample's tables of metrics; shares in percent, names in lower case."""
    rows = sections.filter(F.col("section").startswith("METRICS") & (F.col("row") == 1) & F.col("value").isNotNull())
    return rows.select("sample", F.lower("metric").alias("metric"), F.when(F.contains("metric", F.lit("PERCENT")), 100 * F.col("value")).otherwise(F.col("value")).alias("value"))


def contig_counts(spark: SparkSession, path, sample=None) -> DataFrame:
    """(sample, contig, length, mapped, unmapped) of contig count files: four tab-separated fields a line, * for no contig.
    Lines without numbers are left out."""
    f = F.split("line", "\t")
    number = lambda i: F.get(f, F.lit(i)).try_cast("long")
    rows = _lines(spark, path, sample).select("sample", f[0].alias("contig"), number(1).alias("length"), number(2).alias("mapped"), number(3).alias("unmapped"))
    return rows.dropna(subset=["mapped", "unmapped"])


def tidy_contig_counts(counts: DataFrame) -> DataFrame:
    """(sample, process, metric, value), a row for each contig and count."""
    names = {"length": "contig_length", "mapped": "reads_aligned", "unmapped": "reads_unaligned"}
    kinds = F.array(*[F.struct(F.concat("contig", F.lit(f"_{name}")).alias("metric"), F.col(c).cast("double").alias("value")) for c, name in names.items()])
    return counts.select("sample", F.explode(kinds).alias("m")).select("sample", F.lit("contig_counts").alias("process"), "m.metric", "m.value")
