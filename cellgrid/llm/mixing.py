"""Mixing sources to target weights, in DataFrame functions only.

A source's budget first buys complete epochs of it. The rest is drawn without replacement by Efraimidis-Spirakis keys:
an exponential variable divided by the document's weight, in rising order until the budget is spent. Running sums are
taken in two steps, over key ranges and then within one, so a source of any size is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
MOST = 3
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, rows, source_size) to the same with target; one row per source.

    Sources in order of code points, null last, weigh 5, 2, 1, 5, ... A target stops at 3 times its source; what is over
    is shared by weight among the others until none is above. In rising order of 3 * size / weight the sources that stop
    come first, so one running sum finds the level at which the rest share.
    """
    named = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(WEIGHTS))) + 1).cast("int")).cast("long"))
    by = Window.orderBy(MOST * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    level = (F.sum("source_size").over(whole) - zero(F.sum(MOST * F.col("source_size")).over(before))) / (F.sum("weight").over(whole) - zero(F.sum("weight").over(before)))
    levelled = named.withColumn("level", level).withColumn("stops", MOST * F.col("source_size") / F.col("weight") < F.col("level"))
    shared = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") * MOST / F.col("weight"), "level"))).over(whole)["level"]
    stop = (MOST * F.col("source_size")).cast("double")
    return levelled.select("source", "rows", "source_size", F.when(F.col("stops"), stop).otherwise(F.least(stop, F.col("weight") * shared)).alias("target"))


def mix(docs: DataFrame, weights: DataFrame | None = None, whole_rows: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per row of docs (doc_id, text, source, ...); with
    whole_rows also ``row``, a struct of all its columns.

    weights: (doc_id, weight), positive; the largest counts if an id has several, and 1 if it has none or it isn't
    positive. Whole documents are taken: ``taken`` is a multiple of ``size``, at most 3 times. A source's sum is within
    half a document of its target. A null or empty text has size 0, a null source is a source of its own, after the
    others. Rows with equal or null ids are drawn separately. An empty table gives an empty table. Keys come from ids and
    texts, so every run agrees.
    """
    text = F.col("text").cast("string")
    # 52 bits of a digest, as a uniform variable that is never 0
    digest = F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    more_columns = [F.struct("*").alias("row")] if whole_rows else []
    d = docs.select("doc_id", "source", word_count(text).alias("size"), u.alias("u"), *more_columns)
    if weights is not None:
        w = weights.filter("doc_id is not null and weight > 0").groupBy("doc_id").agg(F.max("weight").cast("double").alias("weight"))
        d = d.join(w, "doc_id", "left")
    else:
        d = d.withColumn("weight", F.lit(1.0))
    d = d.withColumn("key", -F.ln("u") / F.coalesce("weight", F.lit(1.0)))
    sources = targets(d.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size")))
    s = sources.select(F.col("source").alias("s"), "rows", "source_size", "target")
    # as many key ranges as rows in each
    d = d.join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    d = d.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * F.ceil(F.sqrt("rows"))))
    sums = d.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), earlier.alias("earlier"))
    d = d.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    within = F.sum("size").over(Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    epochs = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    more = (F.col("earlier") + within - F.col("size") / 2 <= rest) & (epochs < MOST)
    return d.select(*["row"] * whole_rows, "doc_id", "source", "size", "source_size", "target", (F.col("size") * (epochs + more.cast("long"))).cast("long").alias("taken"))


def label_weights(labels: DataFrame) -> DataFrame:
    """Quality weights: a document that is marked good counts twice, one that is marked bad half."""
    return labels.filter("quality is not null").select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(w.weight, 1.0)::DOUBLE AS key
  FROM documents LEFT JOIN (SELECT doc_id, max(CASE WHEN quality = 1 THEN 2.0 ELSE 0.5 END) AS weight FROM labels
    WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id) w USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
    (ARRAY[5, 2, 1])[((row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM d GROUP BY source),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER b, 0))::DOUBLE
    / ((SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM s WINDOW b AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN (3 * source_size)::DOUBLE / weight < level THEN (3 * source_size)::DOUBLE
    ELSE least((3 * source_size)::DOUBLE, weight * (SELECT arg_min(level, (3 * source_size)::DOUBLE / weight) FROM l
      WHERE (3 * source_size)::DOUBLE / weight >= level)) END AS target FROM l),
x AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::BIGINT AS epochs,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS running
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  (size * (epochs + CASE WHEN epochs < 3 AND running - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken FROM x
"""
