"""Connected components and independent sets by rounds of joins, cut with tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares. One is set here only where nobody has and all runs on this machine, as in tests."""
    if path := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return path
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir()


def checkpoint(df: DataFrame, _: int = 0) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Saved:
    """Large tables of one call in the shared folder, in columns. Unlike with a checkpoint, the plan that made a table is gone once
    it is written, and so the shuffle files behind it can go before the next step writes its own."""

    released, EVERY = -10.0, 10  # by the clock of the process, by any call; seconds between two, as full collections in a row make the heap grow

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark).rstrip('/')}/saved-{uuid.uuid4().hex}", 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(path := f"{self.root}/{self.n}")
        if time.monotonic() - Saved.released >= self.EVERY:  # Spark deletes shuffle files when the driver's collector finds their handles
            self.spark._jvm.System.gc()
            Saved.released = time.monotonic()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, n: int) -> None:
        """Removes the n-th table, which no later job reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b): the component is its smallest node. Loops keep their node as a component.

    Alternating large-star and small-star steps; the minimum is joined back to the edges, so a hub is a skewed join key
    and never one task's group.
    """
    down, saved = F.col("a") > F.col("b"), Saved(edges.sparkSession)
    # loops and nulls are kept for the list of nodes, so that edges are made once
    first = saved(edges.select(F.when(down, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(down, F.col("b")).otherwise(F.col("a")).alias("v")).distinct())
    nodes = first.select(F.col("u").alias("node")).union(first.select(F.col("v").alias("node"))).distinct()
    now = first.filter("u <> v")
    was = None
    while True:
        near = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # repeats are left to the end of the round: to drop them here as well is one more shuffle of all edges
        large = near.join(near.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        now = saved(small)
        if saved.n > 2:  # the first table has the nodes
            saved.drop(saved.n - 1)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == was or not mark[0]:
            break
        was = mark
    return nodes.join(now.select(F.col("u").alias("node"), "v"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))


def first_independent_set(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes of the lexicographically first maximal independent set. nodes: (node, rank), edges: (a, b).

    A node is in if all its neighbours of smaller rank are out. One without such neighbours is in at once; one with a single
    undecided one is the opposite of it, and so chains of these are decided together, by pointers that double in length.
    A round takes in what is decided so and drops its neighbours. Ranks are distinct; an empty table gives an empty one.
    """
    both = edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    ranked = both.join(nodes.select(F.col("node").alias("a"), F.col("rank").alias("ra")), "a").join(nodes.select(F.col("node").alias("b"), F.col("rank").alias("rb")), "b")
    left, heads = checkpoint(nodes.select("node", "rank")), None
    ranked = checkpoint(ranked)
    while not left.isEmpty():
        before = ranked.filter("rb < ra").groupBy(F.col("a").alias("node")).agg(F.count("*").alias("d"), F.min("b").alias("to"))
        at = checkpoint(left.join(before, "node", "left"))
        jump = at.filter("d = 1").select("node", "to", F.lit(True).alias("odd"))
        while True:
            further = jump.select(F.col("node").alias("to"), F.col("to").alias("far"), F.col("odd").alias("more"))
            jump = checkpoint(jump.join(further, "to", "left").select("node", F.coalesce("far", "to").alias("to"), (F.col("odd") != F.coalesce("more", F.lit(False))).alias("odd"), F.col("far").isNotNull().alias("moved")))
            if jump.filter("moved").isEmpty():
                break
            jump = jump.drop("moved")
        free = at.filter("d is null").select("node", "rank")
        even = jump.filter("not odd").join(free.select(F.col("node").alias("to")), "to", "left_semi").select("node")
        new = checkpoint(free.union(at.select("node", "rank").join(even, "node", "left_semi")))
        heads = new if heads is None else heads.union(new)
        out = ranked.join(new.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).union(new.select("node")).distinct()
        left = checkpoint(left.join(out, "node", "left_anti"))
        gone = out.select(F.col("node").alias("a"))
        ranked = checkpoint(ranked.join(gone, "a", "left_anti").join(gone.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b", "ra", "rb"))
    return heads if heads is not None else nodes.select("node", "rank").limit(0)
