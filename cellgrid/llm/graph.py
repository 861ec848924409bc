"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _least(near: DataFrame) -> DataFrame:
    """near (u, v) with the least of u and its neighbours as m. It is joined back, so a hub's neighbours never meet in one task.
    A merge join, as in all loops over saved tables (see Scratch)."""
    return near.join(near.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).hint("merge"), "u")


def _pairs(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v): the named pairs of columns of each row, read in one pass."""
    return edges.select(F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs])))


def _round(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step over edges (u, v) with v < u. Rows are made distinct once, at the end: the first
    step makes no more rows than it gets."""
    large = _least(_pairs(edges, ("u", "v"), ("v", "u"))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _pairs(_least(large), ("v", "m"), ("u", "m")).filter("u > v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node that has a smaller neighbour has no other edge: nothing is left to do then."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))))
    return ends.groupBy("node").agg(F.max("up").alias("up"), F.count("*").alias("k")).filter("up = 1 and k > 1").agg(F.count("*")).first()[0] == 0


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(u, v): each node that has an edge and isn't the least of its component, and that least node.

    edges: columns (a, b) of one orderable type; loops, nulls and repeated edges are ignored.
    """
    now = scratch.save(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    for i in range(1, 100):
        now = scratch.save(_round(now), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        if _stars(now):
            return now
    raise RuntimeError("components did not settle")
