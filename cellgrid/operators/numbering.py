"""Row numbers over whole tables: rows are sorted in ranges, and each range's numbers start after those of the ranges before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import checkpoint

_BITS = 33  # monotonically_increasing_id keeps a row's place within its partition in so many bits


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """df with a long column name: row numbers from 1 in the given order.

    Rows that are equal in the order are numbered in any order; nulls come where the order puts them; an empty table stays
    empty. The sorted ranges are checkpointed, so that a lost executor can't deal the rows anew under numbers that are
    given already. What is broadcast has one row per range.
    """
    at = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _BITS)
    sizes = at.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _BITS) - 1))
    return at.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_before") + place + 1).alias(name))


def in_ranges(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """df with the number of the range that a row is dealt to, in the given order; checkpointed, for the same reason."""
    return checkpoint(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()))
