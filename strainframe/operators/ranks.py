"""Places and running totals over whole tables, without all rows in one task.

Rows are dealt to ranges of the order and sorted inside each; what comes
before a range is carried over from a table with one row for each range.  The
ranges are written before they are used twice, as their bounds come from a
sample that another evaluation may draw anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed

#: Bits that number the rows of a partition.
ROW_BITS = 33


def ranged(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """``df`` with ``_range`` and ``_row``, the place inside the range, both ascending in ``order``."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    return checkpointed(placed).withColumn("_range", F.shiftright("_row", ROW_BITS)).withColumn("_row", F.col("_row").bitwiseAND((1 << ROW_BITS) - 1))


def numbered(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1."""
    rows = ranged(df, order)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row for each range, as many as there are partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_range", "_row", "_before")


def running(df: DataFrame, order: list[str | Column], name: str, total: str | None = None, least: Column | None = None) -> DataFrame:
    """``df`` with the sum of ``total``, or the smallest ``least``, of all rows up to each in ``order``."""
    rows = ranged(df, order)
    of = F.sum(total) if total else F.min(least)
    inside = of.over(Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0))
    parts = rows.groupBy("_range").agg(of.alias("_of"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_range", (F.sum("_of") if total else F.min("_of")).over(earlier).alias("_before"))
    both = F.coalesce("_before", F.lit(0)) + inside if total else F.least("_before", inside)
    return rows.join(F.broadcast(before), "_range").withColumn(name, both).drop("_range", "_row", "_before")
