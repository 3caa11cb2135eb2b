"""Ranks and running sums over a global order, without a window that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import stage_table


def sums_before(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows before this one in ``order``, NULLs first.

    Rows are cut into ranges; a range is summed by a window of its own, and the sums of
    whole ranges, one row each, give where it starts. ``order`` has to tell rows apart.
    """
    ranges = stage_table(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "_range")
        .select(*df.columns, (F.col("_start") + F.col("_inside")).alias(name))
    )
