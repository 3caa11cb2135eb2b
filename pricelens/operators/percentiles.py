"""Exact interpolated percentiles that never gather a group in one place.

The built-in exact percentile keeps a map of every distinct value of a group in one
task, which fails once a group is large. Here values are narrowed by radix: a double's
bits are read as a whole number of the same order (``functions.bits``), and each round
counts rows per group and next ``RADIX_BITS`` bits with partial sums. The cell that
holds the wanted rank is the next bracket. A bracket from ``lo`` to ``hi`` only has to
tell apart the bits below those that both share, so a round settles ``RADIX_BITS`` of
them, and 64 bits are settled in six rounds whatever the values are.

The first round needs no bracket: it counts by sign and exponent, which also gives the
number of rows. Rows of the brackets that are then still open are stored once, and later
rounds read those only. All state is partial counts: a task sends ``2 ** RADIX_BITS``
short rows a bracket at most, however many rows a group holds.

``approximate_percentiles`` reads the input once instead, with mergeable sketches that
are merged in two levels: tasks to slices, slices to the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.bits import MANTISSA_BITS, with_order_key
from pricelens.operators.columns import long_values, name_at
from pricelens.session import join_on, stage_table
from pricelens.storage import storage

RADIX_BITS = 11
#: Bits below the sign and the exponent but its last bit: what the first round leaves open.
FIRST_SHIFT = MANTISSA_BITS + 1
SLICES = 64


def percentile_name(percentage: float) -> str:
    """0.25 -> ``p25``, 0.999 -> ``p99_9``."""
    return "p" + f"{percentage * 100:.6g}".replace(".", "_")


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], percentages: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group and column: ``n`` and one column per percentage.

    Infinities count as the values they are. The input is read three times: hand in a
    stored frame.
    """
    keys = [*by, "position"]
    values = with_order_key(long_values(df, columns, by), "value", "key")
    with storage(df.sparkSession) as own:
        cell = F.when(F.col("value").isNotNull(), F.shiftright("key", FIRST_SHIFT))
        cells = stage_table(_counted(values, keys, cell), "cells")
        totals = cells.groupBy(*keys).agg(F.sum("rows").alias("n"))
        found = _order_statistics(values.filter(F.col("value").isNotNull()), cells, _ranks(totals, percentages), keys)
        by_rank = found.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("rank", "least"))).alias("at")
        )
        out = join_on(totals, by_rank, keys, "left").select(
            *by,
            name_at(columns, F.col("position")).alias("column"),
            "n",
            *[_interpolate(p).alias(percentile_name(p)) for p in percentages],
        )
        return own.result(out, "percentiles")


def _position(percentage: float) -> Column:
    return F.lit(percentage) * (F.col("n") - 1)


def _interpolate(percentage: float) -> Column:
    position = _position(percentage)
    low, high = F.floor(position), F.ceil(position)
    return F.when(low == high, F.col("at")[low]).otherwise(
        (high - position) * F.col("at")[low] + (position - low) * F.col("at")[high]
    )


def _ranks(totals: DataFrame, percentages: Sequence[float]) -> DataFrame:
    """One row per order statistic that a percentile needs."""
    ends = [end(_position(p)) for p in percentages for end in (F.floor, F.ceil)]
    return totals.filter(F.col("n") > 0).withColumn("rank", F.explode(F.array_distinct(F.array(*ends)))).drop("n")


def _counted(values: DataFrame, bracket: Sequence[str], cell: Column) -> DataFrame:
    """Rows and ends of each cell; a cell of its own holds the NULLs, and no rows."""
    return values.groupBy(*bracket, cell.alias("cell")).agg(
        F.count("value").alias("rows"), F.min("key").alias("least_key"), F.max("key").alias("most_key"), F.min("value").alias("least")
    )


def _narrowed(targets: DataFrame, cells: DataFrame, bracket: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Targets ``rank`` with the cell that holds them as their bracket; ``before`` counts the rows below it."""
    below = Window.partitionBy(*bracket).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.filter("rows > 0").withColumn("below", F.coalesce(F.sum("rows").over(below), F.lit(0)))
    inside = F.col("rank") - F.col("before") - F.col("below")
    met = join_on(targets, placed, bracket).filter((inside >= 0) & (inside < F.col("rows")))
    return met.select(
        *keys, "rank", (F.col("before") + F.col("below")).alias("before"),
        F.col("least_key").alias("lo"), F.col("most_key").alias("hi"), "least",
    )


def _brackets(open_targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Open brackets with the shift that leaves ``RADIX_BITS`` of the bits their ends do not share."""
    differing = F.length(F.bin(F.col("lo").bitwiseXOR(F.col("hi"))))
    shift = F.greatest(differing - RADIX_BITS, F.lit(0)).cast("int")
    return open_targets.select(*keys, "lo", "hi").distinct().withColumn("shift", shift)


def _inside(values: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_on(values, brackets, keys).filter("key between lo and hi")


def _order_statistics(values: DataFrame, cells: DataFrame, ranks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets with their brackets narrowed to one value, ``least``."""
    is_open = F.col("lo") < F.col("hi")
    start = ranks.withColumn("before", F.lit(0).cast("bigint"))
    targets = stage_table(_narrowed(start, cells, keys, keys), "targets")
    survivors = None
    while not targets.filter(is_open).isEmpty():
        brackets = _brackets(targets.filter(is_open), keys)
        if survivors is None:
            # A row of several groups' brackets does not exist, and brackets of a group do not overlap.
            survivors = stage_table(_inside(values, brackets, keys).select(*keys, "key", "value"), "survivors")
        bracket = [*keys, "lo", "hi"]
        counted = _counted(_inside(survivors, brackets, keys), bracket, F.call_function("shiftright", "key", "shift"))
        narrowed = _narrowed(targets.filter(is_open).drop("least"), counted, bracket, keys)
        targets = stage_table(targets.filter(~is_open).unionByName(narrowed), "targets")
    return targets


# --- sketches ----------------------------------------------------------------


def approximate_percentiles(
    df: DataFrame, columns: Sequence[str], percentages: Sequence[float], by: Sequence[str] = (), slices: int = SLICES
) -> DataFrame:
    """As ``exact_percentiles``, but values near the wanted ranks, from one pass over the input.

    Every task's sketches go to one of ``slices`` slices of the group, each slice's sketch
    to the group: a reducer merges tasks / ``slices`` or ``slices`` sketches, not one per task.
    """
    keys = [*by, "position"]
    values = long_values(df, columns, by).withColumn("slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    sliced = values.groupBy(*keys, "slice").agg(F.count("value").alias("n"), F.kll_sketch_agg_double("value").alias("sketch"))
    merged = sliced.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))

    def cut(p: float) -> Column:
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(percentile_name(p))

    return merged.select(*by, name_at(columns, F.col("position")).alias("column"), "n", *[cut(p) for p in percentages])
