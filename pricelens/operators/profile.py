"""Profiles of a listing table: one aggregation pass per statistic family.

Every aggregate here has a partial form, so what crosses the network is one row
per task and group, however many rows a group holds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators.columns import long_values, name_at
from pricelens.operators.moments import Moments, grouped_moments
from pricelens.operators.percentiles import approximate_percentiles, exact_percentiles, percentile_name
from pricelens.operators.rows import points
from pricelens.session import join_on, small_side


def null_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """NULLs per column, one wide row (per group)."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def _summary(c: str) -> Column:
    v = F.col(c)
    return F.struct(
        F.lit(c).alias("column"),
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("stddev"),
        F.min(v).cast("double").alias("min"),
        F.max(v).cast("double").alias("max"),
    )


def describe_by(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample deviation, min and max of numeric columns, in long form."""

    wide = df.groupBy(*by).agg(*[_summary(c).alias(c) for c in columns])
    return wide.select(*by, F.inline(F.array(*[F.col(c) for c in columns])))


def summaries(
    df: DataFrame, numeric: Sequence[str], columns: Sequence[str], value: str, cap: tuple[float, float], by: Sequence[str] = ()
) -> DataFrame:
    """Null counts, numeric summaries and the capped range of ``value`` in one pass.

    One row per group: ``nulls`` a struct by column, ``described`` the rows of
    ``describe_by``, ``capped`` those of ``range_of`` after ``cap_range``.
    """
    v = F.when((F.col(value) > cap[0]) & (F.col(value) <= cap[1]), F.col(value))
    wide = df.groupBy(*by).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)],
        *[_summary(c).alias(f"_summary_{i}") for i, c in enumerate(numeric)],
        F.min(v).alias("_min"), F.max(v).alias("_max"), F.count(v).alias("_n"),
    )
    return wide.select(
        *by,
        F.struct(*[F.col(f"_null_{i}").alias(c) for i, c in enumerate(columns)]).alias("nulls"),
        F.array(*[F.col(f"_summary_{i}") for i in range(len(numeric))]).alias("described"),
        F.struct(F.col("_min").alias("min"), F.col("_max").alias("max"), F.col("_n").alias("n")).alias("capped"),
    )


def describe_text_by(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, min and max of text columns, in long form.

    Text cannot be held in a hash aggregate's buffer, so a direct min or max
    would sort every row by group. Counting the distinct values first keeps the
    large side hashed and leaves the sort to what little remains.
    """
    levels = (
        df.select(*by, F.posexplode(F.array(*columns)).alias("position", "level"))
        .groupBy(*by, "position", "level")
        .agg(F.count("level").alias("copies"))
    )
    return (
        levels.groupBy(*by, "position")
        .agg(
            F.sum("copies").alias("n"),
            F.min("level").alias("min"),
            F.max("level").alias("max"),
        )
        .select(*by, name_at(columns, F.col("position")).alias("column"), "n", "min", "max")
    )


def quartiles(
    df: DataFrame,
    columns: Sequence[str],
    percentages: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Interpolated percentiles per group and column; ``approx`` takes one pass with sketches."""
    return (approximate_percentiles if approx else exact_percentiles)(df, columns, percentages, by)


def tail_profile(
    df: DataFrame,
    column: str,
    percentages: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Maximum and upper percentiles; the maximum is the percentile at 1."""
    tail = quartiles(df, [column], [*percentages, 1.0], by, approx)
    names = [percentile_name(p) for p in percentages]
    return tail.select(*by, F.col(percentile_name(1.0)).alias("max"), *names)


def range_of(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    v = F.col(column)
    return df.groupBy(*by).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.count("*").alias("n"))


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins from min to max per group and column; the last bin is closed.

    Two passes: the edges (one row per group and column, size-checked before it
    is broadcast), then the counts. Infinities are left out, as NULL and NaN are. Empty bins are listed with a count of zero;
    a constant column has everything in bin 0.
    """
    keys = [*by, "position"]
    values = long_values(df, columns, by).filter(F.abs("value") < float("inf"))
    edges = small_side(
        values.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("value") - F.col("lo")) / width))
    inner = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = (
        join_on(values, edges, keys)
        .groupBy(*keys, inner.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return join_on(frame, counted, [*keys, "bin"], "left").select(
        *by,
        name_at(columns, F.col("position")).alias("column"),
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def geo_grid(
    df: DataFrame,
    lat: str,
    lon: str,
    value: str,
    lat_step: float,
    lon_step: float,
    by: Sequence[str] = (),
) -> DataFrame:
    """Count and mean value per map cell; cells are counted in steps of degrees from 0."""
    return (
        points(df, [lat, lon, value], by)
        .groupBy(
            *by,
            F.floor(F.col(lat) / lat_step).alias("lat_cell"),
            F.floor(F.col(lon) / lon_step).alias("lon_cell"),
        )
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    )


def binned_pair(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Spread of ``y`` at each value of ``x``."""
    return (
        points(df, [x, y], by)
        .groupBy(*by, x)
        .agg(
            F.count("*").alias("n"),
            F.avg(y).alias("mean"),
            F.min(y).alias("min"),
            F.max(y).alias("max"),
        )
    )


def correlation(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), against: Sequence[str] = ()
) -> DataFrame:
    """Pearson matrix per group in long form, each pair over the rows that have both.

    With ``against``, only the pairs of a column in ``columns`` (``a``) and one in
    ``against`` (``b``).

    One pass: tasks reduce batches to the co-moments of all pairs, which are merged per
    group. A constant column correlates with nothing, itself included (NULL).
    """
    names = [*columns, *against]
    first, second = (range(len(columns)), range(len(columns), len(names))) if against else (range(len(names)),) * 2
    pairs = [(i, j) for i in first for j in second]

    def matrix(found: Moments) -> dict[str, list]:
        spread = found.squares * found.squares.T
        r = found.products / np.sqrt(np.where(spread > 0, spread, np.nan))
        r[np.diag_indices(len(names))] = np.where(np.diagonal(found.squares) > 0, 1.0, np.nan)
        values = [float(r[i, j]) if np.isfinite(r[i, j]) else None for i, j in pairs]
        return {
            "a": pa.array([names[i] for i, _ in pairs], pa.string()),
            "b": pa.array([names[j] for _, j in pairs], pa.string()),
            "r": pa.array(values, pa.float64()),
        }

    out = T.StructType().add("a", "string").add("b", "string").add("r", "double")
    return grouped_moments(df, [F.col(c) for c in names], by, matrix, out)
