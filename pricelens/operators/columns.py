"""Column-set checks and the tagged union of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions.casts import nan_as_null


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")
    return df


def present_columns(df: DataFrame, candidates: Sequence[str], what: str) -> list[str]:
    """The candidates that exist, in candidate order; none at all is an error."""
    found = [c for c in candidates if c in df.columns]
    if not found:
        raise ValueError(f"no {what} column in the input; looked for {', '.join(candidates)}")
    return found


def tag_source(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def common_columns(*frames: DataFrame) -> list[str]:
    """Columns every frame has, in the order of the first frame."""
    shared = set.intersection(*[set(f.columns) for f in frames])
    return [c for c in frames[0].columns if c in shared]


def union_sources(frames: Mapping[str, DataFrame], tag: str = "city") -> DataFrame:
    """Bag union by name over the shared columns, each row tagged with its source."""
    tagged = [tag_source(df, tag, name) for name, df in frames.items()]
    names = common_columns(*tagged)
    return reduce(DataFrame.unionByName, [df.select(*names) for df in tagged])


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., position, value``: numeric columns stacked, NaN as NULL.

    The column is named by its position: exploding plain values and grouping by
    a number stays in generated code, which stacking named structs does not.
    """
    values = F.array(*[nan_as_null(F.col(c)) for c in columns])
    return df.select(*by, F.posexplode(values).alias("position", "value"))


def name_at(names: Sequence[str], position: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in names]), position)
