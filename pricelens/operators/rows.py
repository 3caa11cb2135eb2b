"""Row filters and fills. All are map-side: no shuffle, codegen throughout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.measures import hash_bucket


def numeric_id(column: Column) -> Column:
    return column.rlike("^[0-9]+$")


def keep_numeric_ids(df: DataFrame, column: str = "id") -> DataFrame:
    """NULL, empty and non-digit ids all fail the match."""
    return df.filter(numeric_id(F.col(column)))


def require_not_null(df: DataFrame, columns: Sequence[str] = ("price",)) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def positive(df: DataFrame, column: str = "price") -> DataFrame:
    return df.filter(F.col(column) > 0)


def cap_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(column) > low) & (F.col(column) <= high))


def only(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose named columns equal the given values."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in values.items()]))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def points(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows complete in ``columns``: the whole data of a scatter chart."""
    return drop_incomplete(df.select(*by, *columns), columns)


def scatter_sample(df: DataFrame, key: str, per_mille: int, seed: int) -> DataFrame:
    """A fixed share of the rows, for a chart that cannot draw all of them; NULL keys are not in it."""
    return df.filter(_in_share(key, per_mille, 1000, seed))


def sample_points(df: DataFrame, key: str, k: int, by: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """``k`` rows per group at most, for a chart that draws so many points: those of the smallest key hashes.

    The choice depends on keys and seed, not on the layout, and a larger ``k`` adds rows
    to those of a smaller one. Every task keeps its own ``k`` smallest per group, so that
    is all that is shuffled. NULL keys are not in it; rows of one key follow their values.
    """
    spread = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    others = [c for c in df.columns if c not in (key, *by)]
    order = Window.partitionBy(*by).orderBy("_spread", key, *others)
    ranked = df.filter(F.col(key).isNotNull()).withColumn("_spread", spread).withColumn("_place", F.row_number().over(order))
    return ranked.filter(F.col("_place") <= k).drop("_spread", "_place")


def _in_share(key: str, share: int, buckets: int, seed: int) -> Column:
    return F.coalesce(hash_bucket(F.col(key), seed, buckets) < share, F.lit(False))


def split(df: DataFrame, key: str, train_percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows by a hash of the key; rows with a NULL key are test rows."""
    in_train = _in_share(key, train_percent, 100, seed)
    return df.filter(in_train), df.filter(~in_train)


def mark_split(df: DataFrame, key: str, train_percent: int, seed: int) -> DataFrame:
    """The same choice as ``split`` in a column ``part``: one pass, and worth storing."""
    in_train = _in_share(key, train_percent, 100, seed)
    return df.withColumn("part", F.when(in_train, "train").otherwise("test"))


def random_split(df: DataFrame, train_percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Seeded random split; its rows depend on the partition layout."""
    share = train_percent / 100
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test


def preview(df: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """The first rows of a stated order (a top-k, so no full sort)."""
    return df.orderBy(*order_by).limit(rows)
