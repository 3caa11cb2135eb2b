"""Clean listings of several cities -> model frame -> trained models."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens import constants
from pricelens.functions.measures import distance_to_center, log_target
from pricelens.operators.columns import present_columns, require_columns
from pricelens.operators.encode import MAX_LEVELS, fit_encoder
from pricelens.plans.cleaning import clean_row, typed_listings

Centers = Mapping[str, tuple[float, float]]


def derive_features(
    df: DataFrame,
    centers: Centers = constants.CITY_CENTERS,
    fallback_city: str | None = None,
) -> DataFrame:
    """Rows a model can use, with ``log_price`` and ``dist_to_center`` added.

    Rows are dropped by their inputs (price, coordinates, a city with a centre),
    which is the same as by the derived values but lets the filter reach the
    scan of a stored table.
    """
    require_columns(df, constants.REQUIRED_COLUMNS)
    distance = distance_to_center(
        F.col("latitude"), F.col("longitude"), F.col("city"), centers, fallback_city
    )
    usable = df.filter(usable_row(df, centers, fallback_city))
    return usable.withColumns({"log_price": log_target(F.col("price")), "dist_to_center": distance})


def usable_row(df: DataFrame, centers: Centers = constants.CITY_CENTERS, fallback_city: str | None = None) -> Column:
    """Whether a clean listing can be an example: every input is there and the price positive."""
    numeric, categorical = feature_columns(df)
    tests = [F.col("price") > 0, *[F.col(c).isNotNull() for c in ("price", *numeric, *categorical)]]
    tests += [~F.isnan(c) for c in ("price", *numeric)]
    if fallback_city is None:
        tests.append(F.col("city").isin(*centers))
    return reduce(lambda a, b: a & b, tests)


def stage_counts(raw: DataFrame, centers: Centers = constants.CITY_CENTERS) -> DataFrame:
    """``stage, n``: raw listings, clean ones and examples, counted in one pass over the raw ones."""
    require_columns(raw, constants.REQUIRED_COLUMNS)
    typed = typed_listings(raw)
    counts = typed.select(clean_row(typed).alias("clean"), usable_row(typed, centers).alias("usable")).agg(
        F.count("*").alias("raw"),
        F.count_if(F.col("clean")).alias("clean"),
        F.count_if(F.col("clean") & F.col("usable")).alias("model"),
    )
    return counts.unpivot([], ["raw", "clean", "model"], "stage", "n")


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    return (
        present_columns(df, constants.NUMERIC_FEATURES, "numeric feature"),
        present_columns(df, constants.CATEGORICAL_FEATURES, "categorical feature"),
    )


def build_model_frame(
    df: DataFrame,
    centers: Centers = constants.CITY_CENTERS,
    fallback_city: str | None = None,
    max_levels: int = MAX_LEVELS,
    fit_on: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> tuple[DataFrame, PipelineModel]:
    """``id, city, log_price, features`` and the encoder that made it.

    The encoder is fitted on the rows of all cities together, so a feature has
    the same position in every city; ``fit_on`` can narrow that to train rows.
    """
    derived = derive_features(df, centers, fallback_city)
    numeric, categorical = feature_columns(derived)
    encoder = fit_encoder(fit_on(derived), numeric, categorical, max_levels)
    frame = encoder.transform(derived).select(
        F.col("id").cast("string").alias("id"), "city", "log_price", "features"
    )
    return frame, encoder
