"""Reports over the metric and importance tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import join_on, small_side


def name_features(importances: DataFrame, index_map: DataFrame) -> DataFrame:
    """Attach feature names. The map is as long as the feature vector is wide."""
    return join_on(importances, small_side(index_map), ["feature_index"], "left")


def rank_importance(importances: DataFrame, by: Sequence[str] = ("city", "model")) -> DataFrame:
    """Rank features within each model, largest first; ``label`` is the axis text."""
    order = Window.partitionBy(*by).orderBy(F.desc("importance"), "feature_index")
    return importances.withColumn("rank", F.row_number().over(order)).withColumn(
        "label", F.col("feature_index").cast("string")
    )


def top_features(
    importances: DataFrame, k: int = 5, by: Sequence[str] = ("city", "model")
) -> DataFrame:
    return rank_importance(importances, by).filter(F.col("rank") <= k)


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the lowest RMSE of each city."""
    order = Window.partitionBy("city").orderBy("rmse", "model")
    return (
        metrics.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def compare_drivers(
    importances: DataFrame, left: str, right: str, by: Sequence[str] = ("model", "feature_index")
) -> DataFrame:
    """The same feature side by side in two cities, and how much more it matters in ``left``."""
    return (
        importances.groupBy(*by)
        .pivot("city", [left, right])
        .agg(F.max("importance"))
        .withColumn("difference", F.col(left) - F.col(right))
    )
