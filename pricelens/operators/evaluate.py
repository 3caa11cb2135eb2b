"""Regression metrics as one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate(
    predictions: DataFrame,
    by: Sequence[str] = (),
    label: str = "log_price",
    prediction: str = "prediction",
) -> DataFrame:
    """RMSE, MAE and R² per group, over the rows that have a label and a prediction.

    R² is NULL where the label does not vary. ``n_unscored`` counts the other rows.
    """
    y = F.col(label)
    error = F.col(prediction) - y
    squared = F.sum(error * error)
    spread = F.var_pop(F.when(error.isNotNull(), y)) * F.count(error)
    return predictions.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, 1 - squared / spread).alias("r2"),
        F.count(error).alias("n_test"),
        F.count_if(error.isNull()).alias("n_unscored"),
    )
