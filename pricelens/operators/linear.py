"""Elastic nets for many groups at once, each solved from its group's moments."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import constants
from pricelens.operators.moments import Moments, grouped_moments
from pricelens.session import join_on

TOLERANCE = 1e-10
SWEEPS = 10_000

# Sent to the executors by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def elastic_net(
    moments: Moments, reg: float, mix: float, tolerance: float = TOLERANCE, sweeps: int = SWEEPS
) -> tuple[np.ndarray, float]:
    """Coefficients and intercept; the label is the last column.

    Features and label are scaled to deviation one (over n), as the built-in learner
    does, and the penalty is divided by the label's deviation. Coordinate descent goes
    round until no coefficient moves by more than ``tolerance``. A feature that does not
    vary has coefficient 0; a label that does not vary leaves the intercept alone.
    """
    n = moments.n[-1, -1]
    mean, spread = np.diagonal(moments.mean), np.sqrt(np.diagonal(moments.squares) / max(n, 1))
    x, y, label = spread[:-1], spread[-1], mean[-1]
    used = np.flatnonzero(x > 0)
    coefficients = np.zeros(len(x))
    if n == 0 or y == 0 or len(used) == 0:
        return coefficients, float(label)
    gram = moments.products[np.ix_(used, used)] / n / np.outer(x[used], x[used])
    target = moments.products[used, -1] / n / (x[used] * y)
    l1, l2 = reg * mix / y, reg * (1 - mix) / y
    w = np.zeros(len(used))
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            pull = target[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (gram[j, j] + l2)
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= tolerance:
            break
    coefficients[used] = w * y / x[used]
    return coefficients, float(label - coefficients @ mean[:-1])


def _complete(values: Sequence[Column], label: Column) -> Column:
    """A label that is NULL unless the row is complete, so that incomplete rows count for nothing."""
    ok = F.lit(True)
    for v in values:
        ok = ok & v.isNotNull() & ~F.isnan(v)
    return F.when(ok, label)


def fit_linear_by(
    df: DataFrame, features: Sequence[str] | str, by: Sequence[str], label: str = "log_price",
    width: int | None = None, reg: float = constants.LINEAR_PARAMS["regParam"],
    mix: float = constants.LINEAR_PARAMS["elasticNetParam"],
) -> DataFrame:
    """``by, coefficients, intercept, n_train`` for every group, in one job.

    ``features`` names numeric columns, or one vector column of ``width`` entries. Rows
    with a missing feature or label are left out, and a group of such rows alone has no
    model. A group needs no size of its own: one row gives its label as the intercept.
    """
    if isinstance(features, str):
        entries = vector_to_array(features)
        df = df.select(*by, label, entries.alias("_features"))
        values = [F.get("_features", F.lit(i)) for i in range(width)]
    else:
        values = [F.col(c).cast("double") for c in features]
    target = F.col(label).cast("double")
    complete = df.filter(_complete(values, target).isNotNull() & ~F.isnan(target))

    def solve(moments: Moments) -> dict[str, list]:
        w, intercept = elastic_net(moments, reg, mix)
        return {
            "coefficients": pa.array([w.tolist()], pa.list_(pa.float64())),
            "intercept": pa.array([intercept]),
            "n_train": pa.array([int(moments.n[-1, -1])], pa.int64()),
        }

    out = T.StructType().add("coefficients", T.ArrayType(T.DoubleType())).add("intercept", "double").add("n_train", "long")
    return grouped_moments(complete, [*values, target], by, solve, out)


def predict_by(df: DataFrame, models: DataFrame, features: Sequence[str] | str, by: Sequence[str]) -> DataFrame:
    """Rows with ``prediction``; NULL where the group has no model or a feature is missing."""
    values = vector_to_array(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    joined = join_on(df, models.select(*by, "coefficients", "intercept"), by, "left")
    terms = F.zip_with(values, F.col("coefficients"), lambda x, w: x * w)
    score = F.aggregate(terms, F.col("intercept"), lambda total, term: total + term)
    return joined.withColumn("prediction", score).drop("coefficients", "intercept")
