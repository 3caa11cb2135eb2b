"""Distributed training of several regressors for several cities."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricelens import constants
from pricelens.operators.evaluate import evaluate
from pricelens.operators.rows import mark_split, only, split
from pricelens.schemas import IMPORTANCE, METRICS
from pricelens.session import ensure_checkpoint_dir
from pricelens.sources.reports import rows_to_frame

log = logging.getLogger(__name__)

LEAST_FILES = 8
ROWS_PER_FILE = 1_000_000
SPLIT_BYTES = "1g"

Split = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


@dataclass(frozen=True)
class Trained:
    """What one (city, model) fit leaves on the driver: a handful of numbers."""

    city: str
    name: str
    status: str
    model: Model | None = None
    rmse: float | None = None
    mae: float | None = None
    r2: float | None = None
    n_test: int | None = None
    error: Exception | None = None

    @property
    def importances(self) -> list[float]:
        scores = getattr(self.model, "featureImportances", None)
        return [] if scores is None else [float(x) for x in scores.toArray()]


def linear_regression(**overrides: object) -> LinearRegression:
    """Elastic net. At this width MLlib solves it from one pass of normal equations."""
    params = {**constants.LINEAR_PARAMS, **overrides}
    return LinearRegression(featuresCol="features", labelCol="log_price", **params)


def random_forest(**overrides: object) -> RandomForestRegressor:
    """Forest. Node ids are not cached: one per row and tree would outweigh the rows."""
    params = {"maxMemoryInMB": 512, **constants.FOREST_PARAMS, **overrides}
    return RandomForestRegressor(featuresCol="features", labelCol="log_price", **params)


def gradient_boosting(**overrides: object) -> GBTRegressor:
    params = {"maxMemoryInMB": 512, **constants.BOOSTED_PARAMS, **overrides}
    return GBTRegressor(featuresCol="features", labelCol="log_price", **params)


def default_models() -> dict[str, Estimator]:
    return {
        "LinearRegression": linear_regression(),
        "RandomForest": random_forest(),
        "GBT": gradient_boosting(),
    }


def hash_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(df, "id", constants.TRAIN_PERCENT, constants.SPLIT_SEED)


def mark_parts(df: DataFrame) -> DataFrame:
    """The hash split as a stored column; with a folder per part no fit reads the other."""
    return mark_split(df, "id", constants.TRAIN_PERCENT, constants.SPLIT_SEED)


def stored_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return only(df, part="train"), only(df, part="test")


def layout_files(rows: int) -> int:
    """Files of a layout: a number that depends on the data alone."""
    return max(LEAST_FILES, -(-rows // ROWS_PER_FILE))


def stable_layout(df: DataFrame, key: str = "id", partition_by: Sequence[str] = (), files: int = LEAST_FILES) -> DataFrame:
    """Deal rows by key to a stated number of partitions and fix their order inside each.

    Tree learners draw samples per partition, so a model is repeatable only if
    the layout is. The number is stated, so neither the session's shuffle partitions nor
    adaptive coalescing has a say. Folder columns lead the sort, as the writer would
    otherwise sort again by them.
    """
    return df.repartition(files, F.col(key)).sortWithinPartitions(*partition_by, key)


def read_layout(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored layout read with one partition per file, whatever the cluster's size.

    The reader otherwise packs files by the number of cores. The settings belong to a
    session of the frame's own, so no other query sees them.
    """
    session = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(name, SPLIT_BYTES)
    return session.read.schema(schema).parquet(path)


def store_layout(df: DataFrame, path: str, folders: Sequence[str], rows: int, key: str = "id") -> DataFrame:
    """Write a frame once in its layout and read it back: all fits and repeats share it."""
    stable_layout(df, key, folders, layout_files(rows)).write.mode("overwrite").partitionBy(*folders).parquet(path)
    return read_layout(df.sparkSession, path, df.schema)


def predict(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def train_and_evaluate(
    estimator: Estimator, train: DataFrame, test: DataFrame, city: str, name: str
) -> Trained:
    """Fit and score one model. A failed fit is told in ``status`` and ``error``."""
    try:
        model = estimator.fit(train)
        scores = evaluate(predict(model, test)).first()
    except Exception as error:
        log.warning("%s failed for %s: %s", name, city, error)
        status = f"failed: {type(error).__name__}: {error}".splitlines()[0]
        return Trained(city, name, status, error=error)
    return Trained(city, name, "ok", model, scores.rmse, scores.mae, scores.r2, scores.n_test)


def train_by_group(
    frame: DataFrame,
    cities: Sequence[str],
    models: dict[str, Estimator] | None = None,
    split_rows: Split = hash_split,
    parallelism: int = 4,
    keep_going: Collection[str] = ("GBT",),
) -> list[Trained]:
    """Every model for every city.

    The first failure is raised once all fits have ended, unless its model is named
    in ``keep_going``; such a model's failure is a row of the result.

    ``frame`` should be a stored model frame with a folder per city, and per part
    if the split is stored too: each fit then reads its own rows only. The learners cache their own binned form of the
    rows, so the frame itself is not cached a second time. The driver threads
    only submit jobs and hold fitted models.
    """
    models = default_models() if models is None else models
    ensure_checkpoint_dir(frame.sparkSession)
    jobs = []
    for city in cities:
        train, test = split_rows(only(frame, city=city))
        jobs += [(e.copy(), train, test, city, name) for name, e in models.items()]
    # Each call gets its own inherited local properties (job group, scheduler pool).
    run = inheritable_thread_target(frame.sparkSession)(lambda job: train_and_evaluate(*job))
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        results = pool.map(run, jobs, chunksize=1)
    for result in results:
        if result.error is not None and result.name not in keep_going:
            raise result.error
    return results


def metrics_frame(spark: SparkSession, results: Sequence[Trained]) -> DataFrame:
    rows = [(r.city, r.name, r.rmse, r.mae, r.r2, r.n_test, r.status) for r in results]
    return rows_to_frame(spark, rows, METRICS)


def importance_frame(spark: SparkSession, results: Sequence[Trained]) -> DataFrame:
    rows = [(r.city, r.name, i, s) for r in results for i, s in enumerate(r.importances)]
    return rows_to_frame(spark, rows, IMPORTANCE)
