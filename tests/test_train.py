import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pricelens.operators import train
from pricelens.operators.evaluate import evaluate
from pricelens.operators.rows import random_split
from pricelens.session import scratch_path

CITIES = ["LA", "NY"]


@pytest.fixture(scope="module")
def frame(spark):
    """A planted target: feature 0 matters most, feature 3 not at all."""
    x = [F.rand(seed=i) for i in range(4)]
    rows = spark.range(0, 3000, 1, 4).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "LA").otherwise("NY").alias("city"),
        F.array(*x).alias("x"),
        F.randn(seed=9).alias("noise"),
    )
    label = 3 * F.get("x", F.lit(0)) - F.get("x", F.lit(1)) + F.get("x", F.lit(2)) ** 2
    df = rows.select(
        "id", (label + 0.1 * F.col("noise")).alias("log_price"),
        array_to_vector("x").alias("features"), "city",
    )
    return train.store_layout(df, scratch_path(spark, "planted"), ["city"], 3000)


@pytest.fixture(scope="module")
def results(frame):
    models = {
        "LinearRegression": train.linear_regression(regParam=0.01),
        "RandomForest": train.random_forest(numTrees=20, maxDepth=6),
        "GBT": train.gradient_boosting(maxIter=10),
    }
    return train.train_by_group(frame, CITIES, models)


def test_every_model_is_trained_for_every_city(spark, results):
    metrics = train.metrics_frame(spark, results).collect()
    assert {(m.city, m.model) for m in metrics} == {
        (c, m) for c in CITIES for m in ("LinearRegression", "RandomForest", "GBT")
    }
    assert all(m.status == "ok" and m.r2 > 0.5 and m.n_test > 100 for m in metrics)


def test_importances_are_shares_and_find_the_signal(spark, results):
    rows = train.importance_frame(spark, results).collect()
    assert {(r.city, r.model) for r in rows} == {(c, m) for c in CITIES for m in ("RandomForest", "GBT")}
    for city, model in {(r.city, r.model) for r in rows}:
        scores = {r.feature_index: r.importance for r in rows if (r.city, r.model) == (city, model)}
        assert sorted(scores) == [0, 1, 2, 3]
        assert min(scores.values()) >= 0 and sum(scores.values()) == pytest.approx(1)
        assert max(scores, key=scores.get) == 0 and min(scores, key=scores.get) == 3


@pytest.mark.parametrize("partitions", [4, 8, 13])
def test_a_model_does_not_depend_on_the_session(spark, frame, results, tmp_path, partitions):
    """Another row order, shuffle width and reader settings give the same files, partitions and model."""
    names = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.files.maxPartitionBytes": f"{partitions}k"}
    before = {n: spark.conf.get(n) for n in names}
    shuffled = spark.createDataFrame(frame.toPandas(), frame.schema).repartition(5).orderBy(F.rand(3))
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        again = train.store_layout(shuffled, str(tmp_path / "again"), ["city"], 3000)
        assert again.filter("city = 'LA'").rdd.getNumPartitions() == train.layout_files(3000)
        fits = train.train_by_group(again, ["LA"], {"RandomForest": train.random_forest(numTrees=20, maxDepth=6)})[0]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    first = next(r for r in results if (r.city, r.name) == ("LA", "RandomForest"))
    assert fits.importances == pytest.approx(first.importances, rel=1e-12) and fits.rmse == pytest.approx(first.rmse, rel=1e-12)


def test_a_failed_fit_is_reported_and_the_others_kept(spark, frame):
    models = {
        "Bad": train.linear_regression().setFeaturesCol("absent"),
        "LinearRegression": train.linear_regression(regParam=0.01),
    }
    bad, good = train.train_by_group(frame, ["LA"], models, keep_going=["Bad"])
    assert bad.status.startswith("failed:") and bad.rmse is None and bad.importances == []
    assert good.status == "ok"
    with pytest.raises(Exception, match="absent"):
        train.train_by_group(frame, ["LA"], models)


def test_random_split_can_replace_the_hash_split(frame):
    one = train.train_by_group(
        frame, ["NY"], {"LinearRegression": train.linear_regression(regParam=0.01)},
        split_rows=lambda df: random_split(df, 80, 42),
    )
    assert one[0].r2 > 0.5


def test_elastic_net_is_optimal(frame):
    """Optimality conditions in standardised space, with the penalty over the label deviation."""
    reg, mix = 0.05, 0.5
    data = frame.filter("city = 'NY'")
    model = train.linear_regression(regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=1000).fit(data)
    pdf = data.select("features", "log_price").toPandas()
    x = np.array([v.toArray() for v in pdf.features])
    y = pdf.log_price.to_numpy()
    sx, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
    z, t = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    w = model.coefficients.toArray() * sx / sy
    lam = reg / sy
    gradient = z.T @ (z @ w - t) / len(t) + lam * (1 - mix) * w
    for g, c in zip(gradient, w, strict=True):
        if c != 0:
            assert g + lam * mix * np.sign(c) == pytest.approx(0, abs=2e-3)
        else:
            assert abs(g) <= lam * mix + 2e-3
    assert (w == 0).any() and (w != 0).any()


def test_default_settings():
    models = train.default_models()
    linear, forest, boosted = (models[k] for k in ("LinearRegression", "RandomForest", "GBT"))
    assert (linear.getMaxIter(), linear.getRegParam(), linear.getElasticNetParam()) == (50, 0.1, 0.5)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins(), forest.getSeed()) == (
        100, 8, 32, 42)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (30, 4, 0.1)
    assert (boosted.getSubsamplingRate(), boosted.getSeed()) == (0.8, 42)


def test_evaluate_agrees_with_the_built_in_evaluator(spark):
    df = spark.range(500).select(
        F.when(F.col("id") < 100, "a").otherwise("b").alias("g"),
        F.rand(1).alias("log_price"), F.rand(2).alias("prediction"),
    ).cache()
    for r in evaluate(df, ["g"]).collect():
        part = df.filter(F.col("g") == r.g)
        for metric in ("rmse", "mae", "r2"):
            built_in = RegressionEvaluator(labelCol="log_price", metricName=metric).evaluate(part)
            assert r[metric] == pytest.approx(built_in)
    flat = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "log_price double, prediction double")
    assert tuple(evaluate(flat).first()) == (0.5, 0.5, None, 2, 0)
