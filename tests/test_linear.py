"""Grouped moments and elastic nets against the built-in learner and plain numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators import train
from pricelens.operators.linear import fit_linear_by, predict_by
from pricelens.operators.moments import Moments, grouped_moments

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Three groups of unequal size, far from zero, one feature constant in group 2 and NULLs."""
    x = spark.range(0, 6000, 1, 6).select(
        "id", F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 10 < 9, 1).otherwise(2).alias("g"),
        (F.rand(1) - 118.2).alias("a"), (F.randn(2) * 50).alias("b"), F.rand(3).alias("c"), F.rand(4).alias("noise"),
    )
    d = F.when(F.col("g") == 2, 7.0).otherwise(F.col("a") + 0.1 * F.col("noise"))
    y = 2 * F.col("a") - 0.02 * F.col("b") + F.col("g") + F.col("noise")
    some = x.withColumns({"d": d, "log_price": y})
    return some.withColumn("c", F.when(F.col("id") % 97 == 0, None).otherwise(F.col("c"))).cache()


@pytest.mark.parametrize(("reg", "mix"), [(0.1, 0.5), (0.02, 1.0), (0.5, 0.0), (0.0, 0.5)])
def test_groups_equal_the_built_in_learner(rows, reg, mix):
    found = {r.g: r for r in fit_linear_by(rows, FEATURES, ["g"], reg=reg, mix=mix).collect()}
    assert sorted(found) == [0, 1, 2]
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.na.drop())
    for g, r in found.items():
        part = vectors.filter(F.col("g") == g)
        model = train.linear_regression(regParam=reg, elasticNetParam=mix, tol=1e-12, maxIter=5000).fit(part)
        assert r.n_train == part.count()
        assert r.coefficients == pytest.approx(model.coefficients.toArray().tolist(), abs=1e-5)
        assert r.intercept == pytest.approx(model.intercept, rel=1e-5, abs=1e-5)


def test_vector_features_and_predictions(rows):
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.na.drop())
    models = fit_linear_by(vectors, "features", ["g"], width=4)
    plain = fit_linear_by(rows, FEATURES, ["g"])
    assert sorted(map(str, models.collect())) == sorted(map(str, plain.collect()))
    a = predict_by(vectors, models, "features", ["g"]).select("id", F.round("prediction", 9))
    b = predict_by(rows, plain, FEATURES, ["g"]).filter("prediction is not null").select("id", F.round("prediction", 9))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_a_thousand_groups_in_one_job(spark):
    df = spark.range(0, 20000, 1, 4).select(
        (F.col("id") % 1000).cast("string").alias("city"), F.rand(1).alias("x"), F.rand(2).alias("noise")
    )
    df = df.withColumn("log_price", F.col("x") * F.col("city").cast("int") + F.col("noise")).cache()
    df.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("thousand", "thousand")
    models = {r.city: r for r in fit_linear_by(df, ["x"], ["city"], reg=0.0).collect()}
    # Adaptive execution runs a plan's stages as jobs of their own: three, not one per group.
    assert len(tracker.getJobIdsForGroup("thousand")) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    local = df.toPandas()
    assert len(models) == 1000
    for city in ("0", "17", "999"):
        part = local[local.city == city]
        slope, intercept = np.polyfit(part.x, part.log_price, 1)
        assert (models[city].coefficients[0], models[city].intercept) == pytest.approx((slope, intercept), rel=1e-6)


def test_edge_groups(spark):
    rows = [(None, 1.0, 2.0), (None, 2.0, 4.0), (None, 3.0, 6.0), ("one", 5.0, 7.0), ("flat", 1.0, 3.0), ("flat", 2.0, 3.0),
            ("nothing", None, 1.0), ("nothing", float("nan"), 1.0), ("nothing", 1.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, log_price double")
    models = fit_linear_by(df, ["x"], ["g"], reg=0.0)
    found = {r.g: (r.coefficients, r.intercept, r.n_train) for r in models.collect()}
    assert found == {None: ([pytest.approx(2.0)], pytest.approx(0, abs=1e-9), 3), "one": ([0.0], 7.0, 1), "flat": ([0.0], 3.0, 2)}
    scored = {(r.g, r.x): r.prediction for r in predict_by(df, models, ["x"], ["g"]).collect() if r.x == 1.0}
    assert scored[(None, 1.0)] == pytest.approx(2) and scored[("nothing", 1.0)] is None
    assert fit_linear_by(df.limit(0), ["x"], ["g"]).count() == 0


def test_moments_merge_like_one_batch():
    rng = np.random.default_rng(5)
    values = rng.normal(1e6, 1, (500, 3)) * [1, 1e-3, 0] + [0, 0, 0.1]
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:40, 1] = np.nan
    parts = [Moments.of(p) for p in np.split(values, [40, 41, 300])]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.merged(Moments.unpacked(p.packed()))
    both = ~np.isnan(values[:, 0]) & ~np.isnan(values[:, 1])
    x, y = values[both, 0], values[both, 1]
    assert merged.n[0, 1] == both.sum() and merged.mean[0, 1] == pytest.approx(x.mean())
    assert merged.squares[0, 1] == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-9)
    assert merged.products[0, 1] == pytest.approx(((x - x.mean()) * (y - y.mean())).sum(), rel=1e-6)
    assert merged.squares[2, 2] == 0


def test_slices_do_not_change_moments(rows):
    out = T.StructType().add("n", "double").add("products", "double")

    def finish(m):
        return {"n": [m.n[0, 1]], "products": [round(m.products[0, 1], 6)]}

    columns = [F.col("a"), F.col("b")]
    one, many = (sorted(map(tuple, grouped_moments(rows, columns, ["g"], finish, out, s).collect())) for s in (1, 7))
    assert one == many and len(one) == 3
