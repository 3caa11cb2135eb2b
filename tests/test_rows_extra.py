"""NULL keys in splits, unscored rows in metrics, infinities in histograms."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from pricelens.operators import profile, rows
from pricelens.operators.evaluate import evaluate
from pricelens.plans import modelling
from pricelens.plans.cleaning import clean_listings


def test_split_loses_no_null_key(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k long")
    train, test = rows.split(df, "k", 50, 42)
    assert train.count() + test.count() == 4 and test.filter("k is null").count() == 2
    marked = rows.mark_split(df, "k", 50, 42)
    assert marked.filter("part = 'test'").exceptAll(test.selectExpr("k", "'test' as part")).isEmpty()
    assert rows.scatter_sample(df, "k", 1000, 1).count() == 2


def test_metrics_leave_unscored_rows_out(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (100.0, None), (None, 4.0)], "log_price double, prediction double")
    got = evaluate(df).first()
    scored = df.filter("prediction is not null and log_price is not null")
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="log_price", metricName=name).evaluate(scored)
        assert got[name] == pytest.approx(want)
    assert (got.n_test, got.n_unscored) == (3, 2)


def test_histogram_leaves_infinities_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    got = profile.histogram(df, ["x"], 2).orderBy("bin").collect()
    assert [(r.lower, r.upper, r.n) for r in got] == [(1.0, 1.5, 1), (1.5, 2.0, 1)]


def test_correlation_against_a_list(spark):
    df = spark.range(50).selectExpr("double(id) as a", "double(id * id) as b", "double(id % 7) as y")
    whole = {(r.a, r.b): r.r for r in profile.correlation(df, ["a", "b", "y"]).collect()}
    some = {(r.a, r.b): r.r for r in profile.correlation(df, ["a", "b"], against=["y"]).collect()}
    assert set(some) == {("a", "y"), ("b", "y")}
    assert all(whole[k] == pytest.approx(v) for k, v in some.items())


def test_sample_points_are_bounded_and_stable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 == 0, "b").otherwise("a").alias("g"))
    df = df.unionByName(spark.createDataFrame([(None, "a")], "id long, g string"))

    def chosen(frame, k):
        return {tuple(r) for r in rows.sample_points(frame, "id", k, ["g"], 42).collect()}

    some = chosen(df, 50)
    assert len(some) == 100 and None not in {i for i, _ in some}
    assert chosen(df.repartition(13).orderBy(F.desc("id")), 50) == some and some < chosen(df, 80)
    assert len(chosen(df.filter("g = 'b'").limit(5), 50)) == 5
    plan = rows.sample_points(df, "id", 50, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_stage_counts_read_the_listings_once(spark):
    raw = spark.createDataFrame(
        [("1", "$5", "1", "2", "LA", "x", "g", "3"), ("2", "$0", "1", "2", "LA", "x", "g", "3"), ("x", "$5", "1", "2", "LA", "x", "g", "3"),
         (None, "$5", "1", "2", "LA", "x", "g", "3"), ("3", "no", "1", "2", "LA", "x", "g", "3"), ("4", "7", "n/a", "2", "LA", "x", "g", "3"),
         ("5", "7", "1", "2", "SF", "x", "g", "3"), ("6", "7", "1", "2", "NY", None, "g", "3")],
        "id string, price string, latitude string, longitude string, city string, room_type string, neighbourhood_group string, minimum_nights string",
    )
    counts = modelling.stage_counts(raw)
    assert {r.stage: r.n for r in counts.collect()} == {"raw": 8, "clean": 5, "model": 1}
    cleaned = clean_listings(raw)
    assert (cleaned.count(), modelling.derive_features(cleaned).count()) == (5, 1)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
