import pytest

from pricelens.operators import report
from pricelens.schemas import FEATURE_INDEX, IMPORTANCE
from pricelens.sources.reports import rows_to_frame

# Published test metrics (city, model, RMSE) and importances by feature index.
METRICS = [
    ("LA", "LinearRegression", 0.7231), ("LA", "RandomForest", 0.6295), ("LA", "GBT", 0.6768),
    ("NY", "LinearRegression", 0.7818), ("NY", "RandomForest", 0.7433), ("NY", "GBT", 0.8531),
]
LA_FOREST = [0.0528, 0.0435, 0.0661, 0.0534, 0.0780, 0.0275, 0.0627, 0.1360, 0.1440, 0.1625, 0.0958]
NY_FOREST = [0.0805, 0.0422, 0.0459, 0.0754, 0.0792, 0.0281, 0.1708, 0.0668, 0.1212, 0.0635, 0.0443,
             0.0025, 0.1190]


@pytest.fixture
def importances(spark):
    rows = [("LA", "RandomForest", i, x) for i, x in enumerate(LA_FOREST)]
    rows += [("NY", "RandomForest", i, x) for i, x in enumerate(NY_FOREST)]
    return rows_to_frame(spark, rows, IMPORTANCE)


def test_best_model_is_the_published_one(spark):
    best = report.best_model(spark.createDataFrame(METRICS, "city string, model string, rmse double"))
    assert {(r.city, r.model) for r in best.collect()} == {("LA", "RandomForest"), ("NY", "RandomForest")}


def test_top_features_are_the_published_ones(importances):
    top = report.top_features(importances, 5).orderBy("city", "rank").collect()
    assert [r.feature_index for r in top if r.city == "LA"] == [9, 8, 7, 10, 4]
    assert [r.feature_index for r in top if r.city == "NY"] == [6, 8, 12, 0, 4]
    assert top[0].label == "9" and top[0]["rank"] == 1


def test_ranking_breaks_ties_by_position(spark):
    df = rows_to_frame(spark, [("LA", "GBT", i, 0.5) for i in (2, 0, 1)], IMPORTANCE)
    ranked = report.rank_importance(df).orderBy("rank").collect()
    assert [r.feature_index for r in ranked] == [0, 1, 2]


def test_top_k_is_limited_before_the_shuffle(importances):
    plan = report.top_features(importances, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_name_features_keeps_unnamed_positions(spark, importances):
    names = rows_to_frame(spark, [(0, "minimum_nights", "minimum_nights", None)], FEATURE_INDEX)
    named = report.name_features(importances, names)
    assert named.count() == importances.count()
    assert {r.feature for r in named.filter("feature_index = 0").collect()} == {"minimum_nights"}


def test_compare_drivers(importances):
    rows = {r.feature_index: r for r in report.compare_drivers(importances, "LA", "NY").collect()}
    assert rows[6].difference == pytest.approx(0.0627 - 0.1708)
    assert rows[12].LA is None and rows[12].difference is None
