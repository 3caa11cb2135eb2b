"""Every query against its SQL, and the shape of the queries that have none."""

import pytest

import __spark_entry__ as entry_points
from compare import difference, open_oracle
from pricelens.plans.oracle_sql import ORACLES
from pricelens.plans.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return open_oracle(sf_dir)


def test_only_model_fits_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"fit_linear", "fit_forest", "fit_boosted"}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    assert difference(QUERIES[name](spark, sf_dir), oracle.sql(ORACLES[name])) is None


@pytest.mark.parametrize(
    ("name", "importances"), [("fit_linear", 0), ("fit_forest", 19), ("fit_boosted", 19)]
)
def test_fit_queries(spark, sf_dir, name, importances):
    rows = QUERIES[name](spark, sf_dir).collect()
    for city in ("LA", "NY"):
        assert {r.status for r in rows if r.city == city} == {"ok"}
        metrics = {r.name: r.value for r in rows if r.city == city and r.kind == "metric"}
        assert set(metrics) == {"rmse", "mae", "r2"}
        scores = [r.value for r in rows if r.city == city and r.kind == "importance"]
        assert len(scores) == importances and all(s >= 0 for s in scores)
        if scores:
            assert sum(scores) == pytest.approx(1)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["city", "model", "status", "kind", "name", "value"] and df.count() == 44
