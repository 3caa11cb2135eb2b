import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricelens.llm import ann


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, part int, v string")


def row(i, v):
    return (i, v, 0, "x", 1, "x")


def test_recall_and_order(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(30, size=4000)] + 0.4 * rng.normal(size=(4000, 16))).astype(np.float32)
    x[500:900] = x[0]  # a very common vector
    got = ann.report(table(spark, [row(i, v.tolist()) for i, v in enumerate(x)])).toPandas()
    wide = x.astype(np.float64)
    hits = total = 0
    for q, found in got.groupby("query_id"):
        found = found.sort_values("rank")
        scores = (wide * wide[q]).sum(axis=1)
        assert np.allclose(found["score"], scores[found["vec_id"]], rtol=1e-12)
        assert list(found["rank"]) == list(range(1, 21)) and q not in set(found["vec_id"])
        pairs = list(zip(-found["score"], found["vec_id"], strict=True))
        assert pairs == sorted(pairs)
        scores[q] = -np.inf
        least = np.sort(scores)[-20]
        hits += (scores[found["vec_id"]] >= least).sum()
        total += 20
    assert got["query_id"].nunique() == 200 and hits / total >= 0.9


def test_router_leaves_parts_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16)) * 3
    x = centres[np.repeat(np.arange(8), 100)] + rng.normal(size=(800, 16))
    graph = ann.neighbour_graph(x, 10)
    part = ann.balanced_parts(x, graph, 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.05 * 100)
    inside = (part[graph] == part[:, None]).mean()
    assert inside > 0.6


def test_fit_routes_what_search_routes(spark, monkeypatch):
    """Of vectors of widely differing lengths, fit shows the router the same as the search does."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(20, size=3000)] + 0.4 * rng.normal(size=(3000, 16))
    x *= np.exp(rng.normal(size=(3000, 1)))
    seen, chances = [], ann.Router.chances
    monkeypatch.setattr(ann.Router, "chances", lambda self, v: seen.append(v) or chances(self, v))
    rows = ann.vectors(table(spark, [row(i, v.tolist()) for i, v in enumerate(x)]), "vec_id", "embedding")
    router = ann.fit(rows, 3000)
    assert router.parts > 1 and seen
    assert all(np.allclose(np.linalg.norm(v, axis=1), 1) for v in seen)


def recall_of(x, got):
    wide, hits = x.astype(np.float64), 0
    for q, found in got.groupby("query_id"):
        scores = (wide * wide[q]).sum(axis=1)
        scores[q] = -np.inf
        hits += (scores[found["vec_id"]] >= np.sort(scores)[-20] - 1e-12).sum()
    return hits / (20 * got["query_id"].nunique())


@pytest.mark.parametrize("kind", ["unclustered", "unequal lengths"])
def test_recall_without_clusters_and_on_unequal_lengths(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 16))
    if kind == "unequal lengths":
        centres = rng.normal(size=(20, 16))
        x = (centres[rng.integers(20, size=6000)] + 0.4 * x) * np.exp(0.5 * rng.normal(size=(6000, 1)))
    x = x.astype(np.float32)
    got = ann.report(table(spark, [row(i, v.tolist()) for i, v in enumerate(x)])).toPandas()
    assert got["query_id"].nunique() == 300 and recall_of(x, got) >= 0.9


def test_waves_pass_scores_on_and_change_nothing(spark, monkeypatch):
    """Later parts return only what can still be among the best."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 8)).astype(np.float32)
    x[2000:2040] = x[0]
    data = table(spark, [row(i, v.tolist()) for i, v in enumerate(x)])
    rows = ann.vectors(data)
    router = ann.fit(rows, 8000)
    router.visits = router.parts
    in_waves = sorted(map(tuple, ann.search(data, F.col("id") % 20 == 0, router=router).collect()))
    monkeypatch.setattr(ann, "FIRST_WAVE", 1000)
    assert in_waves == sorted(map(tuple, ann.search(data, F.col("id") % 20 == 0, router=router).collect()))
    left = pd.DataFrame({"id": [1, 2], "v": [np.ones(2).tobytes()] * 2, "floor": [None, 5.0]})
    right = pd.DataFrame({"id": range(10, 20), "v": [np.full(2, float(i)).tobytes() for i in range(10)]})
    kept = ann.rerank(left, right, 20)
    assert (kept["query_id"] == 1).sum() == 10 and kept[kept["query_id"] == 2]["score"].min() == 6


def test_cases(spark):
    rows = [row(0, [1.0, 0.0]), row(20, [0.0, 2.0]), row(3, [1.0, 0.0]), row(2, [1.0, 0.0]), row(2, [1.0, 0.0]), row(5, None), row(6, [0.0, 0.0]), row(7, [None, 1.0]), row(8, [float("nan"), 1.0]), row(9, [float("inf"), 1.0]), row(None, [1.0, 1.0]), row(40, [])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.report(table(spark, rows)).collect()]
    assert sorted(got) == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 2, 0.0), (20, 3, 3, 0.0)]
    assert ann.report(table(spark, rows).limit(0)).count() == 0
