"""Files to reports, the way a user runs it."""

from pricelens import storage
from pricelens.operators import train
from pricelens.plans import bindings, jobs, queries
from pricelens.schemas import IMPORTANCE, METRICS
from pricelens.sources.listings import write_csv
from pricelens.sources.reports import read_report


def test_from_dirty_files_to_reports(spark, sf_dir, tmp_path):
    raw = str(tmp_path / "raw")
    write_csv(bindings.raw_listings(spark, sf_dir), raw, partition_by=["city"])
    clean = {city: str(tmp_path / f"clean-{city}") for city in ("LA", "NY")}
    for city, path in clean.items():
        jobs.clean_files(spark, f"{raw}/city={city}", path)
    jobs.clean_files(spark, f"{raw}/city=LA", str(tmp_path / "as_csv"), csv=True)
    kept = {city: spark.read.parquet(path).count() for city, path in clean.items()}
    assert spark.read.option("header", True).csv(str(tmp_path / "as_csv")).count() == kept["LA"]

    tables = jobs.profile_files(spark, clean, str(tmp_path / "profile"))
    assert {p.name for p in (tmp_path / "profile").iterdir()} == set(tables)
    assert all(table.count() for table in tables.values())
    counts = {r.city: r.n for r in tables["describe"].collect() if r.column == "price"}
    assert counts == kept
    assert tables["correlation"].count() == 2 * 81
    assert tables["quartiles"].count() == 2 * 9
    assert sum(r.n for r in tables["price_histogram"].collect()) == sum(kept.values())
    assert tables["price_tail"].count() == tables["null_counts"].count() == 2

    frame = str(tmp_path / "frame")
    index_map = jobs.build_features(spark, clean, frame, str(tmp_path / "encoder"))
    assert index_map.count() == 19
    assert {p.name for p in (tmp_path / "frame" / "city=LA").iterdir()} == {"part=train", "part=test"}

    models = {
        "LinearRegression": train.linear_regression(),
        "RandomForest": train.random_forest(numTrees=10, maxDepth=4),
    }
    paths = [str(tmp_path / "metrics"), str(tmp_path / "importance")]
    jobs.train_models(spark, frame, ["LA", "NY"], *paths, models=models)
    metrics = read_report(spark, paths[0], METRICS).collect()
    assert len(metrics) == 4 and all(m.status == "ok" for m in metrics)
    importance = read_report(spark, paths[1], IMPORTANCE)
    assert importance.count() == 2 * 19
    reports = jobs.report_files(spark, paths[1], frame, str(tmp_path / "reports"), chart=("LA", "RandomForest"))
    assert reports["named"].filter("feature is null").isEmpty() and reports["top"].count() == 2 * 5
    assert {p.name for p in (tmp_path / "reports").iterdir()} == {"named", "ranked", "top", "compared", "chart"}
    assert [r.rank for r in reports["chart"].orderBy("rank").collect()] == list(range(1, 20))
    run = jobs.read_run(spark, *paths, frame)
    assert sorted(map(str, jobs.read_index_map(spark, frame).collect())) == sorted(map(str, index_map.collect()))
    assert run["importance"].filter("feature is null").isEmpty() and run["metrics"].count() == 4


def test_jobs_leave_no_stored_tables(spark, sf_dir, tmp_path, monkeypatch):
    """Three fits share one frame; nothing that a job has stored is left."""
    scratch = tmp_path / "scratch"
    scratch.mkdir()
    monkeypatch.setattr(storage, "scratch_dir", lambda session: str(scratch))

    def stored(kind):
        return [p for p in scratch.iterdir() if p.name.startswith(kind)]

    models = ({"LinearRegression": train.linear_regression()}, {"RandomForest": train.random_forest(numTrees=3, maxDepth=2)},
              {"GBT": train.gradient_boosting(maxIter=2, maxDepth=2)})
    with storage.storage(spark):
        for one in models:
            assert {r.status for r in queries.fit_report(spark, sf_dir, one).collect()} == {"ok"}
        assert len(stored("model_frame")) == 1 and len(stored("clean")) == 1
        for name in ("quartiles_by_city", "price_tail", "category_index", "price_correlation", "training_reports"):
            assert queries.QUERIES[name](spark, sf_dir).count()
        left = {p.name.rsplit("-", 1)[0] for p in scratch.iterdir()}
        assert left == {"model_frame", "clean", "percentiles", "levels", "training_reports", "side"}
    assert not any(scratch.iterdir())
    clean = str(tmp_path / "clean")
    queries.clean(spark, sf_dir, bindings.LISTING_COLUMNS).filter("city = 'LA'").drop("city").write.parquet(clean)
    assert jobs.profile_files(spark, {"LA": clean}, str(tmp_path / "profile"))["describe"].count() == 9
    assert not any(scratch.iterdir())
