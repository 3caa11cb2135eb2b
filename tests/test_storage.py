"""Who owns stored tables, and when they go."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pricelens import storage
from pricelens.session import scratch_path, stage_table


@pytest.fixture
def folders(spark, tmp_path, monkeypatch):
    """The folders below a shared folder of this test's own."""
    storage.release(spark)
    monkeypatch.setattr(storage, "scratch_dir", lambda session: str(tmp_path))
    return lambda: sorted(p.name.rsplit("-", 1)[0] for p in Path(tmp_path).iterdir())


def test_a_block_deletes_what_was_stored_in_it(spark, folders):
    with storage.storage(spark):
        table = stage_table(spark.range(5), "t")
        Path(scratch_path(spark, "made")).mkdir()
        assert table.count() == 5 and folders() == ["made", "t"]
    assert folders() == []


def test_a_failing_block_deletes_too(spark, folders):
    with pytest.raises(ZeroDivisionError), storage.storage(spark):
        stage_table(spark.range(5), "t")
        raise ZeroDivisionError
    assert folders() == []


def test_results_pass_to_the_block_around(spark, folders):
    def operator():
        with storage.storage(spark) as own:
            passes = stage_table(spark.range(10), "passes")
            return own.result(passes.filter("id < 3"), "result")

    with storage.storage(spark):
        found = operator()
        assert folders() == ["result"] and found.count() == 3
    assert folders() == []


def test_outside_a_block_the_session_owns(spark, folders):
    table = stage_table(spark.range(4), "loose")
    assert folders() == ["loose"] and table.count() == 4
    storage.release(spark)
    assert folders() == []


def test_one_table_per_key_in_the_outermost_block(spark, folders):
    made = []

    def make(home):
        made.append(1)
        return home.stage(spark.range(3).withColumn("x", F.lit(1)), "shared")

    with storage.storage(spark):
        with storage.storage(spark):
            one = storage.share(spark, ("a", 1), make)
        with storage.storage(spark):
            two = storage.share(spark, ("a", 1), make)
        storage.share(spark, ("a", 2), make)
        assert one is two and len(made) == 2 and folders() == ["shared", "shared"]
    assert folders() == []
    with storage.storage(spark):
        storage.share(spark, ("a", 1), make)
    assert len(made) == 3


def test_a_shared_table_that_was_deleted_is_made_again(spark, folders, tmp_path):
    make = lambda home: home.stage(spark.range(3), "shared")
    with storage.storage(spark):
        one = storage.share(spark, "k", make)
        for path in tmp_path.iterdir():
            shutil.rmtree(path)
        two = storage.share(spark, "k", make)
        assert two is not one and two.count() == 3 and storage.share(spark, "k", make) is two


def test_an_unreachable_store_is_told_and_left(spark, caplog):
    storage.delete_folder("nosuchstore://x/y")
    assert "could not delete" in caplog.text
