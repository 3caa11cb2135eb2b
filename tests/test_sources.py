import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from pricelens.plans.cleaning import clean_listings
from pricelens.schemas import IMPORTANCE, METRICS, MODEL_FRAME
from pricelens.sources.frames import read_model_frame, read_table, write_model_frame, write_table
from pricelens.sources.listings import read_listings, write_csv
from pricelens.sources.reports import read_report, rows_to_frame, write_report

DIRTY = (
    'id,name,price,last_review\n'
    '1,"ok","$1,200",2024-01-05\n'
    '2,"two\nlines",50,2024-01-06\n'
    '3,"say ""hi"", ok",60,2024-01-07\n'
    ',x,5,2024-01-01\n'
    'abc,y,5,2024-01-01\n'
    '4,z,,\n'
)


@pytest.fixture
def dirty(tmp_path):
    path = tmp_path / "listings.csv"
    path.write_text(DIRTY)
    return str(path)


def kept(df):
    return {r.id: r.price for r in clean_listings(df).collect()}


def test_line_mode_loses_records_with_inner_breaks_or_quotes(spark, dirty):
    assert kept(read_listings(spark, dirty)) == {"1": 1200.0}


def test_multiline_mode_recovers_them(spark, dirty):
    df = read_listings(spark, dirty, multiline=True)
    assert kept(df) == {"1": 1200.0, "2": 50.0, "3": 60.0}
    assert set(dict(df.dtypes).values()) == {"string"}


def test_inference_and_declared_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,price\n1,2.5\n2,3\n")
    assert dict(read_listings(spark, str(path), infer=True).dtypes) == {
        "id": "int",
        "price": "double",
    }
    right = StructType([StructField("id", StringType()), StructField("price", DoubleType())])
    assert read_listings(spark, str(path), schema=right).agg(F.sum("price")).first()[0] == 5.5
    wrong = StructType([StructField("price", StringType()), StructField("id", StringType())])
    with pytest.raises(Exception, match="(?i)header"):
        read_listings(spark, str(path), schema=wrong).collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_round_trip(spark, tmp_path, multiline):
    rows = [("1", 'say "hi", ok', 1.5), ("2", None, None), ("3", "", 2.0), ("4", "a\\b", 3.0)]
    if multiline:
        rows.append(("5", "two\nlines", 4.0))
    df = spark.createDataFrame(rows, "id string, name string, price double")
    write_csv(df, str(tmp_path / "out"), multiline)
    back = read_listings(spark, str(tmp_path / "out"), multiline)
    got = {r.id: (r.name, r.price) for r in back.collect()}
    assert got["1"] == ('say "hi", ok', "1.5")
    assert got["2"] == (None, None) and got["3"] == (None, "2.0")
    if multiline:
        assert got["5"] == ("two\nlines", "4.0")


def test_csv_folder_per_city(spark, tmp_path):
    df = spark.createDataFrame([("1", "LA"), ("2", "NY")], "id string, city string")
    write_csv(df, str(tmp_path / "out"), partition_by=["city"])
    la = read_listings(spark, str(tmp_path / "out" / "city=LA"))
    assert [r.id for r in la.collect()] == ["1"]


def test_model_frame_round_trip_prunes_to_one_city(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [("1", 2.0, Vectors.sparse(4, [1], [1.0]), "LA"), ("2", 3.0, Vectors.dense(1, 2, 3, 4), "NY")],
        MODEL_FRAME,
    )
    path = str(tmp_path / "frame")
    write_model_frame(df, path)
    write_model_frame(df, path)
    one = read_model_frame(spark, path).filter("city = 'LA'")
    assert [(r.id, r.features[1]) for r in one.collect()] == [("1", 1.0)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan


def test_table_round_trip_without_folders(spark, tmp_path):
    write_table(spark.range(5).toDF("x"), str(tmp_path / "t"), partition_by=None)
    assert read_table(spark, str(tmp_path / "t")).count() == 5


def test_reports_are_one_file(spark, tmp_path):
    rows = [("LA", "GBT", 0, 0.25), ("LA", "GBT", 1, 0.1 + 0.2)]
    df = rows_to_frame(spark, rows, IMPORTANCE)
    path = tmp_path / "report"
    write_report(df.repartition(4), str(path))
    assert len(list(path.glob("part-*"))) == 1
    assert sorted(map(tuple, read_report(spark, str(path), IMPORTANCE).collect())) == rows


def test_metrics_schema_accepts_a_failed_fit(spark):
    df = rows_to_frame(spark, [("LA", "GBT", None, None, None, None, "failed: x")], METRICS)
    assert df.first().rmse is None
