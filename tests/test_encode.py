import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from pricelens.operators import encode


@pytest.fixture
def frame(spark):
    rows = [("E", "a", 1.0), ("H", "b", 2.0), ("E", "b", 3.0), ("H", None, 4.0), ("P", "b", 5.0),
            ("S", "c", 6.0)]
    return spark.createDataFrame(rows, "room string, area string, x double")


def test_category_index_orders_by_frequency_then_name(frame):
    got = [tuple(r) for r in encode.category_index(frame, ["room", "area"]).collect()]
    assert sorted(got) == [
        ("area", "a", 1, 1), ("area", "b", 3, 0), ("area", "c", 1, 2),
        ("room", "E", 2, 0), ("room", "H", 2, 1), ("room", "P", 1, 2), ("room", "S", 1, 3),
    ]


def test_indexer_agrees_with_the_built_in_fit(frame):
    ours = encode.fit_indexers(frame, ["room", "area"])
    built_in = StringIndexer(
        inputCols=["room", "area"], outputCols=["i", "j"], handleInvalid="keep"
    ).fit(frame)
    assert [list(s.labels) for s in ours.stages] == [list(x) for x in built_in.labelsArray]


def test_too_many_levels_is_an_error(frame):
    with pytest.raises(ValueError, match="levels"):
        encode.fit_indexers(frame, ["room", "area"], max_levels=3)


def test_category_index_has_no_bound(spark):
    wide = spark.range(10_001).select(F.concat(F.lit("v"), "id").alias("c"))
    assert encode.category_index(wide, ["c"]).agg({"idx": "max"}).first()[0] == 10_000


def test_encoder_vectors_and_unseen_levels(spark, frame):
    model = encode.fit_encoder(frame, ["x"], ["room", "area"])
    new = spark.createDataFrame(
        [("H", "c", 9.0), ("Z", None, 8.0), ("E", "a", float("nan"))],
        "room string, area string, x double",
    )
    rows = [r.features.toArray().tolist() for r in model.transform(new).collect()]
    assert rows[0] == [9.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    assert rows[1] == [8.0] + [0.0] * 7
    assert rows[2][0] != rows[2][0] and rows[2][1:] == [1.0, 0, 0, 0, 0, 1.0, 0]


def test_encoder_agrees_with_separately_fitted_stages(frame):
    ours = encode.fit_encoder(frame, ["x"], ["room"]).transform(frame)
    indexed = StringIndexer(inputCol="room", outputCol="i", handleInvalid="keep").fit(frame)
    built_in = OneHotEncoder(inputCol="i", outputCol="v", dropLast=True)
    theirs = built_in.fit(indexed.transform(frame)).transform(indexed.transform(frame))
    a = sorted((r.x, r.room_ohe.toArray().tolist()) for r in ours.collect())
    b = sorted((r.x, r.v.toArray().tolist()) for r in theirs.collect())
    assert a == b


def test_feature_index_map_survives_saving(spark, frame, tmp_path):
    model = encode.fit_encoder(frame, ["x"], ["room", "area"])
    encode.save_encoder(model, str(tmp_path / "encoder"))
    encode.save_encoder(model, str(tmp_path / "encoder"))
    loaded = encode.load_encoder(str(tmp_path / "encoder"))
    got = [tuple(r) for r in encode.feature_index_map(spark, loaded).orderBy("feature_index").collect()]
    assert got == [
        (0, "x", "x", None),
        (1, "room_ohe_0", "room", "E"), (2, "room_ohe_1", "room", "H"),
        (3, "room_ohe_2", "room", "P"), (4, "room_ohe_3", "room", "S"),
        (5, "area_ohe_0", "area", "b"), (6, "area_ohe_1", "area", "a"),
        (7, "area_ohe_2", "area", "c"),
    ]
    assert loaded.transform(frame).first().features == model.transform(frame).first().features


def test_category_index_is_ranked_in_many_tasks(spark):
    """No window over a column's levels: each range of them is numbered by itself."""
    wide = spark.range(0, 60_000, 1, 6).select((F.col("id") % 40_000).cast("string").alias("c"), F.lit("one").alias("d"))
    found = encode.category_index(wide, ["c", "d"]).toPandas()
    c = found[found.column == "c"].sort_values("idx")
    want = sorted(range(40_000), key=lambda i: (-(2 if i < 20_000 else 1), str(i)))
    assert c.level.tolist() == [str(i) for i in want] and c.idx.tolist() == list(range(40_000))
    assert found[found.column == "d"][["n", "idx"]].values.tolist() == [[60_000, 0]]


def test_long_features_are_the_vectors_entries(spark, frame):
    keyed = frame.withColumn("id", F.monotonically_increasing_id())
    encoder = encode.fit_encoder(keyed, ["x"], ["room", "area"])
    vectors = encoder.transform(keyed).select("id", "features").collect()
    want = {(r.id, int(i), float(v)) for r in vectors for i, v in enumerate(r.features.toArray()) if v}
    assert {tuple(r) for r in encode.long_features(keyed, ["id"], ["x"], ["room", "area"]).collect()} == want


def test_long_features_of_many_levels(spark):
    wide = spark.range(12_000).select("id", (F.col("id") % 3).cast("double").alias("x"), F.concat(F.lit("v"), "id").alias("c"))
    long = encode.long_features(wide, ["id"], ["x"], ["c"])
    assert long.filter("position = 0").count() == 8_000
    found = long.filter("position > 0").agg(F.countDistinct("position"), F.min("position"), F.max("position")).first()
    assert tuple(found) == (12_000, 1, 12_000)
