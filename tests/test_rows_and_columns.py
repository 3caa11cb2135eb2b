import math

import pytest
from pyspark.sql import functions as F

from pricelens import constants
from pricelens.operators import columns, rows
from pricelens.plans.cleaning import clean_listings, type_listings
from pricelens.plans.modelling import build_model_frame, derive_features


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def test_keep_numeric_ids(spark):
    df = spark.createDataFrame(
        [("1",), ("007",), ("x1",), ("1x",), ("",), (None,), ("-3",), ("1.0",)], "id string"
    )
    assert ids(rows.keep_numeric_ids(df)) == ["007", "1"]


def test_price_filters(spark):
    df = spark.createDataFrame(
        [(1, None), (2, -1.0), (3, 0.0), (4, 0.5), (5, 2000.0), (6, 2000.5)], "id int, price double"
    )
    assert ids(rows.require_not_null(df, ["price"])) == [2, 3, 4, 5, 6]
    assert ids(rows.positive(df)) == [4, 5, 6]
    assert ids(rows.cap_range(df, "price", *constants.PRICE_CAP)) == [4, 5]
    assert ids(rows.only(df, id=4, price=0.5)) == [4]


def test_drop_and_fill_treat_nan_like_null(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (2, math.nan, "a"), (3, None, "a"), (4, 1.0, None)],
        "id int, x double, s string",
    )
    assert ids(rows.drop_incomplete(df, ["x", "s"])) == [1]
    filled = rows.fill_defaults(df, {"x": 9.0, "absent": 1.0})
    assert [r.x for r in filled.orderBy("id").collect()] == [1.0, 9.0, 9.0, 1.0]


def test_splits_are_disjoint_complete_and_layout_independent(spark):
    df = spark.range(5000)
    train, test = rows.split(df, "id", 80, 42)
    again, _ = rows.split(df.repartition(3, (F.col("id") % 7)), "id", 80, 42)
    assert ids(train) == ids(again)
    assert sorted(ids(train) + ids(test)) == list(range(5000))
    assert 0.77 < train.count() / 5000 < 0.83
    marked = rows.mark_split(df, "id", 80, 42)
    assert ids(marked.filter("part = 'train'")) == ids(train)
    left, right = rows.random_split(df, 80, 42)
    assert left.count() + right.count() == 5000


def test_scatter_sample_is_a_stable_share(spark):
    df = spark.range(20000)
    sample = rows.scatter_sample(df, "id", 100, 42)
    assert 0.08 < sample.count() / 20000 < 0.12
    assert ids(sample) == ids(rows.scatter_sample(df.repartition(5), "id", 100, 42))


def test_preview_is_ordered(spark):
    assert [r.id for r in rows.preview(spark.range(100), 3, ["id"]).collect()] == [0, 1, 2]


def test_union_sources_keeps_common_columns_in_first_frames_order(spark):
    la = spark.createDataFrame([(1, "p", 2.0)], "b int, only_la string, a double")
    ny = spark.createDataFrame([(5.0, 3, "q"), (5.0, 3, "q")], "a double, b int, only_ny string")
    united = columns.union_sources({"LA": la, "NY": ny})
    assert united.columns == ["b", "a", "city"]
    assert sorted(map(tuple, united.collect())) == [(1, 2.0, "LA"), (3, 5.0, "NY"), (3, 5.0, "NY")]


def test_column_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="c, d"):
        columns.require_columns(df, ["a", "c", "d"])
    assert columns.present_columns(df, ["z", "b", "a"], "numeric") == ["b", "a"]
    with pytest.raises(ValueError, match="numeric"):
        columns.present_columns(df, ["z"], "numeric")


RAW = "id string, price string, reviews_per_month string, last_review string, name string"


def test_clean_listings(spark):
    raw = spark.createDataFrame(
        [
            ("1", "$1,200", None, "2024-01-05", "ok"),
            ("x", "5", "1", "2024-01-05", "bad id"),
            ("2", "Private room", "1", "2024-01-05", "bad price"),
            ("3", "7", "NaN", "01/05/2024", "gaps"),
            ("4", None, "1", None, "no price"),
        ],
        RAW,
    )
    cleaned = clean_listings(raw, drop_columns=constants.IDENTIFIER_COLUMNS)
    assert cleaned.columns == ["id", "price", "reviews_per_month", "last_review"]
    got = {r.id: (r.price, r.reviews_per_month, str(r.last_review)) for r in cleaned.collect()}
    assert got == {"1": (1200.0, 0.0, "2024-01-05"), "3": (7.0, 0.0, "None")}
    bare = clean_listings(raw, strip="")
    assert ids(bare) == ["3"]


def test_typing_is_a_single_projection(spark):
    raw = spark.createDataFrame([("1", "2", "3", "2024-01-01", "n")], RAW)
    types = dict(type_listings(raw).dtypes)
    assert types["price"] == "double" and types["last_review"] == "date" and types["id"] == "string"


def listing_frame(spark, drop=()):
    names = [
        "id", "city", "price", "latitude", "longitude", "minimum_nights", "number_of_reviews",
        "reviews_per_month", "availability_365", "calculated_host_listings_count",
        "number_of_reviews_ltm", "room_type", "neighbourhood_group",
    ]
    good = ("1", "LA", 10.0, 34.0, -118.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "Entire", "A")

    def but(**changes):
        return tuple(changes.get(n, v) for n, v in zip(names, good, strict=True))

    data = [
        good,
        but(id="2", city="NY", room_type="Private", neighbourhood_group="B"),
        but(id="3", price=0.0),
        but(id="4", price=None),
        but(id="5", latitude=None),
        but(id="6", room_type=None),
        but(id="7", minimum_nights=math.nan),
        but(id="8", city="SF"),
    ]
    kinds = {n: "string" for n in ("id", "city", "room_type", "neighbourhood_group")}
    schema = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)
    return spark.createDataFrame(data, schema).drop(*drop)


def test_derive_features_drops_unusable_rows(spark):
    derived = derive_features(listing_frame(spark))
    assert ids(derived) == ["1", "2"]
    assert derived.filter("log_price is null or dist_to_center is null").isEmpty()
    assert ids(derive_features(listing_frame(spark), fallback_city="NY")) == ["1", "2", "8"]


def test_model_frame_column_rules(spark):
    with pytest.raises(ValueError, match="price"):
        build_model_frame(listing_frame(spark, ["price"]))
    with pytest.raises(ValueError, match="room_type"):
        build_model_frame(listing_frame(spark, ["room_type", "neighbourhood_group"]))
    frame, _ = build_model_frame(listing_frame(spark, ["number_of_reviews_ltm"]))
    assert frame.columns == ["id", "city", "log_price", "features"]
    assert {r.features.size for r in frame.collect()} == {8 + 2 + 2}


def test_encoder_can_be_fitted_on_a_subset(spark):
    only_la = lambda df: df.filter("city = 'LA'")
    frame, _ = build_model_frame(listing_frame(spark), fit_on=only_la)
    vectors = {r.id: r.features.toArray().tolist() for r in frame.collect()}
    assert len(vectors["1"]) == 9 + 1 + 1
    assert vectors["1"][9:] == [1.0, 1.0] and vectors["2"][9:] == [0.0, 0.0]
