import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from pricelens import constants
from pricelens.functions.casts import clean_currency, safe_date, safe_double
from pricelens.functions.measures import distance_to_center, hash_bucket, log_target


def applied(spark, values, schema, make):
    rows = spark.createDataFrame([(v,) for v in values], f"x {schema}").select(make(F.col("x")))
    return [r[0] for r in rows.collect()]


def test_safe_double_reads_numbers_and_nulls_the_rest(spark):
    texts = ["Private room", "", " 7 ", "1e3", "+3", ".5", "NaN", "Infinity", "-Infinity", None, "1_000"]
    expected = [None, None, 7.0, 1000.0, 3.0, 0.5, None, None, None, None, None]
    assert applied(spark, texts, "string", safe_double) == expected


def test_safe_double_can_keep_non_finite_values(spark):
    nan, inf = applied(spark, ["NaN", "Infinity"], "string", lambda c: safe_double(c, False))
    assert math.isnan(nan) and inf == math.inf


def test_clean_currency(spark):
    texts = ["$1,200.50", "1,200", "$-5", "Private room", None]
    assert applied(spark, texts, "string", clean_currency) == [1200.5, 1200.0, -5.0, None, None]
    bare = applied(spark, texts, "string", lambda c: clean_currency(c, strip=""))
    assert bare == [None, None, None, None, None]


def test_safe_date(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-01-05 10:00:00", "01/05/2024", "2024-02-30", "", None]
    day = dt.date(2024, 1, 5)
    assert applied(spark, texts, "string", safe_date) == [day, day, day, None, None, None, None]


def test_log_target(spark):
    assert applied(spark, [0.0, math.e - 1], "double", log_target) == pytest.approx([0.0, 1.0])


PLACES = [
    ("LA", 34.0522, -118.2437, 0.0),
    ("LA", 35.0522, -118.2437, 1.0),
    ("NY", 40.7128, -74.0060, 0.0),
    ("NY", 43.7128, -70.0060, 5.0),
    ("LA", None, -118.0, None),
]


def distances(spark, places, **options):
    df = spark.createDataFrame([p[:3] for p in places], "city string, lat double, lon double")
    d = distance_to_center(
        F.col("lat"), F.col("lon"), F.col("city"), constants.CITY_CENTERS, **options
    )
    return [r[0] for r in df.select(d).collect()]


def test_distance_to_center(spark):
    expected = [p[3] for p in PLACES]
    assert distances(spark, PLACES)[:4] == pytest.approx(expected[:4])
    assert distances(spark, PLACES)[4] is None


def test_distance_of_an_unknown_city(spark):
    elsewhere = [("SF", 40.7128, -73.0060), (None, 40.7128, -74.0060)]
    assert distances(spark, elsewhere) == [None, None]
    assert distances(spark, elsewhere, fallback="NY") == pytest.approx([1.0, 0.0])


def test_hash_bucket_depends_on_key_and_seed_only(spark):
    def expected(key, seed):
        return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:8], 16) % 100

    keys = list(range(200))
    for seed in (42, 7):
        got = applied(spark, keys, "bigint", lambda c, s=seed: hash_bucket(c, s, 100))
        assert got == [expected(k, seed) for k in keys]
