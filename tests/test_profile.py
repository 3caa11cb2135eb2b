import math
import struct

import numpy as np
import pandas as pd
import pytest

from pricelens.functions.bits import with_order_key
from pricelens.operators import percentiles, profile
from pricelens.operators.percentiles import approximate_percentiles, exact_percentiles, percentile_name

PERCENTAGES = [0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.95, 0.99, 0.999, 1.0]


@pytest.fixture(scope="module")
def skewed():
    """Two thirds of group a share one value; b is small; v has a heavy tail."""
    rng = np.random.default_rng(7)
    v = np.concatenate([np.full(8000, 5.0), rng.lognormal(3, 2, 6000).round(2)])
    g = np.where(rng.random(14000) < 0.9, "a", "b")
    g[:8000] = "a"
    w = rng.normal(size=14000)
    w[rng.random(14000) < 0.1] = np.nan
    return pd.DataFrame({"g": g, "v": v, "w": w})


@pytest.fixture(scope="module")
def skewed_frame(spark, skewed):
    return spark.createDataFrame(skewed).repartition(7).cache()


@pytest.mark.parametrize("bits", [11, 5])
def test_exact_percentiles_match_brute_force(skewed, skewed_frame, monkeypatch, bits):
    monkeypatch.setattr(percentiles, "RADIX_BITS", bits)
    out = exact_percentiles(skewed_frame, ["v", "w"], PERCENTAGES, ["g"])
    rows = out.collect()
    assert len(rows) == 4
    for r in rows:
        values = skewed[skewed.g == r.g][r.column].dropna()
        assert r.n == len(values)
        got = [r[percentile_name(p)] for p in PERCENTAGES]
        assert got == pytest.approx(np.quantile(values, PERCENTAGES).tolist(), rel=1e-12)


def test_many_groups_take_the_shuffle_path(spark, skewed_frame):
    """With sides too large to broadcast the results stay the same."""

    def results():
        percentiles = exact_percentiles(skewed_frame, ["v", "w"], [0.25, 0.9], ["g"])
        bins = profile.histogram(skewed_frame, ["v", "w"], 20, ["g"])
        return [sorted(map(str, df.collect())) for df in (percentiles, bins)]

    broadcast = results()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert results() == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_percentiles_of_null_keys_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(None, 1.0, None), (None, 3.0, None), ("x", 5.0, None)], "g string, v double, w double"
    )
    out = exact_percentiles(df, ["v", "w"], [0.5], ["g"])
    got = {(r.g, r.column): (r.n, r.p50) for r in out.collect()}
    assert got == {
        (None, "v"): (2, 2.0),
        ("x", "v"): (1, 5.0),
        (None, "w"): (0, None),
        ("x", "w"): (0, None),
    }


def test_percentiles_without_groups(spark):
    df = spark.range(1, 102).selectExpr("cast(id as double) v")
    assert exact_percentiles(df, ["v"], [0.1, 0.5]).first()[1:] == (101, 11.0, 51.0)


def test_percentiles_of_odd_values(spark):
    inf = float("inf")
    rows = [("same", 7.0)] * 500 + [("wide", x) for x in (-inf, -1e308, -5.0, -5e-324, 0.0, 1e-300, 3.0, 1e308, inf)]
    rows += [("powers", 2.0**k) for k in range(-30, 31)] + [("ends", inf), ("ends", -inf)]
    out = exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["v"], [0.0, 0.25, 0.5, 1.0], ["g"])
    got = {r.g: tuple(r)[2:] for r in out.collect()}
    assert got["same"] == (500, 7.0, 7.0, 7.0, 7.0)
    assert got["wide"] == (9, -inf, -5.0, 0.0, inf)
    assert got["powers"] == (61, 2.0**-30, 2.0**-15, 1.0, 2.0**30)
    assert got["ends"][1] == -inf and got["ends"][4] == inf


def test_order_keys_are_the_bits(spark):
    """All exponents, the doubles beside powers of two, both ends of the format."""
    values = [0.0, -0.0, math.inf, -math.inf, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308]
    for e in range(-1074, 1024, 7):
        power = math.ldexp(1.0, e)
        values += [power, -power, math.nextafter(power, 0), math.nextafter(power, math.inf)]
    values += [math.nextafter(math.ldexp(1.0, -1021), 0)]

    def bits(x):
        number = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        return -number if x < 0 else number

    found = with_order_key(spark.createDataFrame([(x,) for x in values], "v double"), "v", "k").collect()
    assert [r.k for r in found] == [bits(r.v) for r in found]


def test_percentile_rounds_are_bounded(spark, monkeypatch):
    """400 values over 120 decades of both signs, and 400 neighbours in the last bits."""
    staged = []
    plain = percentiles.stage_table
    monkeypatch.setattr(percentiles, "stage_table", lambda df, name: staged.append(name) or plain(df, name))
    wide = [(-1) ** i * 10.0 ** (i * 0.3 - 60) for i in range(400)]
    close = [1.0 + i * 2.0**-52 for i in range(400)]
    df = spark.createDataFrame([("wide", x) for x in wide] + [("close", x) for x in close], "g string, v double")
    marks = [0.1, 0.37, 0.5, 0.9]
    for r in exact_percentiles(df, ["v"], marks, ["g"]).collect():
        want = np.quantile(wide if r.g == "wide" else close, marks)
        assert [r[percentile_name(p)] for p in marks] == pytest.approx(want.tolist(), rel=1e-15)
    assert staged.count("targets") <= 7 and staged.count("survivors") == 1


def test_sketches_are_merged_in_two_levels(spark, skewed, skewed_frame):
    out = approximate_percentiles(skewed_frame, ["v", "w"], [0.5], ["g"], slices=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("kll_sketch_agg_double") and plan.count("kll_merge_agg_double") and plan.count("Exchange") >= 2
    for r in out.collect():
        values = skewed[skewed.g == r.g][r.column].dropna().to_numpy()
        assert r.n == len(values) and (values < r.p50).mean() - 0.02 <= 0.5 <= (values <= r.p50).mean() + 0.02


def test_approximate_percentiles_are_close_in_rank(skewed, skewed_frame):
    out = profile.quartiles(skewed_frame, ["v"], [0.25, 0.9], ["g"], approx=True)
    for r in out.collect():
        values = skewed[skewed.g == r.g].v.to_numpy()
        for p, got in ((0.25, r.p25), (0.9, r.p90)):
            assert (values < got).mean() - 0.01 <= p <= (values <= got).mean() + 0.01


def test_tail_profile(skewed, skewed_frame):
    for r in profile.tail_profile(skewed_frame, "v", [0.95, 0.99], ["g"]).collect():
        values = skewed[skewed.g == r.g].v
        assert r.max == values.max()
        assert [r.p95, r.p99] == pytest.approx(np.quantile(values, [0.95, 0.99]).tolist())


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "x int, y string, g string")
    assert profile.null_counts(df, ["x", "y"]).first().asDict() == {"x": 1, "y": 2}
    by = {r.g: (r.x, r.y) for r in profile.null_counts(df, ["x", "y"], ["g"]).collect()}
    assert by == {"a": (0, 1), "b": (1, 1)}


def test_describe(skewed, skewed_frame):
    clean = skewed_frame.na.drop()
    expected = skewed.dropna().groupby("g")
    for r in profile.describe_by(clean, ["v", "w"], ["g"]).collect():
        values = expected.get_group(r.g)[r.column]
        stats = [values.count(), values.mean(), values.std(), values.min(), values.max()]
        assert [r.n, r.mean, r.stddev, r.min, r.max] == pytest.approx(stats)
    whole = profile.describe_by(clean, ["v"]).first()
    assert whole.n == len(skewed.dropna()) and whole.column == "v"


def test_describe_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert tuple(profile.describe_text_by(df, ["s"]).first()) == ("s", 2, "a", "b")


def test_range_of(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "x double")
    assert tuple(profile.range_of(df, "x").first()) == (1.0, 4.0, 3)


def test_histogram_matches_numpy(skewed, skewed_frame):
    out = profile.histogram(skewed_frame, ["v", "w"], 50, ["g"]).toPandas()
    assert len(out) == 4 * 50
    for (g, column), part in out.groupby(["g", "column"]):
        values = skewed[skewed.g == g][column].dropna()
        counts, edges = np.histogram(values, bins=50)
        part = part.sort_values("bin")
        assert part.n.tolist() == counts.tolist()
        assert part.lower.tolist() == pytest.approx(edges[:-1].tolist())
        assert part.upper.tolist() == pytest.approx(edges[1:].tolist())


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    counts = {r.bin: r.n for r in profile.histogram(df, ["x"], 4).collect()}
    assert counts == {0: 2, 1: 0, 2: 0, 3: 0}


def test_correlation_is_pairwise_like_pandas(spark, skewed, skewed_frame):
    pdf = skewed.assign(u=skewed.v * 0.5 + skewed.w.fillna(0), c=1.0)
    df = spark.createDataFrame(pdf)
    names = ["v", "w", "u", "c"]
    got = profile.correlation(df, names, ["g"]).toPandas()
    assert len(got) == 2 * 16
    for g, part in got.groupby("g"):
        expected = pdf[pdf.g == g][names].corr()
        for r in part.itertuples():
            want = expected.loc[r.a, r.b]
            assert (math.isnan(want) and math.isnan(r.r)) or r.r == pytest.approx(want)


def test_geo_grid_and_binned_pair(spark):
    df = spark.createDataFrame(
        [(0.1, 0.1, 10.0), (0.2, 0.1, 20.0), (-0.1, 0.1, 5.0), (None, 0.1, 7.0)],
        "lat double, lon double, p double",
    )
    grid = profile.geo_grid(df, "lat", "lon", "p", 0.5, 1.0).collect()
    assert {(r.lat_cell, r.lon_cell): (r.n, r["mean"]) for r in grid} == {
        (0, 0): (2, 15.0),
        (-1, 0): (1, 5.0),
    }
    pair = profile.binned_pair(df, "lon", "p").first()
    assert tuple(pair) == (0.1, 4, 10.5, 5.0, 20.0)
