"""Every operator as a query over the star-schema tables.

Each function takes the session and a table folder and returns a frame. The
keys of ``QUERIES`` are those of ``oracle_sql.ORACLES``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens import constants
from pricelens.functions.casts import clean_currency, safe_date, safe_double
from pricelens.functions.measures import distance_to_center, log_target
from pricelens.operators import columns as column_ops
from pricelens.operators import encode, linear, profile, report, rows, train
from pricelens.operators.evaluate import evaluate
from pricelens.plans import bindings, jobs
from pricelens.plans.cleaning import clean_listings
from pricelens.plans.modelling import build_model_frame, derive_features, feature_columns, stage_counts
from pricelens.schemas import IMPORTANCE
from pricelens.session import join_on, scratch_path, small_side, stage_table
from pricelens.sources.frames import read_model_frame, write_model_frame
from pricelens.sources.listings import read_listings, write_csv
from pricelens.sources.reports import read_report, write_report
from pricelens.storage import Storage, share, storage

Query = Callable[[SparkSession, str], DataFrame]

# About half of the listings made from the tables lie below this price.
VIEW_PRICE_CAP = (0.0, 200_000.0)
CITY = ["city"]
MODEL_COLUMNS = tuple(
    dict.fromkeys(
        (
            "id",
            "city",
            *constants.REQUIRED_COLUMNS,
            *(c for c in constants.NUMERIC_FEATURES if c != "dist_to_center"),
        )
    )
)


def rounded(value: Column, digits: int) -> Column:
    """Rounded, with negative zero made plain."""
    return F.round(value, digits) + F.lit(0.0)


def round_columns(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), digits) for c in names})


def clean(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    wanted = {"id", "price", *columns}
    return clean_listings(bindings.raw_listings(spark, sf_dir, wanted))


def source_files(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """What tells one set of listings from another: the files they are made from."""
    names = ("orders", "customer", "lineitem")
    return tuple(sorted(f for n in names for f in bindings.table(spark, sf_dir, n).inputFiles()))


def stored_clean(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Columns of the clean listings, written out once per source: the input of profiles and features.

    The joins and casts behind them then run once however many queries follow and
    however often a column is referred to, price filters reach the scan, and a pass that
    is repeated after a lost executor starts from the stored columns.
    """
    stored = share(
        spark,
        ("clean", *source_files(spark, sf_dir)),
        lambda home: home.stage(clean(spark, sf_dir, bindings.LISTING_COLUMNS), "clean"),
    )
    wanted = {"id", "price", *columns}
    return stored.select(*[c for c in stored.columns if c in wanted])


# --- sources and sinks -------------------------------------------------------


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_counts(bindings.raw_listings(spark, sf_dir, MODEL_COLUMNS))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = bindings.listings(spark, sf_dir, ["id", "city", "price", "room_type"])
    return rows.preview(listings, 20, ["id"])


CLEAN_OUTPUT = (
    "id",
    "city",
    "price",
    "latitude",
    "minimum_nights",
    "reviews_per_month",
    "number_of_reviews_ltm",
    "last_review",
    "room_type",
)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_listings(spark, sf_dir, [*CLEAN_OUTPUT, *constants.IDENTIFIER_COLUMNS])
    return clean_listings(raw, drop_columns=constants.IDENTIFIER_COLUMNS)


def csv_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text out to one CSV folder per city, read back, cleaned and united."""
    path = scratch_path(spark, "listings")
    write_csv(bindings.raw_listings(spark, sf_dir, CLEAN_OUTPUT), path, partition_by=CITY)
    written = bindings.raw_listings(spark, sf_dir, ["city"]).select("city").distinct().collect()
    frames = {
        r.city: clean_listings(read_listings(spark, f"{path}/city={r.city}")) for r in written
    }
    return column_ops.union_sources(frames).select(*CLEAN_OUTPUT)


def model_frame_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model frame written by city and read back."""
    frame, _ = build_model_frame(stored_clean(spark, sf_dir, MODEL_COLUMNS))
    path = scratch_path(spark, "model_frame")
    write_model_frame(frame, path)
    return read_model_frame(spark, path).select(
        "id",
        "city",
        rounded(F.col("log_price"), 6).alias("log_price"),
        F.size(vector_to_array("features")).alias("width"),
        rounded(vector_to_array("features")[6], 6).alias("dist_to_center"),
    )


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = feature_scores(stored_features(spark, sf_dir))
    path = scratch_path(spark, "importance")
    write_report(scores, path)
    ranked = report.rank_importance(read_report(spark, path, IMPORTANCE))
    return round_columns(ranked, 6, "importance")


# --- filters and scalar functions --------------------------------------------


def keep_numeric_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.keep_numeric_ids(bindings.raw_listings(spark, sf_dir, ["id", "city"]))


def require_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.require_not_null(
        bindings.raw_listings(spark, sf_dir, ["city", "price", "room_type"]), ["price"]
    )


def positive_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.positive(stored_clean(spark, sf_dir, ["city"]))


def price_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.cap_range(stored_clean(spark, sf_dir, ["city"]), "price", *VIEW_PRICE_CAP)


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["latitude", "minimum_nights", "room_type"]
    return rows.drop_incomplete(stored_clean(spark, sf_dir, needed), needed)


def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_listings(spark, sf_dir, ["id", *constants.REVIEW_DEFAULTS])
    typed = raw.withColumns(
        {c: safe_double(F.col(c), finite_only=False) for c in constants.REVIEW_DEFAULTS}
    )
    return rows.fill_defaults(typed, constants.REVIEW_DEFAULTS)


def currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_listings(spark, sf_dir, ["city", "price"])
    return raw.select(
        "city",
        F.col("price").alias("text"),
        clean_currency(F.col("price")).alias("stripped"),
        clean_currency(F.col("price"), strip="").alias("bare"),
    )


def doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_listings(spark, sf_dir)
    typed = [c for c in constants.DOUBLE_COLUMNS if c != "price"]
    return raw.select("host_id", *[safe_double(F.col(c)).alias(c) for c in typed])


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bindings.raw_listings(spark, sf_dir, ["city", "host_id", "last_review"])
    return raw.withColumn("last_review", safe_date(F.col("last_review")))


def log_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = rows.positive(stored_clean(spark, sf_dir, ["city"]))
    return priced.select(
        "id", "city", rounded(log_target(F.col("price")), 6).alias("log_price")
    )


def dist_to_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = stored_clean(spark, sf_dir, ["city", "latitude", "longitude"])
    distance = distance_to_center(
        F.col("latitude"), F.col("longitude"), F.col("city"), constants.CITY_CENTERS
    )
    return place.select("id", "city", rounded(distance, 6).alias("dist_to_center"))


# --- profiles ----------------------------------------------------------------


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [c for c in bindings.LISTING_COLUMNS if c != "city"]
    return profile.null_counts(clean_listings(bindings.raw_listings(spark, sf_dir)), names, CITY)


def describe_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = list(constants.DOUBLE_COLUMNS)
    described = profile.describe_by(stored_clean(spark, sf_dir, ["city", *names]), names, CITY)
    return round_columns(round_columns(described, 6, "mean", "min", "max"), 4, "stddev")


def describe_text_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["room_type", "neighbourhood_group", "host_name"]
    return profile.describe_text_by(stored_clean(spark, sf_dir, ["city", *names]), names, CITY)


def quartiles_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = list(constants.DOUBLE_COLUMNS)
    found = profile.quartiles(
        stored_clean(spark, sf_dir, ["city", *names]), names, constants.QUARTILE_PERCENTAGES, CITY
    )
    return round_columns(found, 4, "p25", "p50", "p75")


def price_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = profile.tail_profile(
        stored_clean(spark, sf_dir, ["city"]), "price", constants.TAIL_PERCENTAGES, CITY
    )
    return round_columns(tail, 4, "max", "p95", "p99")


def price_range_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = rows.cap_range(stored_clean(spark, sf_dir, ["city"]), "price", *VIEW_PRICE_CAP)
    return profile.range_of(capped, "price", CITY)


def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = profile.histogram(
        stored_clean(spark, sf_dir, ["city"]), ["price"], constants.HISTOGRAM_BINS, CITY
    )
    return round_columns(binned, 6, "lower", "upper")


def log_price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = rows.positive(stored_clean(spark, sf_dir, ["city"]))
    logged = priced.select("city", log_target(F.col("price")).alias("log_price"))
    binned = profile.histogram(logged, ["log_price"], constants.HISTOGRAM_BINS, CITY)
    return round_columns(binned, 6, "lower", "upper")


def geo_price_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = stored_clean(spark, sf_dir, ["city", "latitude", "longitude"])
    capped = rows.cap_range(place, "price", *VIEW_PRICE_CAP)
    grid = profile.geo_grid(capped, "latitude", "longitude", "price", 0.25, 0.02, CITY)
    return round_columns(grid, 6, "mean")


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = stored_clean(spark, sf_dir, ["city", "latitude", "longitude"])
    capped = rows.cap_range(place, "price", *VIEW_PRICE_CAP)
    return rows.points(capped, ["latitude", "longitude", "price"], CITY)


def nights_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = rows.positive(stored_clean(spark, sf_dir, ["city", "minimum_nights"]))
    logged = priced.withColumn("log_price", log_target(F.col("price")))
    return round_columns(rows.points(logged, ["minimum_nights", "log_price"], CITY), 6, "log_price")


def nights_vs_log_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = rows.positive(stored_clean(spark, sf_dir, ["city", "minimum_nights"]))
    logged = priced.withColumn("log_price", log_target(F.col("price")))
    spread = profile.binned_pair(logged, "minimum_nights", "log_price", CITY)
    return round_columns(spread, 6, "mean", "min", "max")


def scatter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = bindings.listings(spark, sf_dir, ["id", "city", "latitude", "longitude", "price"])
    return rows.scatter_sample(place, "id", per_mille=50, seed=constants.SPLIT_SEED)


def scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 200 points per city."""
    place = bindings.listings(spark, sf_dir, ["id", "city", "latitude", "longitude", "price"])
    return rows.sample_points(place, "id", 200, CITY, constants.SPLIT_SEED)


def price_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = list(constants.CORRELATION_COLUMNS)
    matrix = profile.correlation(stored_clean(spark, sf_dir, ["city", *names]), names, CITY)
    return round_columns(matrix, 6, "r")


# --- sets and groups ---------------------------------------------------------


def union_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per city, every other one with a private column of its own kind."""
    names = ["id", "city", "price", "room_type", "neighbourhood_group", "host_id"]
    listings = stage_table(bindings.listings(spark, sf_dir, names), "listings", CITY)
    cities = [r.city for r in listings.select("city").distinct().orderBy("city").collect()]
    private = ("host_id", "neighbourhood_group")
    return column_ops.union_sources(
        {c: rows.only(listings, city=c).drop("city", private[i % 2]) for i, c in enumerate(cities)}
    )


def split_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.only(bindings.listings(spark, sf_dir, ["id", "city", "price"]), city="LA")


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train.mark_parts(bindings.listings(spark, sf_dir, ["id", "city", "price"]))


# --- features ----------------------------------------------------------------


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = list(constants.CATEGORICAL_FEATURES)
    return encode.category_index(stored_clean(spark, sf_dir, names), names)


def one_hot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of the 1 in each encoding; rows without one (NULL level) are absent."""
    names = list(constants.CATEGORICAL_FEATURES)
    listings = stored_clean(spark, sf_dir, names)
    indexed = encode.fit_indexers(listings, names).transform(listings)
    encoded = encode.one_hot(names).fit(indexed).transform(indexed)
    ones = [F.array_position(vector_to_array(encode.one_hot_suffix(c)), 1.0) for c in names]
    return (
        encoded.select("id", F.posexplode(F.array(*ones)).alias("number", "place"))
        .filter(F.col("place") > 0)
        .select(
            "id",
            column_ops.name_at(names, F.col("number")).alias("column"),
            (F.col("place") - 1).cast("int").alias("position"),
            F.lit(1.0).alias("value"),
        )
    )


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector unpacked to one named column per position."""
    frame, encoder = build_model_frame(stored_clean(spark, sf_dir, MODEL_COLUMNS))
    names = encode.feature_index_map(spark, encoder).orderBy("feature_index").collect()
    unpacked = frame.withColumn("f", vector_to_array("features"))
    return unpacked.select(
        "id",
        "city",
        rounded(F.col("log_price"), 6).alias("log_price"),
        *[rounded(F.col("f")[r.feature_index], 6).alias(r.feature) for r in names],
    )


def model_frame_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors as one row per entry that is not zero."""
    derived = stored_features(spark, sf_dir)
    long = encode.long_features(derived, ["id", "city"], *feature_columns(derived))
    return round_columns(long, 6, "value")


def feature_index_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = stored_features(spark, sf_dir)
    return encode.feature_index_map(spark, encode.fit_encoder(derived, *feature_columns(derived)))


# --- models ------------------------------------------------------------------


def staged_model_frame(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The model frame, stored once per source in a folder per city and part, and its feature index map."""

    def make(home: Storage) -> tuple[DataFrame, DataFrame]:
        listings = stored_clean(spark, sf_dir, MODEL_COLUMNS)
        frame, encoder = build_model_frame(listings)
        path, folders = home.path("model_frame"), [*CITY, "part"]
        stored = train.store_layout(train.mark_parts(frame), path, folders, listings.count())
        return stored, encode.feature_index_map(spark, encoder)

    return share(spark, ("model_frame", *source_files(spark, sf_dir)), make)


def fit_report(spark: SparkSession, sf_dir: str, models: dict[str, Estimator]) -> DataFrame:
    """Metrics and named importances of every model and city, in long form."""
    frame, index_map = staged_model_frame(spark, sf_dir)
    cities = [r.city for r in frame.select("city").distinct().orderBy("city").collect()]
    results = train.train_by_group(frame, cities, models, train.stored_split)
    metrics = (
        train.metrics_frame(spark, results)
        .withColumn("kind", F.lit("metric"))
        .unpivot(["city", "model", "status", "kind"], ["rmse", "mae", "r2"], "name", "value")
    )
    named = report.name_features(train.importance_frame(spark, results), index_map).select(
        "city",
        "model",
        F.lit("ok").alias("status"),
        F.lit("importance").alias("kind"),
        F.col("feature").alias("name"),
        F.col("importance").alias("value"),
    )
    return metrics.unionByName(named)


def fit_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_report(spark, sf_dir, {"LinearRegression": train.linear_regression()})


def fit_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_report(spark, sf_dir, {"RandomForest": train.random_forest()})


def fit_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_report(spark, sf_dir, {"GBT": train.gradient_boosting()})


def simple_fits(
    spark: SparkSession,
    sf_dir: str,
    estimator: Estimator,
    numeric: Sequence[str],
    categorical: Sequence[str],
) -> tuple[list[train.Trained], dict[int, str]]:
    """One model per city on few features, and the features' names by position."""
    derived = stored_features(spark, sf_dir)
    if categorical:
        encoder = encode.fit_encoder(derived, numeric, categorical)
        named = encode.feature_index_map(spark, encoder).collect()
        names = {r.feature_index: r.feature for r in named}
        frame = encoder.transform(derived)
    else:
        names = dict(enumerate(numeric))
        frame = encode.assemble(numeric).transform(derived)
    parts = train.mark_parts(frame.select("id", "city", "log_price", "features"))
    path = scratch_path(spark, "simple_frame")
    stored = train.store_layout(parts, path, [*CITY, "part"], derived.count())
    cities = [r.city for r in stored.select("city").distinct().orderBy("city").collect()]
    return train.train_by_group(stored, cities, {"model": estimator}, train.stored_split), names


def fit_elastic_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elastic net on one feature, whose solution is a closed form."""
    with storage(spark):
        results, _ = simple_fits(
            spark, sf_dir, train.linear_regression(), ["number_of_reviews"], []
        )
    fitted = [
        (r.city, float(r.model.coefficients[0]), float(r.model.intercept), r.rmse, r.mae, r.r2)
        for r in results
    ]
    names = ("coefficient", "intercept", "rmse", "mae", "r2")
    schema = "city string, " + ", ".join(f"{n} double" for n in names)
    return round_columns(spark.createDataFrame(fitted, schema), 5, *names)


def tree_fits(spark: SparkSession, sf_dir: str, estimator: Estimator) -> DataFrame:
    """Test metrics of a tree model on the room types, and the features it split on."""
    with storage(spark):
        results, names = simple_fits(spark, sf_dir, estimator, [], ["room_type"])
    fitted = [
        (r.city, names[i], score, r.rmse, r.mae, r.r2)
        for r in results
        for i, score in enumerate(r.importances)
        if score > 0
    ]
    schema = "city string, feature string, importance double, rmse double, mae double, r2 double"
    return round_columns(
        spark.createDataFrame(fitted, schema), 5, "importance", "rmse", "mae", "r2"
    )


def fit_one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one tree with one split, on all rows and features."""
    single = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
    return tree_fits(spark, sf_dir, train.random_forest(**single))


def fit_two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of boosting with one split each, on all rows."""
    rounds = {"maxIter": 2, "maxDepth": 1, "stepSize": 0.1, "subsamplingRate": 1.0}
    return tree_fits(spark, sf_dir, train.gradient_boosting(**rounds))


def grouped_label(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test examples of the grouped fit."""
    derived = stored_features(spark, sf_dir)
    return train.hash_split(derived.select("id", "city", "room_type", "number_of_reviews", "log_price"))


def fit_linear_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An elastic net per city and room type, all fitted in one job, with its test metrics."""
    by, features = ["city", "room_type"], ["number_of_reviews"]
    in_train, in_test = grouped_label(spark, sf_dir)
    models = stage_table(linear.fit_linear_by(in_train, features, by), "grouped_models")
    scores = evaluate(linear.predict_by(in_test, models, features, by), by)
    named = models.select(*by, F.get("coefficients", F.lit(0)).alias("coefficient"), "intercept", "n_train")
    joined = join_on(named, scores.drop("n_unscored"), by)
    return round_columns(joined, 5, "coefficient", "intercept", "rmse", "mae", "r2")


def training_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and importances as files, named from files alone, as a later session would."""
    with storage(spark) as own:
        derived = stored_features(spark, sf_dir)
        encoder = encode.fit_encoder(derived, [], ["room_type"])
        frame = encoder.transform(derived).select("id", "city", "log_price", "features")
        folder = own.path("training")
        single = {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
        jobs.store_frame(spark, frame, encoder, f"{folder}/frame", derived.count())
        jobs.train_models(
            spark, f"{folder}/frame", None, f"{folder}/metrics", f"{folder}/importance",
            {"RandomForest": train.random_forest(**single)},
        )
        run = jobs.read_run(spark, f"{folder}/metrics", f"{folder}/importance", f"{folder}/frame")
        scored = run["importance"].filter("importance > 0").select("city", "model", "feature", "importance")
        joined = scored.join(run["metrics"].select("city", "model", "rmse", "mae", "r2", "n_test", "status"), ["city", "model"])
        return own.result(round_columns(joined, 5, "importance", "rmse", "mae", "r2"), "training_reports")


def mean_predictions(spark: SparkSession, sf_dir: str, predictors: dict[str, list[str]]) -> DataFrame:
    """Test rows scored by train means: ``city, model, log_price, prediction``.

    All predictors come from one small table of sums per city, room type and
    neighbourhood group.
    """
    levels = list(constants.CATEGORICAL_FEATURES)
    listings = bindings.listings(spark, sf_dir, ["id", "city", "price", *levels])
    logged = listings.withColumn("log_price", log_target(F.col("price"))).drop("price")
    in_train, in_test = train.stored_split(
        stage_table(train.mark_parts(logged), "split_listings", ["part"])
    )
    sums = small_side(
        in_train.groupBy("city", *levels).agg(
            F.sum("log_price").alias("total"), F.count("*").alias("n")
        )
    )
    scored = in_test
    for name, keys in predictors.items():
        means = sums.groupBy(*keys).agg((F.sum("total") / F.sum("n")).alias(name))
        scored = join_on(scored, small_side(means), keys, "left")
    return scored.unpivot(["city", "log_price"], list(predictors), "model", "prediction")


def evaluate_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = mean_predictions(spark, sf_dir, {"RoomTypeMean": ["city", "room_type"]})
    return round_columns(evaluate(scored, ["city", "model"]), 4, "rmse", "mae", "r2")


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = mean_predictions(
        spark,
        sf_dir,
        {
            "CityMean": ["city"],
            "RoomTypeMean": ["city", "room_type"],
            "NeighbourhoodMean": ["city", "neighbourhood_group"],
        },
    )
    best = report.best_model(evaluate(scored, ["city", "model"]))
    return round_columns(best, 4, "rmse", "mae", "r2")


# --- reports -----------------------------------------------------------------


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(stored_clean(spark, sf_dir, MODEL_COLUMNS))


def feature_scores(derived: DataFrame) -> DataFrame:
    """A deterministic importance table: squared correlation with the label, as shares."""
    names = list(constants.NUMERIC_FEATURES)
    matrix = profile.correlation(derived, names, CITY, against=["log_price"])
    position = F.array_position(F.array(*[F.lit(c) for c in names]), F.col("a")) - 1
    share = F.col("r") * F.col("r")
    return matrix.select(
        "city",
        F.lit("SquaredCorrelation").alias("model"),
        position.cast("int").alias("feature_index"),
        (share / F.sum(share).over(Window.partitionBy("city"))).alias("importance"),
    )


def named_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = stored_features(spark, sf_dir)
    encoder = encode.fit_encoder(derived, *feature_columns(derived))
    index_map = encode.feature_index_map(spark, encoder)
    return round_columns(
        report.name_features(feature_scores(derived), index_map), 6, "importance"
    )


def rank_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = report.rank_importance(feature_scores(stored_features(spark, sf_dir)))
    return round_columns(ranked, 6, "importance")


def importance_of_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importances of one city and model, highest first."""
    scores = feature_scores(stored_features(spark, sf_dir))
    one = rows.only(scores, city="LA", model="SquaredCorrelation")
    return round_columns(report.rank_importance(one), 6, "importance")


def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = report.top_features(feature_scores(stored_features(spark, sf_dir)))
    return round_columns(top, 6, "importance")


def compare_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = feature_scores(stored_features(spark, sf_dir))
    return round_columns(report.compare_drivers(scores, "LA", "NY"), 6, "LA", "NY", "difference")


QUERIES: dict[str, Query] = {
    "row_counts": row_counts,
    "preview": preview,
    "clean_listings": cleaned,
    "csv_listings": csv_listings,
    "model_frame_table": model_frame_table,
    "report_csv": report_csv,
    "keep_numeric_ids": keep_numeric_ids,
    "require_price": require_price,
    "positive_price": positive_price,
    "price_cap": price_cap,
    "drop_incomplete": drop_incomplete,
    "fill_defaults": fill_defaults,
    "clean_currency": currency,
    "safe_double": doubles,
    "safe_date": dates,
    "log_price": log_price,
    "dist_to_center": dist_to_center,
    "null_counts": null_counts,
    "describe_by_city": describe_by_city,
    "describe_text_by_city": describe_text_by_city,
    "quartiles_by_city": quartiles_by_city,
    "price_tail": price_tail,
    "price_range_capped": price_range_capped,
    "price_histogram": price_histogram,
    "log_price_histogram": log_price_histogram,
    "geo_price_grid": geo_price_grid,
    "geo_points": geo_points,
    "nights_points": nights_points,
    "nights_vs_log_price": nights_vs_log_price,
    "scatter_sample": scatter_sample,
    "scatter_points": scatter_points,
    "price_correlation": price_correlation,
    "union_cities": union_cities,
    "split_by_key": split_by_key,
    "train_test_split": train_test_split,
    "category_index": category_index,
    "one_hot_long": one_hot_long,
    "model_frame": model_frame,
    "model_frame_long": model_frame_long,
    "feature_index_map": feature_index_map,
    "fit_linear": fit_linear,
    "fit_forest": fit_forest,
    "fit_boosted": fit_boosted,
    "fit_elastic_one": fit_elastic_one,
    "fit_one_split": fit_one_split,
    "fit_two_rounds": fit_two_rounds,
    "fit_linear_groups": fit_linear_groups,
    "training_reports": training_reports,
    "evaluate_regression": evaluate_regression,
    "best_model": best_model,
    "named_importance": named_importance,
    "rank_importance": rank_importance,
    "importance_of_pair": importance_of_pair,
    "top_features": top_features,
    "compare_drivers": compare_drivers,
}
