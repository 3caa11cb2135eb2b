"""Whole stages over stored data: files in, files out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import constants
from pricelens.functions.measures import log_target
from pricelens.operators import encode, profile, report, rows, train
from pricelens.operators.columns import union_sources
from pricelens.operators.percentiles import percentile_name
from pricelens.plans.cleaning import clean_listings
from pricelens.plans.modelling import Centers, build_model_frame
from pricelens.schemas import FEATURE_INDEX, IMPORTANCE, METRICS, MODEL_FRAME, STORED_FRAME
from pricelens.sources.frames import read_table, write_table
from pricelens.sources.listings import read_listings, write_csv
from pricelens.sources.reports import read_report, write_report
from pricelens.storage import storage


def clean_files(
    spark: SparkSession, source: str, target: str, multiline: bool = False, csv: bool = False
) -> None:
    """One city's raw CSV to clean listings: Parquet, which keeps the types, or CSV."""
    cleaned = clean_listings(read_listings(spark, source, multiline))
    if csv:
        write_csv(cleaned, target, multiline)
    else:
        write_table(cleaned, target, partition_by=None)


def profile_files(
    spark: SparkSession, sources: Mapping[str, str], target: str | None = None
) -> dict[str, DataFrame]:
    """The profile tables of clean listings, all cities side by side.

    With ``target``, each table is stored in a folder of its name there and read back.
    """
    listings = union_sources({city: read_table(spark, path) for city, path in sources.items()})
    by = ["city"]
    numeric = [c for c in constants.DOUBLE_COLUMNS if c in listings.columns]
    correlated = [c for c in constants.CORRELATION_COLUMNS if c in listings.columns]
    priced = F.when(F.col("price") > 0, F.col("price"))
    logged = listings.withColumn("log_price", log_target(priced))
    capped = rows.cap_range(listings, "price", *constants.PRICE_CAP)
    texts = [c for c, kind in listings.dtypes if kind in ("string", "date") and c not in by]
    marks = sorted({*constants.QUARTILE_PERCENTAGES, *constants.TAIL_PERCENTAGES, 1.0})

    def columns(names: Sequence[float]) -> list[str]:
        return [percentile_name(p) for p in names]

    with storage(spark) as own:
        # One pass each: row statistics, percentiles of every column, both histograms.
        counted = own.stage(profile.summaries(listings, numeric, [c for c in listings.columns if c not in by], "price", constants.PRICE_CAP, by), "summaries")
        cuts = own.stage(profile.quartiles(listings, numeric, marks, by), "percentiles")
        bins = own.stage(profile.histogram(logged, ["price", "log_price"], constants.HISTOGRAM_BINS, by), "bins")
        tail = cuts.filter(F.col("column") == "price")
        tables = {
            "null_counts": counted.select(*by, "nulls.*"),
            "describe": counted.select(*by, F.inline("described")),
            "quartiles": cuts.select(*by, "column", "n", *columns(constants.QUARTILE_PERCENTAGES)),
            "price_tail": tail.select(*by, F.col(percentile_name(1.0)).alias("max"), *columns(constants.TAIL_PERCENTAGES)),
            "price_histogram": bins.filter(F.col("column") == "price"),
            "log_price_histogram": bins.filter(F.col("column") == "log_price"),
            "price_range_capped": counted.filter("capped.n > 0").select(*by, "capped.*"),
            "geo_price_grid": profile.geo_grid(capped, "latitude", "longitude", "price", 0.01, 0.01, by),
            "nights_vs_log_price": profile.binned_pair(logged, "minimum_nights", "log_price", by),
            "describe_text": profile.describe_text_by(
                listings.withColumns({c: F.col(c).cast("string") for c in texts}), texts, by
            ),
            "correlation": profile.correlation(listings, correlated, by),
        }
        if target is None:
            return {name: own.result(table, name) for name, table in tables.items()}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{target}/{name}")
    return {name: spark.read.parquet(f"{target}/{name}") for name in tables}


def report_files(
    spark: SparkSession,
    importance_path: str,
    frame_path: str,
    target: str,
    pair: tuple[str, str] = ("LA", "NY"),
    top: int = 5,
    chart: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Named, ranked, top and compared importances of a training run, stored as reports.

    Names come from the index map stored beside the frame the run was trained on.
    ``chart`` is a (city, model) whose ranked importances become a table of their own.
    """
    importance = read_report(spark, importance_path, IMPORTANCE)
    tables = {
        "named": report.name_features(importance, read_index_map(spark, frame_path)),
        "ranked": report.rank_importance(importance),
        "top": report.top_features(importance, top),
        "compared": report.compare_drivers(importance, *pair),
    }
    if chart is not None:
        tables["chart"] = report.rank_importance(rows.only(importance, city=chart[0], model=chart[1]))
    with storage(spark):
        for name, table in tables.items():
            write_report(table, f"{target}/{name}")
    return {name: spark.read.schema(table.schema).option("header", True).csv(f"{target}/{name}") for name, table in tables.items()}


def index_map_path(frame_path: str) -> str:
    return f"{frame_path}-index"


def read_index_map(spark: SparkSession, frame_path: str) -> DataFrame:
    """Feature names of a stored model frame."""
    return read_report(spark, index_map_path(frame_path), FEATURE_INDEX)


def store_frame(spark: SparkSession, frame: DataFrame, encoder: PipelineModel, target: str, listings: int) -> DataFrame:
    """Store a model frame, split and laid out, with its index map beside it; returns the map.

    ``listings`` is about how many rows it has, for the number of files.
    """
    index_map = encode.feature_index_map(spark, encoder)
    marked = train.mark_parts(frame.select(*MODEL_FRAME.fieldNames()))
    train.store_layout(marked, target, ["city", "part"], listings)
    write_report(index_map, index_map_path(target))
    return index_map


def build_features(
    spark: SparkSession,
    sources: Mapping[str, str],
    target: str,
    encoder_path: str,
    centers: Centers = constants.CITY_CENTERS,
) -> DataFrame:
    """Clean listings per city to a stored model frame, its index map and its encoder; returns the map."""
    listings = union_sources({city: read_table(spark, path) for city, path in sources.items()})
    frame, encoder = build_model_frame(listings, centers)
    encode.save_encoder(encoder, encoder_path)
    return store_frame(spark, frame, encoder, target, listings.count())


def train_models(
    spark: SparkSession,
    frame_path: str,
    cities: Sequence[str] | None,
    metrics_path: str,
    importance_path: str,
    models: dict[str, Estimator] | None = None,
    parallelism: int = 4,
) -> list[train.Trained]:
    """Train every model for every city (all of the frame, if None) and write the two reports."""
    frame = train.read_layout(spark, frame_path, STORED_FRAME)
    if cities is None:
        cities = [r.city for r in frame.select("city").distinct().orderBy("city").collect()]
    results = train.train_by_group(frame, cities, models, train.stored_split, parallelism)
    write_report(train.metrics_frame(spark, results), metrics_path)
    write_report(train.importance_frame(spark, results), importance_path)
    return results


def read_run(spark: SparkSession, metrics_path: str, importance_path: str, frame_path: str) -> dict[str, DataFrame]:
    """The two tables of a training run from their files, importances with feature names."""
    importance = read_report(spark, importance_path, IMPORTANCE)
    return {
        "metrics": read_report(spark, metrics_path, METRICS),
        "importance": report.name_features(importance, read_index_map(spark, frame_path)),
    }
