"""Star-schema tables seen as listings.

An order becomes a listing: its customer is the host, its lines give price and
review counts, and the customer's nation decides the city.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import constants

LISTING_COLUMNS = (
    "id",
    "host_id",
    "host_name",
    "name",
    "city",
    "price",
    "latitude",
    "longitude",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "availability_365",
    "calculated_host_listings_count",
    "number_of_reviews_ltm",
    "last_review",
    "room_type",
    "neighbourhood_group",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(
    spark: SparkSession, sf_dir: str, columns: Collection[str] = LISTING_COLUMNS
) -> DataFrame:
    """Typed listings with the given columns.

    Order lines are summed per order before the join, so only one narrow row per
    order and task is shuffled. Customers are joined first; a customer with very
    many orders is split by the engine's adaptive skew join. The last shuffle is
    then on the unique order key and leaves the rows evenly spread. Join types are
    the engine's choice by measured sizes. The orders-per-host count costs a
    shuffle of its own and is planned only where it is asked for.
    """
    orders = table(spark, sf_dir, "orders")
    hosts = table(spark, sf_dir, "customer")
    if "calculated_host_listings_count" in columns:
        per_host = orders.groupBy(F.col("o_custkey").alias("hk")).agg(
            F.count("*").alias("n_orders")
        )
        hosts = hosts.join(per_host, F.col("c_custkey") == F.col("hk"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
            F.max("l_linenumber").alias("mx"),
            F.round(F.sum("l_extendedprice"), 2).alias("price"),
        )
    )
    hosted = orders.join(hosts, F.col("o_custkey") == F.col("c_custkey"))
    joined = hosted.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(*[_column(c).alias(c) for c in LISTING_COLUMNS if c in columns])


def _column(name: str) -> Column:
    in_la = F.col("c_nationkey") % 2 == 0
    (la_lat, la_lon), (ny_lat, ny_lon) = (constants.CITY_CENTERS[c] for c in ("LA", "NY"))
    expressions = {
        "id": lambda: F.col("o_orderkey"),
        "host_id": lambda: F.col("o_custkey"),
        "host_name": lambda: F.col("c_name"),
        "name": lambda: F.concat_ws(", ", "c_mktsegment", "o_orderstatus"),
        "city": lambda: F.when(in_la, "LA").otherwise("NY"),
        "price": lambda: F.col("price"),
        "latitude": lambda: F.when(in_la, la_lat).otherwise(ny_lat) + F.col("c_acctbal") / 10000.0,
        "longitude": lambda: F.when(in_la, la_lon).otherwise(ny_lon)
        + (F.col("o_custkey") % 1000) / 10000.0,
        "minimum_nights": lambda: F.col("n_lines").cast("double"),
        "number_of_reviews": lambda: F.col("qty"),
        "reviews_per_month": lambda: F.col("qty") / F.col("n_lines"),
        "availability_365": lambda: F.dayofyear("o_orderdate").cast("double"),
        "calculated_host_listings_count": lambda: F.col("n_orders").cast("double"),
        "number_of_reviews_ltm": lambda: F.col("mx").cast("double"),
        "last_review": lambda: F.to_date("o_orderdate"),
        "room_type": lambda: F.col("o_orderpriority"),
        "neighbourhood_group": lambda: F.col("c_mktsegment"),
    }
    return expressions[name]()


def raw_listings(
    spark: SparkSession, sf_dir: str, columns: Collection[str] = LISTING_COLUMNS
) -> DataFrame:
    """The same listings as a dirty file would hold them: text, with faults.

    Every row is kept. The day of the month of the listing's date decides which
    fault, if any, it carries.
    """
    needed = {*columns, "last_review"}
    typed = listings(spark, sf_dir, needed)
    day = F.dayofmonth("last_review")
    null = F.lit(None).cast("string")

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    faults = {
        "id": lambda: F.when(day == 1, F.concat(F.lit("x"), text("id")))
        .when(day == 2, null)
        .when(day == 3, "")
        .otherwise(text("id")),
        "price": lambda: F.when(day == 4, "Private room")
        .when(day == 5, null)
        .when(day == 6, F.concat(F.lit("-"), text("price")))
        .when(day == 7, "0")
        .otherwise(F.concat(F.lit("$"), F.format_number(F.floor("price"), 0))),
        "latitude": lambda: F.when(day == 8, "n/a").otherwise(text("latitude")),
        "minimum_nights": lambda: F.when(day == 9, "Infinity").otherwise(text("minimum_nights")),
        "reviews_per_month": lambda: F.when(day == 10, null).otherwise(text("reviews_per_month")),
        "number_of_reviews_ltm": lambda: F.when(day == 11, "NaN").otherwise(
            text("number_of_reviews_ltm")
        ),
        "last_review": lambda: F.when(day == 12, "01/05/2024")
        .when(day == 13, "2024-02-30")
        .otherwise(text("last_review")),
        "room_type": lambda: F.when(day == 14, null).otherwise(F.col("room_type")),
    }
    return typed.select(
        *[
            (faults[c]() if c in faults else text(c)).alias(c)
            for c in LISTING_COLUMNS
            if c in columns
        ]
    )
