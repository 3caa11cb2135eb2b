"""Declared schemas of the tables that cross a module or storage boundary."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MODEL_FRAME = StructType(
    [
        StructField("id", StringType()),
        StructField("log_price", DoubleType()),
        StructField("features", VectorUDT()),
        StructField("city", StringType()),
    ]
)

# A stored model frame: a folder per city and part.
STORED_FRAME = StructType([*MODEL_FRAME.fields, StructField("part", StringType())])

METRICS = StructType(
    [
        StructField("city", StringType()),
        StructField("model", StringType()),
        StructField("rmse", DoubleType()),
        StructField("mae", DoubleType()),
        StructField("r2", DoubleType()),
        StructField("n_test", LongType()),
        StructField("status", StringType()),
    ]
)

IMPORTANCE = StructType(
    [
        StructField("city", StringType()),
        StructField("model", StringType()),
        StructField("feature_index", IntegerType()),
        StructField("importance", DoubleType()),
    ]
)

FEATURE_INDEX = StructType(
    [
        StructField("feature_index", IntegerType()),
        StructField("feature", StringType()),
        StructField("source", StringType()),
        StructField("level", StringType()),
    ]
)
