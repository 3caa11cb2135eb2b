"""Result tables of a few rows: metrics and importances."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_to_frame(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Result rows held by the driver (model summaries) as a frame."""
    return spark.createDataFrame(list(rows), schema)


def write_report(df: DataFrame, path: str) -> None:
    """A single CSV file. For report tables only: all rows pass one task."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
