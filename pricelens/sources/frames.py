"""Parquet tables between stages: clean listings and model frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pricelens.schemas import MODEL_FRAME


def write_table(df: DataFrame, path: str, partition_by: str | None = "city") -> None:
    """Typed columnar table; a folder per city makes a one-city read prune the rest."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_model_frame(df: DataFrame, path: str) -> None:
    write_table(df.select(*MODEL_FRAME.fieldNames()), path, "city")


def read_model_frame(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, MODEL_FRAME)
