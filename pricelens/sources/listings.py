"""Listing files: CSV with a header row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_listings(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = False,
    infer: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Read listing CSV; every column is a string unless asked otherwise.

    By default only the header line is looked at, so no pass over the data is
    spent on types. ``multiline=True`` accepts line breaks and doubled quotes
    inside quoted fields; such files cannot be split, so keep them moderate.
    A given ``schema`` is checked against the header.
    """
    reader = spark.read.option("header", True)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(
    df: DataFrame, path: str, multiline: bool = False, partition_by: Sequence[str] = ()
) -> None:
    """CSV files, one per partition, quoted for ``read_listings`` with the same flag.

    ``partition_by`` writes a folder per value (``city=LA``) in the same pass.
    NULL and the empty string both read back as NULL.
    """
    writer = df.write.mode("overwrite").option("header", True).partitionBy(*partition_by)
    if multiline:
        writer = writer.option("escape", '"')
    writer.csv(path)
