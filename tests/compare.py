"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def as_rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows as plain tuples, columns in name order, in a stable order."""

    def plain(x: object) -> object:
        if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return None
        return x.item() if hasattr(x, "item") else x

    names = sorted(frame.columns)
    rows = [tuple(plain(x) for x in row) for row in frame[names].itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((x is None, str(x)) for x in row))


KINDS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "bigint",
    "double": "double", "varchar": "string", "string": "string", "date": "date",
    "boolean": "boolean",
}


def spark_types(df) -> dict[str, str]:
    return {name: KINDS.get(kind, kind) for name, kind in df.dtypes}


def oracle_types(relation) -> dict[str, str]:
    return {
        name: KINDS.get(str(kind).lower(), str(kind).lower())
        for name, kind in zip(relation.columns, relation.types, strict=True)
    }


def difference(df, relation) -> str | None:
    """None if both hold the same columns, types and rows; else what differs."""
    if spark_types(df) != oracle_types(relation):
        return f"types differ: {spark_types(df)} / {oracle_types(relation)}"
    names = df.columns
    ours = as_rows(pd.DataFrame([tuple(r) for r in df.collect()], columns=names, dtype=object))
    theirs = as_rows(
        pd.DataFrame(relation.fetchall(), columns=relation.columns, dtype=object)
    )
    if ours == theirs:
        return None
    if len(ours) != len(theirs):
        return f"row counts differ: {len(ours)} / {len(theirs)}"
    pairs = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(pairs)} of {len(ours)} rows differ ({sorted(names)}), first: {pairs[0]}"
