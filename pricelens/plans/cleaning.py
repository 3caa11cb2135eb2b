"""Raw listing text -> clean, typed listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens import constants
from pricelens.functions.casts import clean_currency, safe_date, safe_double
from pricelens.operators.rows import fill_defaults, keep_numeric_ids, numeric_id, require_not_null


def type_listings(df: DataFrame, strip: str = "$,", finite_only: bool = True) -> DataFrame:
    """Numeric fields to double and the review date to date, in a single projection."""
    typed = {
        c: safe_double(F.col(c), finite_only) for c in constants.DOUBLE_COLUMNS if c in df.columns
    }
    if "price" in df.columns:
        typed["price"] = clean_currency(F.col("price"), strip, finite_only)
    if "last_review" in df.columns:
        typed["last_review"] = safe_date(F.col("last_review"))
    return df.withColumns(typed)


def clean_listings(
    df: DataFrame,
    strip: str = "$,",
    drop_columns: Sequence[str] = (),
    finite_only: bool = True,
) -> DataFrame:
    """Numeric ids only, typed fields, review gaps filled, price required.

    Every step is row-wise, so this runs map-side over any number of files and
    accepts a streaming frame as well.
    """
    typed = typed_listings(keep_numeric_ids(df), strip, finite_only)
    return require_not_null(typed, ["price"]).drop(*drop_columns)


def typed_listings(df: DataFrame, strip: str = "$,", finite_only: bool = True) -> DataFrame:
    """Every raw listing with typed fields and review gaps filled; none is dropped."""
    return fill_defaults(type_listings(df, strip, finite_only), constants.REVIEW_DEFAULTS)


def clean_row(typed: DataFrame) -> Column:
    """Whether a typed listing is one that ``clean_listings`` keeps."""
    return F.coalesce(numeric_id(typed["id"]) & typed["price"].isNotNull(), F.lit(False))
