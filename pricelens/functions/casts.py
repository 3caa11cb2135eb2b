"""Casts that turn unreadable text into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """NaN and the infinities become NULL (NaN sorts above infinity, so one test does)."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def nan_as_null(value: Column) -> Column:
    """NaN becomes NULL; refers to its input once, so an inlined input is not repeated."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def safe_double(text: Column, finite_only: bool = True) -> Column:
    value = text.try_cast("double")
    return finite(value) if finite_only else value


def clean_currency(text: Column, strip: str = "$,", finite_only: bool = True) -> Column:
    """Drop currency marks, then cast. ``strip=""`` is the bare cast."""
    bare = F.translate(text, strip, "") if strip else text
    return safe_double(bare, finite_only)


def safe_date(text: Column) -> Column:
    return text.try_cast("date")
