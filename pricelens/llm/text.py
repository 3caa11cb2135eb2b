"""Words of a text as column expressions and in plain Python."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Everything in ASCII that is neither a digit nor a letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; all other characters stay as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def alnum_words(text: Column) -> Column:
    """Maximal runs of digits, letters and characters beyond ASCII; NULL has none."""
    pieces = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(pieces, "")


def text_key(text: Column) -> list[Column]:
    """128 bits that tell texts apart; NULL counts as the empty text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, a 64-bit key ``_k`` of the text, and its bytes ``_text``; NULL counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_k"), text.cast("binary").alias("_text"))


def literal_rows(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few fixed rows as a table made of literals."""

    def cell(value):
        if isinstance(value, (list, tuple)):
            return F.array(*[F.lit(x) for x in value])
        return F.lit(value)

    structs = [F.struct(*[cell(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
