"""Doubles as whole numbers that keep their order, in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the IEEE 754 double format.
MANTISSA_BITS = 52
LEAST_EXPONENT, GREATEST_EXPONENT = -1022, 1023


def power_of_two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def with_order_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the bits of a double as a signed number: ``a < b`` if and only if ``key(a) < key(b)``.

    Both zeros have key 0, and so has NULL; infinities have the keys next to the greatest
    doubles'. NaN has to be replaced before. Each step is a column of its own: steps are used
    more than once, and the engine does not repeat them then.
    """
    size, guess, exponent, scaled, digits, bits = (F.col(f"_{name}_{i}") for i in range(6))
    steps = {
        "0": F.when(F.abs(value) < float("inf"), F.abs(value)).otherwise(0.0),
        "1": F.floor(F.log2(size)),
    }
    # The logarithm may be one off beside a power of two.
    step = F.when(size < power_of_two(guess), -1).when(size >= power_of_two(guess) * 2, 1).otherwise(0)
    steps["2"] = F.least(F.greatest(guess + step, F.lit(LEAST_EXPONENT)), F.lit(GREATEST_EXPONENT))
    # Scaled by a power of two in two halves: exact, and never below the normal range on the way.
    half = F.floor(exponent / 2)
    steps["3"] = size / power_of_two(half) / power_of_two(exponent - half)
    steps["4"] = (F.when(scaled < 1, scaled).otherwise(scaled - 1) * float(1 << MANTISSA_BITS)).cast("long")
    biased = F.when(scaled < 1, 0).otherwise(exponent - LEAST_EXPONENT + 1).cast("long")
    finite = F.call_function("shiftleft", biased, F.lit(MANTISSA_BITS)) + digits
    steps["5"] = F.when(F.abs(value) == float("inf"), F.lit(2047 << MANTISSA_BITS)).when(size == 0, 0).otherwise(finite)
    found = df
    for i, expression in steps.items():
        found = found.withColumn(f"_{name}_{i}", expression)
    key = F.when(F.col(value) < 0, -bits).otherwise(bits)
    # Never NULL: a join on the key would else filter by all steps at once, below them.
    return found.withColumn(name, F.coalesce(key, F.lit(0))).drop(*[f"_{name}_{i}" for i in steps])
