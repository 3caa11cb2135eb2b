"""Row-wise measures used as label, feature or sampling key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_target(price: Column) -> Column:
    return F.log1p(price)


def distance_to_center(
    latitude: Column,
    longitude: Column,
    city: Column,
    centers: Mapping[str, tuple[float, float]],
    fallback: str | None = None,
) -> Column:
    """Planar distance, in degrees, from a point to the centre of its city.

    A city without a centre gives NULL, or the distance to the centre of
    ``fallback`` when one is named.
    """

    def planar(center: tuple[float, float]) -> Column:
        north = latitude - F.lit(center[0])
        east = longitude - F.lit(center[1])
        return F.sqrt(north * north + east * east)

    named = [(k, c) for k, c in centers.items() if k != fallback]
    distance = planar(centers[fallback]) if fallback is not None else F.lit(None).cast("double")
    for key, center in reversed(named):
        distance = F.when(city == key, planar(center)).otherwise(distance)
    return distance


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """A bucket in ``0 .. buckets-1`` that depends on key and seed only.

    Unlike a seeded random number it does not depend on how rows are laid out
    over partitions, so a recomputed partition makes the same choice again.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
