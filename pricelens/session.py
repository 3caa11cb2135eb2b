"""Session helpers: stored tables, checked small sides, NULL-safe joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.storage import owner, scratch_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder that goes with the ``storage`` block it is asked for in."""
    return owner(spark).path(name)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative learners checkpoint; give them a folder if none is configured."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))


def stage_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-run of
    everything upstream. The table goes with the ``storage`` block it is made in.
    """
    return owner(df.sparkSession).stage(df, name, partition_by)


def small_side(df: DataFrame) -> DataFrame:
    """Store a side that is expected to be small, so that its size in bytes is known.

    No hint: the engine broadcasts a stored table within its own byte threshold and
    shuffles a larger one. Either way the side is computed once.
    """
    return stage_table(df, "side")


def join_on(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in ``groupBy``."""
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_side_{k}")) for k in keys]
    )
    return df.join(renamed, condition, how).select(
        *df.columns, *[c for c in side.columns if c not in keys]
    )
