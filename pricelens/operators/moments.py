"""Counts, means and co-moments of numeric columns per group, merged pairwise.

For every pair of columns the moments cover the rows that have both. A task reduces each
Arrow batch to one row per group, with matrix products; partial rows are merged by the
pairwise update for means and centred sums, which does not lose digits to large means.
Merging has two levels, tasks to slices and slices to the group, so a group's last task
sees ``SLICES`` rows however many tasks met the group. What follows from a group's moments
(correlations, a regression) is worked out in that task, for all groups in one job.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = 64

# Sent to the executors by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Moments:
    """Square arrays by column pair (i, j): rows with both, mean of i there, centred sum of products.

    ``squares`` has the centred sum of squares of i over those rows.
    """

    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Moments:
        """Moments of the rows of a matrix; NaN is missing."""
        has = ~np.isnan(values)
        m = has.astype(float)
        # Centred first, so that what is subtracted below is small: at a value of each column,
        # which makes a constant column exactly zero, then at the mean.
        some = values[has.argmax(axis=0), np.arange(values.shape[1])]
        centre = np.where(has.any(axis=0), some, 0)
        z = np.where(has, values - centre, 0)
        shift = z.sum(axis=0) / np.maximum(has.sum(axis=0), 1)
        z, centre = np.where(has, z - shift, 0), centre + shift
        n = m.T @ m
        share = 1 / np.maximum(n, 1)
        sums = z.T @ m
        mean = sums * share
        return cls(
            n,
            np.where(n > 0, mean + centre[:, None], 0),
            np.maximum((z * z).T @ m - sums * mean, 0),
            z.T @ z - sums * mean.T,
        )

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0)
        weight = self.n * other.n / np.maximum(n, 1)
        mean = (self.mean * self.n + other.mean * other.n) / np.maximum(n, 1)
        near = np.where(self.n > 0, self.mean + apart * (other.n / np.maximum(n, 1)), mean)
        return Moments(
            n, near, self.squares + other.squares + apart**2 * weight, self.products + other.products + apart * apart.T * weight
        )

    def packed(self) -> bytes:
        return np.concatenate([x.ravel() for x in (self.n, self.mean, self.squares, self.products)]).astype("<f8").tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Moments:
        flat = np.frombuffer(data, "<f8")
        width = round((len(flat) / 4) ** 0.5)
        return cls(*(x.reshape(width, width).copy() for x in np.split(flat, 4)))


def _groups(batch: pa.RecordBatch, by: Sequence[str]) -> list[np.ndarray]:
    """Row numbers of each group of a batch; NULL is a key like others."""
    code = np.zeros(batch.num_rows, np.int64)
    for c in by:
        encoded = pc.dictionary_encode(batch.column(c), null_encoding="encode")
        code = np.unique(code * (len(encoded.dictionary) + 1) + encoded.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(code[order])) + 1) if len(order) else []


def grouped_moments(
    df: DataFrame,
    columns: Sequence[Column],
    by: Sequence[str],
    finish: Callable[[Moments], dict[str, list]],
    out: T.StructType,
    slices: int = SLICES,
) -> DataFrame:
    """``by`` and the columns ``out`` that ``finish`` gives for a group's moments, one or several rows.

    NaN and NULL are missing values. Groups may be many: a task holds one at a time.
    """
    names = [f"_v{i}" for i in range(len(columns))]
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], *[c.cast("double").alias(n) for c, n in zip(columns, names, strict=True)])
    key_fields = [rows.schema[k] for k in keys]
    partial = T.StructType(list(key_fields)).add("_slice", T.IntegerType()).add("_moments", "binary")

    def reduce_batches(batches):
        part = TaskContext.get().partitionId() % slices
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names])
            found = _groups(batch, keys)
            first = pa.array([g[0] for g in found], pa.int64())
            packed = [Moments.of(values[g]).packed() for g in found]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(first) for k in keys], pa.array([part] * len(found), pa.int32()), pa.array(packed, pa.binary())],
                [*keys, "_slice", "_moments"],
            )

    def total(table):
        first, *rest = (Moments.unpacked(x.as_py()) for x in table.column("_moments"))
        for other in rest:
            first = first.merged(other)
        return first

    def merge(table: pa.Table) -> pa.Table:
        heads = [table.column(c).slice(0, 1) for c in [*keys, "_slice"]]
        return pa.table([*heads, pa.array([total(table).packed()], pa.binary())], names=[*keys, "_slice", "_moments"])

    def close(table: pa.Table) -> pa.Table:
        found = finish(total(table))
        size = len(next(iter(found.values())))
        repeated = [table.column(k).slice(0, 1).take(pa.array([0] * size, pa.int64())) for k in keys]
        return pa.table([*repeated, *found.values()], names=[*keys, *found])

    sliced = rows.mapInArrow(reduce_batches, partial).groupBy(*keys, "_slice").applyInArrow(merge, partial)
    closed = sliced.groupBy(*keys).applyInArrow(close, T.StructType([*key_fields, *out.fields]))
    return closed.withColumnsRenamed(dict(zip(keys, by, strict=True)))
