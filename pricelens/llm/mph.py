"""Minimal perfect hashing of 128-bit keys, vectorised, in shards that tasks build alone.

A level is a bit array with a little more than one bit a key: keys that meet no other
key there are placed, the rest go to the next level under another hash. A key's place
is the number of bits set before its own over all levels, so n keys take the places
0 .. n-1 and nothing but about three bits a key is stored, with the counts of bits
before each word. A foreign key may get any key's place, or none: callers keep a
fingerprint or the key itself in a slot array beside the hash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.files import map_arrays, write_arrays
from pricelens.llm.hashing import mix
from pricelens.session import scratch_path, stage_table

SHARD_KEYS = 1 << 20
SPARE = 1.3
MAX_LEVELS = 200
STEP = np.uint64(0x9E3779B97F4A7C15)

Arrays = dict[str, np.ndarray]


def level_hash(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    seed = np.uint64((level + 1) * int(STEP) % (1 << 64))
    return mix(mix(high + seed) ^ (low * STEP + seed))


def build(high: np.ndarray, low: np.ndarray) -> Arrays:
    """Bit arrays for distinct keys given as two arrays of unsigned 64-bit halves."""
    ends, words = [], []
    for level in range(MAX_LEVELS):
        if len(high) == 0:
            break
        size = 64 * max(1, -(-int(len(high) * SPARE) // 64))
        at = (level_hash(high, low, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        ends.append(size // 64)
        left = ~alone[at]
        high, low = high[left], low[left]
    if len(high):
        raise ValueError("keys of a minimal perfect hash have to be distinct")
    bits = np.concatenate([*words, np.zeros(0, "<u8")])
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
    return {"words": bits, "before": before[:-1].astype("<u4"), "ends": np.cumsum(ends, dtype=np.int64)}


def places(hashed: Arrays, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Place of each key; -1 for a foreign key that meets no bit."""
    found = np.full(len(high), -1, np.int64)
    open_ = np.arange(len(high))
    start = 0
    for level, end in enumerate(hashed["ends"].tolist()):
        if len(open_) == 0:
            break
        at = (level_hash(high[open_], low[open_], level) % np.uint64(64 * (end - start))).astype(np.int64) + 64 * start
        word = hashed["words"][at >> 6]
        bit = np.uint64(1) << (at & 63).astype(np.uint64)
        hit = (word & bit) != 0
        inside = np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
        found[open_[hit]] = hashed["before"][at[hit] >> 6].astype(np.int64) + inside
        open_ = open_[~hit]
        start = end
    return found


def shard_count(keys: int, shard_keys: int = SHARD_KEYS) -> int:
    return max(1, -(-keys // shard_keys))


def shard_of(column: str, shards: int) -> Column:
    """Shard of a key by its signed first half; ``np.mod`` gives the same."""
    return F.pmod(F.col(column), F.lit(shards)).cast("int")


def build_shards(keys: DataFrame, shards: int, slots: Callable[[Arrays, Arrays], Arrays], name: str) -> Index:
    """One file per shard of a stored table ``h1, h2, ...``: the hash and its slot arrays.

    ``slots`` gets the hash and the shard's columns and returns arrays by place. A shard
    holds about ``SHARD_KEYS`` keys however large the table is, as keys are distinct and
    spread by their hash. The files are named in a committed table: what a lost task
    wrote stays unnamed.
    """
    folder = scratch_path(keys.sparkSession, name)

    def write(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_numpy() for c in table.column_names}
        high, low = columns["h1"].view(np.uint64), columns["h2"].view(np.uint64)
        hashed = build(high, low)
        file = write_arrays(folder, {**hashed, **slots({**hashed, "at": places(hashed, high, low)}, columns)})
        return pa.table({"shard": pa.array([int(columns["_shard"][0])], pa.int32()), "file": [file]})

    built = keys.withColumn("_shard", shard_of("h1", shards)).groupBy("_shard").applyInArrow(write, "shard int, file string")
    files = {r.shard: r.file for r in stage_table(built, f"{name}_files").collect()}
    return Index(folder, shards, files)


class Index:
    """Shards of a hash, mapped into memory by the tasks that probe them; one row a shard is on the driver."""

    def __init__(self, folder: str, shards: int, files: dict[int, str]):
        self.folder, self.shards, self.files = folder, shards, files
        self.open: dict[int, Arrays] = {}

    def __getstate__(self):
        return {**self.__dict__, "open": {}}

    def shard(self, number: int) -> Arrays | None:
        if number not in self.open:
            self.open[number] = map_arrays(self.folder, self.files[number]) if number in self.files else None
        return self.open[number]

    def probe(self, high: np.ndarray, low: np.ndarray, slots: dict[str, np.dtype]) -> tuple[np.ndarray, Arrays]:
        """Which keys have a place, and the slot values there (zero elsewhere)."""
        member = np.zeros(len(high), bool)
        values = {k: np.zeros(len(high), t) for k, t in slots.items()}
        shard = np.mod(high.view(np.int64), self.shards)
        order = np.argsort(shard, kind="stable")
        numbers, starts = np.unique(shard[order], return_index=True)
        for number, rows in zip(numbers.tolist(), np.split(order, starts[1:]), strict=True):
            arrays = self.shard(number)
            if arrays is None:
                continue
            at = places(arrays, high[rows], low[rows])
            rows, at = rows[at >= 0], at[at >= 0]
            member[rows] = True
            for k in slots:
                values[k][rows] = arrays[k][at]
        return member, values
