"""Stored tables with an owner that deletes them.

A multi-pass operator writes what it reads more than once to the shared folder. Each
such table belongs to the innermost open ``storage`` block of its thread, and goes when
that block ends: by then every pass that reads it has been written out itself. What the
block hands on is stored by ``result`` for the block around it. Outside any block the
owner is the session's own storage, which goes with ``release`` or with the process.

``share`` keeps one table per key in the outermost block, so several jobs over one
source read the same stored rows instead of writing them again.
"""

from __future__ import annotations

import atexit
import logging
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Hashable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_local_scratch: str | None = None
_open = threading.local()
_sessions: dict[str, Storage] = {}
_lock = threading.RLock()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose driver runs the tasks itself falls back to a temporary
    folder; a cluster without the setting is an error.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="pricelens-")
    return _local_scratch


def _located(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if re.match(r"[a-z0-9]+:", uri) else f"file://{uri}")


def delete_folder(uri: str) -> None:
    """Delete a folder of the shared store; one that cannot be reached from here is left and told."""
    try:
        if is_there(uri):
            store, path = _located(uri)
            store.delete_dir(path)
    except Exception as error:
        log.warning("could not delete %s: %s", uri, error)


def is_there(uri: str) -> bool:
    store, path = _located(uri)
    return store.get_file_info(path).type.name == "Directory"


def _gone(uri: str) -> bool:
    """Whether a folder was deleted by someone else; what cannot be looked at counts as there."""
    try:
        return not is_there(uri)
    except Exception:
        return False


class Storage:
    """Folders written on behalf of one piece of work."""

    def __init__(self, spark: SparkSession, outer: Storage | None):
        self.spark, self.outer = spark, outer
        self.folders: list[str] = []
        self.shared: dict[Hashable, tuple[object, list[str]]] = {}
        self.lock = threading.RLock()

    def path(self, name: str) -> str:
        """A new folder of this owner."""
        found = f"{scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.folders.append(found)
        return found

    def stage(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = self.path(name)
        df.write.partitionBy(*partition_by).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """Store what outlives this block: its owner is the block around it."""
        return (self.outer or self).stage(df, name)

    def release(self) -> None:
        while self.folders:
            delete_folder(self.folders.pop())
        self.shared.clear()


def _session_storage(spark: SparkSession) -> Storage:
    """What belongs to the running application and to no block."""
    name = spark.sparkContext.applicationId
    with _lock:
        return _sessions.setdefault(name, Storage(spark, None))


def owner(spark: SparkSession) -> Storage:
    """The innermost block of this thread, or the session's storage."""
    blocks = getattr(_open, "blocks", None)
    return blocks[-1] if blocks else _session_storage(spark)


@contextmanager
def storage(spark: SparkSession) -> Iterator[Storage]:
    """A block that owns the tables stored inside it and deletes them at its end."""
    block = Storage(spark, owner(spark))
    _open.blocks = [*getattr(_open, "blocks", []), block]
    try:
        yield block
    finally:
        _open.blocks = [b for b in _open.blocks if b is not block]
        block.release()


def share[T](spark: SparkSession, key: Hashable, make: Callable[[Storage], T]) -> T:
    """What ``make`` returns, made once per key and outermost block, and again if its folders were deleted.

    ``make`` stores its tables with the storage it is given, which outlives the blocks
    inside. The key has to tell sources apart: their files, columns and settings.
    """
    home = owner(spark)
    while home.outer is not None and home.outer.outer is not None:
        home = home.outer
    with home.lock:
        if key not in home.shared or any(map(_gone, home.shared[key][1])):
            before = len(home.folders)
            value = make(home)
            home.shared[key] = value, home.folders[before:]
        return home.shared[key][0]


def release(spark: SparkSession) -> None:
    """Delete what this application has stored outside any block."""
    _session_storage(spark).release()


@atexit.register
def _release_all() -> None:
    for found in list(_sessions.values()):
        found.release()
