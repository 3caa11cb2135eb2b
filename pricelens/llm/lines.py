"""Drops lines that many documents share, by a sharded minimal perfect hash.

Each task counts the distinct lines of its documents by a 128-bit hash; the counts are
summed with partial sums. Lines of at least two documents get a place in a minimal
perfect hash, built a shard to a task, over which lie two arrays: a 64-bit fingerprint
and the number of documents, as narrow as the shard's largest count. Documents never
meet the lines in a join: a task maps the shards it needs and probes the places of its
own lines. A line of one document only has no slot; it lands on a foreign slot or none,
and the fingerprint tells (a false match needs 64 equal bits). The index thus grows with
the lines that repeat and not with all text, and nothing of it is sent to the driver
but a file name a shard.

A line's key is the line without white space at its ends, A-Z lower-cased.

Defined cases: a NULL or empty text is one empty line; a NULL text stays NULL. Keys
shorter than ``min_chars`` code points are always kept. A line that repeats within one
document counts once there; repeated rows are documents of their own. NULL ids are
kept. A document that loses all lines has an empty text. Other columns pass through
whatever their names are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.mph import Arrays, Index, build_shards, shard_count
from pricelens.session import stage_table

MIN_DOCS = 10
MIN_CHARS = 1
FLUSH_KEYS = 200_000
SLOTS = {"prints": np.dtype("<u8"), "counts": np.dtype("<i8")}


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """Hash of each line's key; None where the key is too short to be dropped."""
    found: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip().lower()
        long_enough = len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)
        found.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return found


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def line_counts(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, n``: documents that hold each line."""

    def flush(counts: Counter) -> pa.RecordBatch:
        high, low = halves(list(counts))
        return pa.RecordBatch.from_arrays(
            [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(list(counts.values()), pa.int64())],
            ["h1", "h2", "n"],
        )

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update({k for k in line_keys(text.as_py() or b"", min_chars) if k})
                if len(counts) >= FLUSH_KEYS:
                    yield flush(counts)
                    counts = Counter()
        if counts:
            yield flush(counts)

    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    partial = texts.mapInArrow(count, "h1 long, h2 long, n long")
    return partial.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def slot_arrays(hashed: Arrays, columns: Arrays) -> Arrays:
    """Fingerprints and counts by place."""
    prints, counts = np.zeros(len(hashed["at"]), "<u8"), np.zeros(len(hashed["at"]), np.int64)
    prints[hashed["at"]] = columns["h2"].view(np.uint64)
    counts[hashed["at"]] = columns["n"]
    return {"prints": prints, "counts": counts.astype(np.min_scalar_type(int(counts.max())))}


def line_index(docs: DataFrame, least: int, text_col: str = "text", min_chars: int = MIN_CHARS) -> Index:
    """Index of the lines that ``least`` or more documents hold."""
    counts = stage_table(line_counts(docs, text_col, min_chars).filter(F.col("n") >= least), "line_counts")
    return build_shards(counts, shard_count(counts.count()), slot_arrays, "lines")


def probe_lines(docs: DataFrame, index: Index, min_docs: int, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (the document), ``n_lines``, ``n_dropped`` and ``kept`` (its text without the dropped lines)."""

    def sift(text: bytes, drop: np.ndarray) -> bytes:
        return b"\n".join([line for line, gone in zip(text.split(b"\n"), drop.tolist(), strict=True) if not gone])

    def probe(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = [line_keys(t or b"", min_chars) for t in texts]
            sizes = [len(k) for k in keys]
            flat = [k for line in keys for k in line]
            real = np.array([k is not None for k in flat], bool)
            drop = np.zeros(len(flat), bool)
            high, low = halves([k for k in flat if k is not None])
            member, found = index.probe(high, low, SLOTS)
            drop[real] = member & (found["prints"] == low) & (found["counts"] >= min_docs)
            dropped = np.split(drop, np.cumsum(sizes)[:-1])
            kept = [sift(t, d) if t and d.any() else t for t, d in zip(texts, dropped, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array([int(d.sum()) for d in dropped], pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "n_lines", "n_dropped", "kept"],
            )

    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]) if len(docs.columns) > 1 else F.lit(True)
    rows = docs.select(others.alias("row"), F.col(text_col).cast("binary").alias("text"))
    out = T.StructType([rows.schema["row"]]).add("n_lines", "long").add("n_dropped", "long").add("kept", "string")
    return rows.mapInArrow(probe, out)


def _probed(docs: DataFrame, min_docs: int, text_col: str, min_chars: int) -> DataFrame:
    # A line of one document alone is never dropped, unless one document is enough.
    index = line_index(docs, min(2, min_docs), text_col, min_chars)
    return probe_lines(docs, index, min_docs, text_col, min_chars)


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, text_col: str = "text") -> DataFrame:
    """The documents without the lines that ``min_docs`` or more of them share."""
    probed = _probed(docs, min_docs, text_col, min_chars)
    return probed.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: lines, dropped lines, and a digest of what is left."""
    probed = _probed(docs.select("doc_id", "text"), min_docs, "text", min_chars)
    kept = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    return probed.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", kept.alias("kept_sha256"))
