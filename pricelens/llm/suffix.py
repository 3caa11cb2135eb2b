"""Suffix-array dedup: every byte under a repeated string of ``WIDTH`` bytes goes.

Shards. Each string of ``WIDTH`` bytes holds an anchor, the least-hashed run of
``ANCHOR`` bytes in it, which depends on the string's bytes alone: equal strings
have equal anchors at equal places. Anchors are counted with partial sums; those of
one place drop out. Around each place of the others, the text from which a repeated
string with this anchor could come (its context, under 400 bytes) goes to the shard
of the anchor. Equal contexts are one there.

Induction. A shard holds its contexts in memory. Equal ones, and those that are equal
once they are cut down to what they share, resolve each other; the suffixes of the
others are ordered, with common prefixes, by induced sorting over queues that spill to
disk (``induced``). Neighbours that share ``WIDTH`` bytes and stand at different places
mark repeated strings. One anchor's contexts are one shard, so an anchor that very many
texts share is one task's work and memory.

Equal texts are treated as one, and as wholly repeated if they have ``WIDTH`` bytes.
Texts are told apart by 64-bit hashes. Tables of marks are joined to the texts by their
stored size, as the engine sees it; the plan is the same at every size.

Defined cases: a NULL or empty text has no bytes and nothing removed. Rows that
agree in id and text are copies of each other. Overlapping repeats count. An empty
table gives an empty result. Only the named columns are used; ``remove_repeats``
passes the others through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.hashing import prefix_sums, run_hashes
from pricelens.llm.induced import sorted_suffixes
from pricelens.llm.text import text_rows
from pricelens.session import stage_table

WIDTH = 200
ANCHOR = 24
SHARD_BYTES = 4 << 20


# --- anchors -----------------------------------------------------------------


def anchors(text: bytes, width: int = WIDTH, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings of ``width`` bytes."""
    if len(text) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(len(data) - size + 1)
    hashes = run_hashes(prefix_sums(data), starts, starts + size)
    # the leftmost of the least, by the upper half of the hash
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    span = width - size + 1
    padded = np.full(-(-len(keys) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(data) - width + 1
    least = np.minimum(back[:n], ahead[span - 1 : span - 1 + n])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return at, hashes[at]


def anchor_rows(rows: DataFrame) -> DataFrame:
    """``h``, ``k``, ``at`` of every anchor; stored."""

    def find(batches):
        for batch in batches:
            keys = batch.column("_k").to_numpy(zero_copy_only=False)
            parts = [anchors(t) for t in batch.column("_text").to_pylist()]
            if parts:
                sizes = [len(at) for at, _ in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([h for _, h in parts]).view(np.int64)),
                        pa.array(np.repeat(keys, sizes)),
                        pa.array(np.concatenate([at for at, _ in parts]).astype(np.int32)),
                    ],
                    ["h", "k", "at"],
                )

    long_enough = rows.filter(F.octet_length("_text") >= WIDTH)
    return stage_table(long_enough.select("_k", "_text").mapInArrow(find, "h long, k long, at int"), "anchors")


# --- one shard ---------------------------------------------------------------


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans [start, end)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([new[1:], [True]])
    return list(zip(starts[new].tolist(), ends[last].tolist(), strict=True))


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def longest_shared(parts: list[bytes]) -> list[int]:
    """For each part the longest beginning that it shares with another one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best = [0] * len(parts)
    for i, j in zip(order, order[1:], strict=False):
        n = common_length(parts[i], parts[j])
        best[i], best[j] = max(best[i], n), max(best[j], n)
    return best


def repeated_spans(contexts: list[bytes], anchor: np.ndarray, text: np.ndarray, at: np.ndarray, width: int = WIDTH):
    """(text, start, end) arrays of repeated strings in one shard's contexts.

    Context i surrounds the anchor at ``at[i]`` of text ``text[i]``. A context is cut
    down to what it shares on either side with any other one of its anchor; cut
    contexts that are equal repeat each other as wholes. Only where some are left
    single are the suffixes sorted.
    """
    start = np.maximum(0, at - (width - ANCHOR))
    spans: list[tuple[int, int, int]] = []  # row, from, to within the context
    to_sort: list[tuple[bytes, int, int, bool]] = []  # text, row, offset, repeated anyway
    by_anchor = np.argsort(anchor, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(anchor[by_anchor]) != 0, [True]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        kinds: dict[tuple[bytes, int], list[int]] = {}
        for row in by_anchor[a:b].tolist():
            kinds.setdefault((contexts[row], int(at[row] - start[row])), []).append(row)
        shared = [len({(text[r], at[r]) for r in rows}) > 1 for rows in kinds.values()]
        for (context, _), rows, whole in zip(kinds, kinds.values(), shared, strict=True):
            if whole:
                spans += [(r, 0, len(context)) for r in rows]
        if len(kinds) == 1 or all(shared):
            continue
        lefts = longest_shared([c[:o][::-1] for c, o in kinds])
        rights = longest_shared([c[o + ANCHOR :] for c, o in kinds])
        cut: dict[tuple[bytes, int], list[int]] = {}
        for i, ((context, offset), left, right) in enumerate(zip(kinds, lefts, rights, strict=True)):
            if left + ANCHOR + right >= width:
                cut.setdefault((context[offset - left : offset + ANCHOR + right], left), []).append(i)
        rows, offsets = [r[0] for r in kinds.values()], [o for _, o in kinds]
        again = [len(members) > 1 or shared[members[0]] for members in cut.values()]
        for (piece, left), members in cut.items():
            if len(members) > 1:
                spans += [(r, offsets[i] - left, offsets[i] - left + len(piece)) for i in members if not shared[i] for r in list(kinds.values())[i]]
        if not all(again):
            to_sort += [(piece, rows[m[0]], offsets[m[0]] - left, double) for ((piece, left), m), double in zip(cut.items(), again, strict=True)]
    found = np.array(spans, np.int64).reshape(-1, 3)
    sorted_ = sorted_spans(to_sort, text, start, width)
    row = np.concatenate([found[:, 0], sorted_[0]])
    return text[row], start[row] + np.concatenate([found[:, 1], sorted_[1]]), start[row] + np.concatenate([found[:, 2], sorted_[2]])


def sorted_spans(pieces: list[tuple], text: np.ndarray, start: np.ndarray, width: int):
    """Spans of repeated strings among pieces, by their suffix order: row, from, to."""
    none = np.zeros(0, np.int64)
    if not pieces:
        return none, none, none
    rows, shift = np.array([p[1] for p in pieces]), np.array([p[2] for p in pieces])
    double = np.array([p[3] for p in pieces])
    lengths = np.array([len(p[0]) for p in pieces])
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    joined = np.zeros(int((lengths + 1).sum()), np.uint16)
    filled = np.ones(len(joined), bool)
    filled[begins + lengths] = False
    joined[filled] = np.frombuffer(b"".join([p[0] for p in pieces]), np.uint8)
    joined[filled] += 1
    _, number = np.unique(text[rows], return_inverse=True)
    place = (number << 34) | (start[rows] + shift)
    found_at, found_run, run = [], [], 0
    for at, prefix in sorted_suffixes(joined, width):
        runs = run + np.cumsum(prefix < width)
        run = int(runs[-1])
        owner = np.searchsorted(begins, at, side="right") - 1
        fits = at - begins[owner] <= lengths[owner] - width
        found_at.append(at[fits])
        found_run.append(runs[fits])
    at, runs = np.concatenate(found_at), np.concatenate(found_run)
    owner = np.searchsorted(begins, at, side="right") - 1
    offset = at - begins[owner]
    edge = np.concatenate([[True], runs[1:] != runs[:-1]])
    heads = np.flatnonzero(edge)
    places = place[owner] + offset
    differs = np.minimum.reduceat(places, heads) != np.maximum.reduceat(places, heads)
    differs |= np.maximum.reduceat(double[owner].astype(np.int8), heads) > 0
    hit = differs[np.cumsum(edge) - 1] & ~double[owner]
    owner, offset = owner[hit], offset[hit]
    if not len(owner):
        return none, none, none
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] > offset[:-1] + width)])
    last = np.concatenate([new[1:], [True]])
    return rows[owner[new]], shift[owner[new]] + offset[new], shift[owner[new]] + offset[last] + width


# --- tables ------------------------------------------------------------------


def repeated(rows: DataFrame) -> DataFrame:
    """``k``, ``first``, ``end`` of repeated strings in different texts or places."""
    found = anchor_rows(rows)
    places = found.groupBy("h").agg(F.min(F.xxhash64("k", "at")).alias("a"), F.max(F.xxhash64("k", "at")).alias("b"))
    again = stage_table(places.filter("a <> b").select(F.col("h").alias("_h")), "repeated_anchors")
    kept = found.join(again, F.col("h") == F.col("_h"), "left_semi")
    listed = stage_table(kept.groupBy("k").agg(F.collect_set(F.struct("at", "h")).alias("marks")), "anchor_marks")
    total = listed.agg(F.coalesce(F.sum(F.size("marks")), F.lit(0))).first()[0]
    shards = max(16, total * 2 * WIDTH // SHARD_BYTES)
    one = rows.filter(F.octet_length("_text") >= WIDTH).groupBy("_k").agg(F.min("_id").alias("_one"))
    chosen = stage_table(listed.join(one, F.col("k") == F.col("_k")).select("k", "_one", "marks"), "anchor_texts")
    texts = rows.join(chosen, (F.col("_k") == F.col("k")) & F.col("_id").eqNullSafe(F.col("_one"))).select("k", "_text", "marks")

    def contexts(batches):
        for batch in batches:
            for k, text, marks in zip(*(batch.column(c).to_pylist() for c in ("k", "_text", "marks")), strict=True):
                first = [max(0, m["at"] - (WIDTH - ANCHOR)) for m in marks]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([m["h"] % shards for m in marks], pa.int64()),
                        pa.array([m["h"] for m in marks], pa.int64()),
                        pa.array([k] * len(marks), pa.int64()),
                        pa.array([m["at"] for m in marks], pa.int64()),
                        pa.array([text[a : m["at"] + WIDTH] for a, m in zip(first, marks, strict=True)], pa.binary()),
                    ],
                    ["shard", "h", "k", "at", "context"],
                )

    def solve(batches):
        now, parts = None, []

        def answer():
            h, k, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
            spans = repeated_spans([c for p in parts for c in p[3]], h, k, at)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in spans], ["k", "first", "end"])

        for batch in batches:
            shard = batch.column("shard").to_numpy(zero_copy_only=False)
            numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "k", "at")]
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if now is not None and shard[a] != now:
                    yield answer()
                    parts = []
                now = shard[a]
                parts.append((*(x[a:b] for x in numbers), batch.column("context").slice(a, b - a).to_pylist()))
        if parts:
            yield answer()

    routed = texts.mapInArrow(contexts, "shard long, h long, k long, at long, context binary")
    return routed.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(solve, "k long, first long, end long")


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``_copies`` and ``_spans`` of their texts."""
    rows = text_rows(docs, id_col, text_col)
    copies = rows.filter(F.octet_length("_text") >= WIDTH).groupBy("_k").agg(F.count("*").alias("_n")).filter("_n > 1")
    none = F.lit(None).cast("struct<first:long,end:long>")
    spans = repeated(rows).select("k", F.lit(1).cast("long").alias("n"), F.struct("first", "end").alias("span"))
    marks = copies.select(F.col("_k").alias("k"), F.col("_n").alias("n"), none.alias("span")).unionAll(spans)
    marks = stage_table(marks.groupBy(F.col("k").alias("_marked")).agg(F.max("n").alias("_copies"), F.collect_list("span").alias("_spans")), "repeat_marks")
    key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(marks, key == F.col("_marked"), "left").drop("_marked")


def without_spans(text: bytes, copies: int | None, spans: list | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    if copies and copies > 1:
        return b"", 1
    if not spans:
        return text, 0
    runs = merged(np.array([s["first"] for s in spans]), np.array([s["end"] for s in spans]))
    edges = [0, *(x for run in runs for x in run), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(runs)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its bytes, those removed, and a digest of the rest."""
    found = marked(docs.select(id_col, text_col), id_col, text_col)
    rows = found.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"), "_copies", "_spans")
    id_type = rows.schema["_id"].dataType.simpleString()

    def digest(batches):
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            left = [without_spans(t, c, s) for t, c, s in zip(texts, batch.column("_copies").to_pylist(), batch.column("_spans").to_pylist(), strict=True)]
            n = [len(t) for t in texts]
            columns = [
                batch.column("_id"),
                pa.array(n, pa.int64()),
                pa.array([a - len(b) for a, (b, _) in zip(n, left, strict=True)], pa.int64()),
                pa.array([runs for _, runs in left], pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b, _ in left], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = f"_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(digest, schema).withColumnRenamed("_id", id_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeated bytes cut out of the text.

    A cut inside a character drops the rest of this character. A NULL text stays NULL.
    """
    found = marked(docs, id_col, text_col)
    names = docs.columns

    def cut(batches):
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            marks = zip(texts, batch.column("_copies").to_pylist(), batch.column("_spans").to_pylist(), strict=True)
            left = [None if t is None else without_spans(t.encode(), c, s)[0].decode("utf-8", "ignore") for t, c, s in marks]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()) if n == text_col else batch.column(n) for n in names], names)

    return found.mapInArrow(cut, docs.schema)
