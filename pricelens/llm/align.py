"""Aligns the tokens of two tokenizers by bytes and looks up how often a pair meets.

Tokenizer A is byte-level, B works on pieces; both see a space and the text. Where a
token of each ends at the same byte the text is cut into groups; an A and a B token
whose bytes overlap are linked, which is once for every stretch between two
neighbouring ends of either.

1. First pass: links are counted per batch of documents and stored as (pair, count).
2. The distinct pairs get a minimal perfect hash, a shard to a task, with the pairs
   themselves in the slots.
3. A task takes a slice of a shard's stored counts and sums them into a dense vector
   indexed by the hash. Vectors of a shard are summed as a tree, ``FAN`` to a task, and
   the last one is stored beside the shard's hash.
4. Second pass: documents are aligned again and every link's count is looked up; the
   pair in the slot is compared, so a foreign pair counts as nothing.

A vector has one number per distinct pair of a shard. How many pairs there are is bound
by the product of the vocabularies, not by the corpus; the highest count of each B id is
one array as long as B's vocabulary.

Both tokenizers cut a text before a single space and around a single line break, so
texts whose words stand between single spaces and line breaks are aligned word by word,
each distinct word of a task once. Other texts go to the tokenizers whole. A test holds
both ways together.

Defined cases: a text that is NULL, empty, or not rendered byte for byte by both
tokenizers has no tokens: zeros, and an empty digest. Special tokens' strings are plain
text. Repeated rows count each. NULL ids are kept. Ties for the highest count all
count as highest. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.files import map_arrays, write_arrays
from pricelens.llm.hashing import mix
from pricelens.llm.mph import SHARD_KEYS, Arrays, Index, build_shards, places, shard_count, shard_of
from pricelens.llm.packing import byte_letters, tokenizer_file
from pricelens.session import scratch_path, stage_table

SLICE_ROWS = 500_000
FAN = 16
MAX_CHARS = 4_000_000
GROUP_CHARS = 2_000_000
TOGETHER = 50_000
PAIR_BASE = 1 << 32
# Fixed value: the pattern by which byte-level tokenizer A cuts a text before its merges.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"


class Units:
    """Aligned pieces of text of a task, numbered: words with what stands before them, or whole texts.

    A unit starts with the space or line break before it. New units are tokenised and
    aligned together, as one long run of bytes in which every unit's end is an end of
    both sides. Simple words of A go through a faster library with the ranks of A's own
    vocabulary, which a test compares; all else goes to A's tokenizer itself.
    """

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a or tokenizer_file("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b or tokenizer_file("piece_bpe_32k.model"))
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.bytes_a[number] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        ranks = {x: i for i, x in enumerate(self.bytes_a) if x and i not in self.a.get_added_tokens_decoder()}
        self.bpe = tiktoken.Encoding("side_a", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.bytes_b = [self._bytes_b(i) for i in range(self.b.vocab_size())]
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b)]
        # An id as text with the sign behind it: inside its part of a group, and at the part's end.
        self.signed = [
            [np.array([f"{i}{sign}" for i in range(len(side))], object) for sign in ("," + end)]
            for side, end in ((self.bytes_a, "|"), (self.bytes_b, ";"))
        ]
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.unlike: set[int] = set()
        self.spelled: list[bytes | None] = []
        self.tokens = np.zeros((0, 3), np.int64)  # of A, of B, groups
        self.starts = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.looked = np.zeros((0, 2), np.int64)  # sum of counts, highest ones

    def _bytes_b(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(SPACE, " ").encode()

    def ids_a(self, unit: str) -> list[int]:
        return self.a.encode(unit, add_special_tokens=False).ids

    def ids_b(self, units: list[str]) -> list[list[int]]:
        """B puts a space before every text; behind it a line break is a byte of its own."""
        found = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [ids if u[0] == " " else ids[1:] for u, ids in zip(units, found, strict=True)]

    def add(self, units: list[str]) -> None:
        """Number and align units that are not known yet."""
        if not units:
            return
        self.chars += sum(map(len, units))
        simple, others = [], []
        for unit in units:
            (simple if self._is_simple(unit) else others).append(unit)
        simple.sort(key=lambda unit: unit[0] != " ")
        for at in range(0, len(simple), TOGETHER):
            some = simple[at : at + TOGETHER]
            found = self._together(some)
            if found is None:
                others += some
            else:
                self._align(some, *found, [True] * len(some))
        if others:
            ids = list(zip(map(self.ids_a, others), self.ids_b(others), strict=True))
            whole = self._rendered(others, ids)
            kept = [x if ok else ([], []) for x, ok in zip(ids, whole, strict=True)]
            sides = [np.array([i for x in kept for i in x[side]], np.int64) for side in (0, 1)]
            n = [np.array([len(x[side]) for x in kept], np.int64) for side in (0, 1)]
            self._align(others, sides, n, whole)

    @staticmethod
    def _is_simple(unit: str) -> bool:
        """A word of characters whose classes are the same in every library, behind a space or line break."""
        word = unit[1:]
        return word.isprintable() and " " not in word and max(word, default="") < "\u2000"

    def _together(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
        """Ids of simple units in one run, and how many each has; those behind a space come first.

        None if a unit's end is not an end of a token, or a side does not render the run.
        """
        text = "".join(units)
        data = text.encode()
        first = text[0] == " "
        b = self.b.encode(text[1:] if first else text, num_threads=1)
        sides = [self.bpe.encode_ordinary(text), b if first else b[1:]]
        if any(b"".join([spelt[i] for i in ids]) != data for spelt, ids in zip((self.bytes_a, self.bytes_b), sides, strict=True)):
            return None
        sides = [np.array(ids, np.int64) for ids in sides]
        stops = np.cumsum([len(u) for u in units] if len(text) == len(data) else [len(u.encode()) for u in units])
        n = []
        for size, ids in zip(self.sizes, sides, strict=True):
            ends = np.cumsum(size[ids])
            at = np.searchsorted(ends, stops)
            if not (ends[at] == stops).all():
                return None
            n.append(np.diff(at, prepend=-1))
        return sides, n

    def _align(self, units: list[str], sides: list[np.ndarray], n: list[np.ndarray], whole: list[bool]) -> None:
        """Number units whose tokens follow each other, and align them."""
        self.number.update({u: i for i, u in enumerate(units, len(self.spelled))})
        self.unlike.update(self.number[u] for u, ok in zip(units, whole, strict=True) if not ok)
        ends = [np.cumsum(size[side]) for size, side in zip(self.sizes, sides, strict=True)]
        all_ends = np.union1d(*ends)
        shared = np.intersect1d(*ends, assume_unique=True)
        of_a, of_b = (np.searchsorted(e, all_ends) for e in ends)
        owner = np.repeat(np.arange(len(units)), n[0])
        n_links = np.bincount(owner[of_a], minlength=len(units))
        n_groups = np.bincount(owner[np.searchsorted(ends[0], shared)], minlength=len(units))
        self.tokens = np.concatenate([self.tokens, np.column_stack([*n, n_groups])])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(n_links)])
        self.pairs = np.concatenate([self.pairs, sides[0][of_a] * PAIR_BASE + sides[1][of_b]])
        self._spell(sides, ends, shared, n[0] + n[1], whole)

    def _rendered(self, units: list[str], ids: list[tuple[list[int], list[int]]]) -> list[bool]:
        """Whether both sides' bytes are the unit's; all units are compared in one go if they can be."""

        def same(text: str, a: Iterable[int], b: Iterable[int]) -> bool:
            data = text.encode()
            return b"".join([self.bytes_a[i] for i in a]) == data and b"".join([self.bytes_b[i] for i in b]) == data

        def lengths(side: int) -> np.ndarray:
            flat = self.sizes[side][np.array([i for x in ids for i in x[side]], np.int64)]
            ends = np.concatenate([[0], np.cumsum(flat)])[np.cumsum([0, *[len(x[side]) for x in ids]])]
            return np.diff(ends)

        together = same("".join(units), (i for x in ids for i in x[0]), (i for x in ids for i in x[1]))
        if together and (lengths(0) == lengths(1)).all():
            return [True] * len(units)
        return [same(u, *x) for u, x in zip(units, ids, strict=True)]

    def _spell(self, sides, ends, shared, sizes, whole) -> None:
        """``a1,a2|b1;a3|b2`` of each unit; None for one that a side does not render."""
        parts = np.concatenate([
            np.where(np.isin(e, shared, assume_unique=True), last[ids], inner[ids])
            for (inner, last), ids, e in zip(self.signed, sides, ends, strict=True)
        ])
        group = np.concatenate([2 * np.searchsorted(shared, e) + side for side, e in enumerate(ends)])
        ordered = parts[np.argsort(group, kind="stable")].tolist()
        at = 0
        for size, ok in zip(sizes.tolist(), whole, strict=True):
            self.spelled.append("".join(ordered[at : at + size])[:-1].encode() if ok else None)
            at += size

    @staticmethod
    def cut(text: str) -> list[str] | None:
        """Words with the space or line break before them; None if the text has to be taken whole."""
        lines = text.split("\n")
        if "  " in text or SPACE in text or not all(x.isprintable() and x[:1] not in ("", " ") and x[-1] != " " for x in lines):
            return None
        found = []
        for i, line in enumerate(lines):
            first, *rest = line.split(" ")
            found.append(("\n" if i else " ") + first)
            found += [" " + w for w in rest]
        return found

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Unit numbers of all texts in a row, and where each text's begin; none for a text without tokens."""
        if self.chars > MAX_CHARS:
            self.clear()
        cut = [(self.cut(t) or [" " + t]) if t else [] for t in texts]
        self._meet(chain.from_iterable(cut))
        known = [list(map(self.number.__getitem__, units)) for units in cut]
        if self.unlike:
            for i, numbers in enumerate(known):
                if len(numbers) > 1 and not self.unlike.isdisjoint(numbers):
                    self._meet([" " + texts[i]])
                    known[i] = [self.number[" " + texts[i]]]
            known = [x if self.unlike.isdisjoint(x) else [] for x in known]
        return np.array(list(chain.from_iterable(known)), np.int64), np.cumsum([0, *map(len, known)])

    def _meet(self, units: Iterable[str]) -> None:
        self.add([u for u in dict.fromkeys(units) if u not in self.number])

    def sums(self, values: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sum of a value of the units over each text."""
        total = np.concatenate([[0], np.cumsum(values[numbers])])
        return total[starts[1:]] - total[starts[:-1]]


def text_groups(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a group holds about ``GROUP_CHARS`` bytes of text, a longer text alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > GROUP_CHARS:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


# --- counts ------------------------------------------------------------------


def pair_hash(pairs: np.ndarray) -> np.ndarray:
    return mix(pairs.astype(np.uint64)).view(np.int64)


def pair_counts(docs: DataFrame, path_a: str | None, path_b: str | None, text_col: str = "text") -> DataFrame:
    """``h1, h2, n``: links of a pair (``h2``) in a batch of documents; ``h1`` spreads pairs."""

    def count(batches):
        units = Units(path_a, path_b)
        for batch in text_groups(batches, text_col):
            numbers, _ = units.documents(batch.column(text_col).to_pylist())
            times = np.bincount(numbers, minlength=len(units.spelled))
            links = np.diff(units.starts)
            weights = np.repeat(times, links)
            pairs, weights = units.pairs[weights > 0], weights[weights > 0]
            if len(pairs) == 0:
                continue
            order = np.argsort(pairs, kind="stable")
            pairs, weights = pairs[order], weights[order]
            first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            distinct, sums = pairs[first], np.add.reduceat(weights, first)
            yield pa.RecordBatch.from_arrays([pa.array(pair_hash(distinct)), pa.array(distinct), pa.array(sums)], ["h1", "h2", "n"])

    return docs.select(text_col).mapInArrow(count, "h1 long, h2 long, n long")


def slot_pairs(hashed: Arrays, columns: Arrays) -> Arrays:
    pairs = np.zeros(len(hashed["at"]), np.int64)
    pairs[hashed["at"]] = columns["h2"]
    return {"pairs": pairs}


def summed(table: pa.Table) -> np.ndarray:
    vectors = table.column("vector")
    total = np.frombuffer(vectors[0].as_py(), "<i8").copy()
    for x in vectors[1:]:
        total += np.frombuffer(x.as_py(), "<i8")
    return total


def dense_counts(counts: DataFrame, index: Index, slices: int) -> dict[int, str]:
    """Files of the count vectors, one a shard, summed slice by slice and then as a tree."""

    def vector(key, table):
        shard, part = (int(k.as_py()) for k in key)
        arrays = index.shard(shard)
        pairs = table.column("h2").to_numpy()
        at = places(arrays, table.column("h1").to_numpy().view(np.uint64), pairs.view(np.uint64))
        total = np.zeros(len(arrays["pairs"]), np.int64)
        np.add.at(total, at, table.column("n").to_numpy())
        return pa.table({"shard": pa.array([shard], pa.int32()), "part": pa.array([part // FAN], pa.int32()), "vector": [total.tobytes()]})

    def merged(key, table):
        shard, part = (int(k.as_py()) for k in key)
        return pa.table({"shard": pa.array([shard], pa.int32()), "part": pa.array([part // FAN], pa.int32()), "vector": [summed(table).tobytes()]})

    def stored(key, table):
        file = write_arrays(folder, {"counts": summed(table)})
        return pa.table({"shard": pa.array([int(key[0].as_py())], pa.int32()), "file": [file]})

    folder, kind = index.folder, "shard int, part int, vector binary"
    dealt = counts.select(shard_of("h1", index.shards).alias("shard"), (F.col("row") % slices).cast("int").alias("part"), "h1", "h2", "n")
    vectors = stage_table(dealt.groupBy("shard", "part").applyInArrow(vector, kind), "vectors")
    left = -(-slices // FAN)
    while left > 1:
        vectors = stage_table(vectors.groupBy("shard", "part").applyInArrow(merged, kind), "vectors")
        left = -(-left // FAN)
    files = vectors.groupBy("shard").applyInArrow(stored, "shard int, file string")
    return {r.shard: r.file for r in stage_table(files, "count_files").collect()}


def best_counts(index: Index, files: dict[int, str], spark) -> str | None:
    """File of the highest count of each B id: one row per B id and shard, at most, is summed up."""
    if not files:
        return None
    shards = spark.createDataFrame(sorted(files), "int").repartition(len(files), "value")

    def highest(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                ids = index.shard(number)["pairs"] % PAIR_BASE
                counts = map_arrays(index.folder, files[number])["counts"]
                distinct, at = np.unique(ids, return_inverse=True)
                most = np.zeros(len(distinct), np.int64)
                np.maximum.at(most, at, counts)
                yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(most)], ["b", "most"])

    rows = shards.mapInArrow(highest, "b long, most long").groupBy("b").agg(F.max("most").alias("most"))

    def store(batches):
        # As long as B's vocabulary, whatever the corpus holds.
        table = pa.Table.from_batches(list(batches))
        best = np.zeros(int(table.column("b").to_numpy().max()) + 1, np.int64)
        best[table.column("b").to_numpy()] = table.column("most").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([write_arrays(index.folder, {"best": best})])], ["file"])

    return stage_table(rows.coalesce(1).mapInArrow(store, "file string"), "best_file").first().file


class PairCounts:
    """Look-ups of pair counts for the second pass."""

    def __init__(self, index: Index, files: dict[int, str], best: str | None):
        self.index, self.files, self.best = index, files, best
        self.loaded: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return {**self.__dict__, "loaded": {}}

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """Count of each pair; a pair that was never counted has 0."""
        high, low = pair_hash(pairs), pairs.view(np.uint64)
        found, shard = np.zeros(len(pairs), np.int64), np.mod(high, self.index.shards)
        for number in np.unique(shard).tolist():
            arrays = self.index.shard(number)
            if arrays is None:
                continue
            if number not in self.loaded:
                self.loaded[number] = map_arrays(self.index.folder, self.files[number])["counts"]
            rows = np.flatnonzero(shard == number)
            at = places(arrays, high[rows].view(np.uint64), low[rows])
            known = at >= 0
            known[known] = arrays["pairs"][at[known]] == pairs[rows[known]]
            found[rows[known]] = self.loaded[number][at[known]]
        return found

    def look_up_units(self, units: Units) -> None:
        """Counts of the links of units that have none yet."""
        done = len(units.looked)
        if done == len(units.spelled):
            return
        if -1 not in self.loaded:
            self.loaded[-1] = map_arrays(self.index.folder, self.best)["best"] if self.best else np.zeros(1, np.int64)
        pairs = units.pairs[units.starts[done] :]
        distinct, at = np.unique(pairs, return_inverse=True)
        counts = self.look_up(distinct)
        best = counts == self.loaded[-1][distinct % PAIR_BASE] if len(distinct) else counts > 0
        starts = units.starts[done:] - units.starts[done]
        totals = [np.concatenate([[0], np.cumsum(x[at])]) for x in (counts, best.astype(np.int64))]
        units.looked = np.concatenate([units.looked, np.column_stack([t[starts[1:]] - t[starts[:-1]] for t in totals])])


def count_pairs(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text_col: str = "text",
    shard_keys: int = SHARD_KEYS, slice_rows: int = SLICE_ROWS,
) -> PairCounts:
    """First pass: how many links of the whole corpus hold each pair."""
    counts = pair_counts(docs, path_a, path_b, text_col).withColumn("row", F.monotonically_increasing_id())
    counts = stage_table(counts, "pair_counts")
    pairs = stage_table(counts.select("h1", "h2").distinct(), "pairs")
    shards = shard_count(pairs.count(), shard_keys)
    index = build_shards(pairs, shards, slot_pairs, "pairs")
    slices = -(-max(1, counts.count()) // (shards * slice_rows))
    files = dense_counts(counts, index, slices)
    return PairCounts(index, files, best_counts(index, files, docs.sparkSession))


def aligned(docs: DataFrame, counts: PairCounts, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Second pass: per document, tokens, groups, links, their counts, and the groups spelled out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def align(batches):
        units = Units(path_a, path_b)
        for batch in text_groups(batches, "text"):
            numbers, starts = units.documents(batch.column("text").to_pylist())
            counts.look_up_units(units)
            links = np.diff(units.starts)
            values = [*units.tokens.T, links, units.looked[:, 1], units.looked[:, 0]]
            columns = [pa.array(units.sums(v, numbers, starts)) for v in values]
            digests = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                spelled = b";".join([units.spelled[i] for i in numbers[a:b].tolist()])
                digests.append(hashlib.sha256(spelled).hexdigest() if b > a else "")
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns, pa.array(digests, pa.string())], ["id", *names, "groups_sha256"])

    out = T.StructType([rows.schema["id"]])
    for name in names:
        out = out.add(name, "long")
    return rows.mapInArrow(align, out.add("groups_sha256", "string")).withColumnRenamed("id", id_col)


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    return aligned(docs, count_pairs(docs, path_a, path_b), path_a, path_b)
