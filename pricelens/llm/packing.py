"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces of equal length are interchangeable, so a packing is a table of patterns
(the lengths of one sequence) with multiplicities, and depends only on how many
pieces have each length: at most ``capacity`` numbers, whatever the corpus holds.
Spark tokenises, counts lengths, and deals every piece its place; islands, one
Spark task each, evolve packings of those counts.

A chromosome's genes are groups: a pattern and its multiplicity. Crossover injects
well-filled groups of one parent into the other, cuts the other's groups back to
what is left of each length (the duplicates go), and places displaced lengths by
best fit, longest first. Mutation breaks up the least filled groups and a few
others. After each epoch every island's elite is stored and moves on to the next
island. An epoch that reaches the lower bound ceil(tokens / capacity) ends the search.

Ranks of pieces within their length are dealt in blocks (a hash of the row), each
numbered by a window of its own, so a length that a third of all pieces share is
many small sorts.

Defined cases: a NULL or empty text is the end id alone. Repeated rows are packed
once each. A NULL id is packed like any other. Ties between pieces of a length are
broken by the stored row number. An empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import stage_table

CAPACITY = 1024
END_ID = 2
ISLANDS = 6
EPOCHS = 3
GENERATIONS = 8
POPULATION = 6
RANK_BLOCKS = 64
ROWS_PER_BLOCK = 1_000_000
MAX_CACHE = 1_000_000

Pattern = tuple[int, ...]
Packing = dict[Pattern, int]


# --- tokens ------------------------------------------------------------------


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Signs that the tokenizer keeps together, and apart from letters before them.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _Words(dict):
    """Ids, as little-endian bytes, of words behind a fixed beginning.

    Letters alone are one part to the tokenizer and go to its model at once, and so
    do signs behind them; other words are cut by its own rule first.
    """

    def __init__(self, tokenizer, start: str):
        super().__init__()
        self.model, self.cut, self.start, self.letters = tokenizer.model, tokenizer.pre_tokenizer, start, byte_letters()

    def ids(self, text: str) -> bytes:
        part = text.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(part)], "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MAX_CACHE:
            self.clear()
        stem = word.rstrip(SIGNS)
        if word.isalpha():
            found = self.ids(self.start + word)
        elif stem.isalpha():
            found = self[stem] + self.ids(word[len(stem) :])
        else:
            parts = self.cut.pre_tokenize_str(self.start + word)
            found = np.array([t.id for part, _ in parts for t in self.model.tokenize(part)], "<u4").tobytes()
        self[word] = found
        return found


class Encoder:
    """Token ids of a text as bytes.

    The tokenizer cuts a text before every single space, and around a single line
    break, and encodes the parts alone. So the ids of words can be kept; texts with
    other white space or a special token's sign go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.first, self.later = _Words(self.tokenizer, ""), _Words(self.tokenizer, " ")
        self.line_break = self.whole("\n")

    @staticmethod
    def is_plain(text: str, lines: list[str]) -> bool:
        """Words between single spaces and line breaks, without any other white space."""
        if "  " in text or "<|" in text or not all(lines):
            return False
        return all(x.isprintable() and x[0] != " " and x[-1] != " " for x in lines)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        lines = text.split("\n")
        if not self.is_plain(text, lines):
            return self.whole(text)
        found = []
        for line in lines:
            first, *rest = line.split(" ")
            found.append(self.first[first] + b"".join(map(self.later.__getitem__, rest)))
        return self.line_break.join(found)


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every document: ``_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    Only documents longer than ``capacity`` are cut; the first piece is then the
    shorter one. ``path`` names the tokenizer's file, found on each executor.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end = Encoder(path or tokenizer_file()), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = batch.column("_id")
            owner, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                data = encoder.encode(text) + end
                n = len(data) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    owner.append(i)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                ["_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, f"_id {id_type}, piece int, start long, length long, ids_crc32 long")


# --- packings of length counts -----------------------------------------------


def bins(packing: Packing) -> int:
    return sum(packing.values())


def fitness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones (squares reward uneven filling)."""
    return -bins(packing), sum(n * (sum(p) / capacity) ** 2 for p, n in packing.items())


def best_fit(packing: Packing, left: np.ndarray, capacity: int, order=None) -> Packing:
    """Place ``left[length]`` pieces of each length into the fullest sequences they fit."""
    by_room: dict[int, list[list]] = {}
    for pattern, n in packing.items():
        by_room.setdefault(capacity - sum(pattern), []).append([pattern, n])
    rooms = np.zeros(capacity + 1, bool)
    rooms[list(by_room)] = True

    def add(pattern: Pattern, n: int) -> None:
        room = capacity - sum(pattern)
        by_room.setdefault(room, []).append([pattern, n])
        rooms[room] = True

    lengths = np.flatnonzero(left)[::-1] if order is None else [x for x in order if left[x]]
    for length in map(int, lengths):
        count = int(left[length])
        while count:
            room = length + int(np.argmax(rooms[length:])) if rooms[length:].any() else -1
            if room < 0:
                per = capacity // length
                if count >= per:
                    add((length,) * per, count // per)
                if count % per:
                    add((length,) * (count % per), 1)
                break
            groups = by_room[room]
            pattern, n = groups.pop()
            if not groups:
                del by_room[room]
                rooms[room] = False
            used = min(n, count)
            add((*pattern, length), used)
            if n > used:
                add(pattern, n - used)
            count -= used
    merged: Counter = Counter()
    for groups in by_room.values():
        for pattern, n in groups:
            merged[tuple(sorted(pattern, reverse=True))] += n
    return dict(merged)


def take_groups(packing: Packing, left: np.ndarray, order: list[Pattern]) -> Packing:
    """Groups in the given order, cut back to what ``left`` still holds; uses it up."""
    kept: Packing = {}
    for pattern in order:
        uses = Counter(pattern)
        n = min(packing[pattern], *(int(left[x]) // k for x, k in uses.items()))
        if n > 0:
            kept[pattern] = n
            for x, k in uses.items():
                left[x] -= n * k
    return kept


def crossover(one: Packing, other: Packing, counts: np.ndarray, capacity: int, rng) -> Packing:
    """Whole well-filled groups of ``other`` enter ``one``; the rest is best-fitted."""
    filled = sorted(other, key=lambda p: -sum(p))
    filled = [p for p in filled[: max(1, (2 * len(filled)) // 3)] if rng.random() < 0.5]
    left = counts.copy()
    child = Counter(take_groups(other, left, filled))
    rest = sorted(one, key=lambda p: (-sum(p), rng.random()))
    child.update(take_groups(one, left, rest))
    return best_fit(dict(child), left, capacity)


def mutate(packing: Packing, counts: np.ndarray, capacity: int, rng) -> Packing:
    """Break up the emptiest groups and a few others, and best-fit their pieces."""
    keep = [p for p in sorted(packing, key=lambda p: -sum(p)) if sum(p) >= capacity - 1 or rng.random() < 0.6]
    left = counts.copy()
    return best_fit(take_groups(packing, left, [p for p in keep if rng.random() < 0.95]), left, capacity)


def evolve(seeds: list[Packing], counts: np.ndarray, capacity: int, seed: int, generations: int = GENERATIONS, population: int = POPULATION) -> Packing:
    """One island's epoch: the best packing found, never worse than the seeds."""
    rng = np.random.default_rng(seed)
    bound = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    crowd = list(seeds)
    if not crowd:
        crowd.append(best_fit({}, counts, capacity))
    while len(crowd) < population and bins(crowd[0]) > bound:
        if len(crowd) % 2:
            crowd.append(mutate(crowd[0], counts, capacity, rng))
        else:
            crowd.append(best_fit({}, counts, capacity, list(rng.permutation(capacity + 1))))
    for _ in range(generations):
        crowd.sort(key=lambda p: fitness(p, capacity), reverse=True)
        if bins(crowd[0]) <= bound:
            break
        children = []
        for _ in range(population):
            a, b = (min(rng.integers(len(crowd), size=2)) for _ in range(2))
            child = crossover(crowd[a], crowd[b], counts, capacity, rng)
            children.append(mutate(child, counts, capacity, rng) if rng.random() < 0.5 else child)
        crowd = sorted(crowd + children, key=lambda p: fitness(p, capacity), reverse=True)[:population]
    return max(crowd, key=lambda p: fitness(p, capacity))


# --- islands and dealing -----------------------------------------------------

_ELITE = "island int, patterns array<array<int>>, counts array<long>, size long"


def search(spark, counts: np.ndarray, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 0) -> Packing:
    """Best packing of ``counts[length]`` pieces found by the islands."""
    bound = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    elites = None
    for epoch in range(epochs):

        def live(batches, epoch=epoch):
            seeds: dict[int, list[Packing]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    own = seeds.setdefault(row["island"], [])
                    if row.get("patterns"):
                        own.append({tuple(p): n for p, n in zip(row["patterns"], row["counts"], strict=True)})
            for island, known in seeds.items():
                best = evolve(known, counts, capacity, hash((seed, epoch, island)) % 2**32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([island], pa.int32()), pa.array([[*best]], pa.list_(pa.list_(pa.int32()))), pa.array([[*best.values()]], pa.list_(pa.int64())), pa.array([bins(best)], pa.int64())],
                    ["island", "patterns", "counts", "size"],
                )

        if elites is None:
            start = spark.range(0, islands, 1, islands).select(F.col("id").cast("int").alias("island"))
        else:
            moved = elites.withColumn("island", (F.col("island") + 1) % islands)
            start = elites.unionAll(moved).repartition(islands, "island").select("island", "patterns", "counts")
        elites = stage_table(start.mapInArrow(live, _ELITE), "packing_elites")
        best = elites.orderBy("size", "island").limit(1).first()  # a pattern per group
        if best.size <= bound:
            break
    return {tuple(p): n for p, n in zip(best.patterns, best.counts, strict=True)}


def dealing_table(packing: Packing) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, uses per sequence, first sequence and offset of each group."""
    table: dict[int, list[tuple]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for pattern, n in sorted(packing.items(), reverse=True):
        offset = 0
        for length, k in sorted(Counter(pattern).items(), reverse=True):
            table.setdefault(length, []).append((ranks[length], k, sequence, offset))
            ranks[length] += n * k
            offset += length * k
        sequence += n
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for length, rows in table.items()}


def deal(ranked: DataFrame, packing: Packing) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with their ``rank`` within their length."""
    table = dealing_table(packing)

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                which = length == x
                first, uses, base, start = table[int(x)]
                group = np.searchsorted(first, rank[which], side="right") - 1
                within = rank[which] - first[group]
                sequence[which] = base[group] + within // uses[group]
                offset[which] = start[group] + within % uses[group] * x
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kept = ranked.drop("rank").schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def rank_in_length(stored: DataFrame, n_rows: int) -> DataFrame:
    """Number the rows of each length from 0, block by block."""
    blocks = max(RANK_BLOCKS, -(-n_rows // ROWS_PER_BLOCK))
    rows = stored.withColumn("_row", F.monotonically_increasing_id()).withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    sizes = sizes.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row")) - 1
    numbered = rows.withColumn("_own", own)
    return numbered.join(sizes, ["length", "_block"]).withColumn("rank", F.col("_first") + F.col("_own")).drop("_row", "_block", "_own", "_first")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    cut = stage_table(pieces(docs, path, capacity, id_col, text_col), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # a row per length
        counts[row["length"]] = row["count"]
    if not counts.any():
        packing: Packing = {}
    else:
        packing = search(docs.sparkSession, counts, capacity)
    dealt = deal(rank_in_length(cut, int(counts.sum())), packing)
    return dealt.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
