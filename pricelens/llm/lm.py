"""Language-model scores from an Elias-Fano n-gram trie in memory-mapped levels.

Spark counts words, word pairs and triples of the training texts; tasks build the
trie's levels into files of a shared folder; scoring tasks map those files and look
up what their own documents hold, a batch of distinct pairs or triples at a time.
All files of a level are mapped into one address space, so that a batch is looked up
at once in however many shards it falls.

Level 1, in shards by word hash: sorted hashes and counts; a word's id is its place.
Texts are cut into words for the counts and once more for the ``ids`` of all
documents, which are stored; all later passes and the scores read those.
Level 2, in shards by (context, block of following words): the contexts are an
Elias-Fano sequence; the followers of all contexts form a second one, each context's
ids raised by its place times the number of words, so that they stand between it and
the next. A pair is found by a successor search relative to its context. Its smoothed
probability is stored in 8 bits, an index into the shard's table of levels; its
count is a difference of a third sequence.

Level 3, in shards by (middle word, blocks of both others): as level 2, but a context
is a pair's number (its node). Shards are counted, written and committed a range at
a time, so that the exchange of one range is on disk. Tables of more than
``RANGES`` times ``TRIPLES_PER_RANGE`` tokens have larger ranges, not more: each range
reads the ids of all training texts.

Counts are exchanged as one packed row for each shard of about ``GATHERED`` tokens; the
task that writes the shard sorts and sums them.

    p(w | u) = (c(u w) + MU p(w)) / (c(u) + MU),   p(w) = (c(w) + 1) / (N + V + 1)
    p(w | t u) = (c(t u w) + MU p(w | u)) / (c(t u) + MU)

An unseen pair takes MU p(w) / (c(u) + MU), an unseen triple MU p(w | u) / (c(t u) + MU);
an unknown context tells nothing. A text starts in the context of the end token; its
first token has no triple. ``score`` sums p(w | t u), or p(w | u) where there is no
pair before; ``score2`` sums p(w | u) alone. A context's followers are spread over many
shards, so that a word behind a third of all tokens is no one's burden. No level
passes through the driver: it holds one manifest row per shard, and shards are at
most ``MAX_SHARDS``.

Words are told apart by 64-bit hashes. Defined cases: a NULL or empty text is the
end token alone; a NULL id belongs to the training part; repeated rows are counted
and scored once each; with no training text, N = V = 0 and all words are unknown.
An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.eliasfano import PARTS, Sequences, encode
from pricelens.llm.files import layout, map_space, write_arrays
from pricelens.llm.hashing import chunks, mix, word_hashes
from pricelens.session import scratch_path, stage_table

MU = 4.0
END = np.uint64(1)
#: Tokens whose words, pairs or triples are summed before they are shuffled.
GATHERED = 1_000_000
#: Tokens whose pairs and triples are made distinct and looked up together.
SCORED = 1 << 19
#: Queries in one pass through a level.
ASKED = 1 << 14
WORDS_PER_SHARD = 500_000
PAIRS_PER_SHARD = 1_000_000
MAX_SHARDS = 4096
SHARD_BITS = np.uint64(12)
#: Words that ids of 32 bits tell apart; more are refused. As an id: an unknown word.
MOST_WORDS = (1 << 32) - 1
UNKNOWN = np.uint32((1 << 32) - 1)
LOW = np.uint64((1 << 32) - 1)
HALF = np.uint64(32)
BLOCK_BITS = 12
FIRST_BITS = 14
#: Training tokens whose triples are exchanged at a time, as long as that makes no more than ``RANGES``.
TRIPLES_PER_RANGE = 32_000_000
RANGES = 4


def held_out(id_col: Column) -> Column:
    text = id_col.cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % 7 == 2, F.lit(False))


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, each followed by the end token; tokens per text."""
    words, sizes = word_hashes(texts)
    sizes = sizes + 1
    tokens = np.full(len(words) + len(texts), END, np.uint64)
    is_word = np.ones(len(tokens), bool)
    is_word[np.cumsum(sizes) - 1] = False
    tokens[is_word] = words
    return tokens, sizes


def shard_count(n: int, per_shard: int) -> int:
    """A power of two from 16 to MAX_SHARDS."""
    return min(MAX_SHARDS, max(16, 1 << max(0, -(-n // per_shard) - 1).bit_length()))


def spread(first: np.ndarray | None, context: np.ndarray, word: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards (a power of two) of pairs, or of triples; and 64 bits that order them by shard and tell them apart."""
    if len(word) > ASKED:  # arrays that stay in the cache
        parts = [spread(None if first is None else first[a : a + ASKED], context[a : a + ASKED], word[a : a + ASKED], shards) for a in range(0, len(word), ASKED)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    context, word = context.astype(np.uint64), word.astype(np.uint64)
    block, own = word >> np.uint64(BLOCK_BITS), word & np.uint64((1 << BLOCK_BITS) - 1)
    key = context * np.uint64(0x9E3779B97F4A7C15) + block
    own = own * np.uint64(0xD6E8FEB86659FD93)
    if first is not None:
        first = first.astype(np.uint64)
        key += (first >> np.uint64(FIRST_BITS)) * np.uint64(0xC2B2AE3D27D4EB4F)
        own += (first & np.uint64((1 << FIRST_BITS) - 1)) * np.uint64(0xA0761D6478BD642F)
    key = mix(key)
    shard = key & np.uint64(shards - 1)
    return shard.astype(np.int64), (shard << (np.uint64(64) - SHARD_BITS)) | ((key + own) >> SHARD_BITS)


def alike(mixed: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the top bits of ``mixed``, and where in it runs of equal keys begin.

    Equal keys have equal ``mixed``; where others share its top bits, they may be several runs.
    """
    bits = max(1, (len(mixed) - 1).bit_length())
    low = np.uint64((1 << bits) - 1)
    order = (np.sort((mixed & ~low) | np.arange(len(mixed), dtype=np.uint64)) & low).astype(np.int64)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    return order, np.flatnonzero(new)


def groups_of(mixed: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each group of equal keys, and every place's group."""
    order, first = alike(mixed, *keys)
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    return order[first], place


def in_file_order(shard: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """An order of queries by shard, then context: what they read stands side by side."""
    bits = max(1, (len(shard) - 1).bit_length())
    contexts = contexts.astype(np.uint64)
    room = 64 - int(SHARD_BITS) - bits
    over = max(0, int(contexts.max(initial=0)).bit_length() - room)
    key = (shard.astype(np.uint64) << (np.uint64(64) - SHARD_BITS)) | ((contexts >> np.uint64(over)) << np.uint64(bits)) | np.arange(len(shard), dtype=np.uint64)
    return (np.sort(key) & np.uint64((1 << bits) - 1)).astype(np.int64)


def places(arrays: dict[str, np.ndarray], sequences: tuple[str, ...]) -> list[int]:
    """The manifest of a shard's file: its size, where its levels and chances begin, and its sequences' meta and parts."""
    _, starts, size = layout(arrays)
    found = [size, starts["levels"] // 8, starts["chance"]]
    for name in sequences:
        found += arrays[f"{name}_meta"].tolist()
        found += [starts[f"{name}_{part}"] // (8 if part in ("high", "low") else 4) for part in PARTS]
    return found


class Level:
    """Shards of pairs or triples; their files are mapped when first used."""

    def __init__(self, folder: str, rows: list[tuple], shards: int, kinds: int, sequences: tuple[str, ...]):
        rows = sorted(rows)
        self.folder, self.shards, self.kinds, self.sequences = folder, shards, kinds, sequences
        self.files = [r[1] for r in rows]
        #: Row of each shard; number of its first entry; its manifest.
        self.row = np.full(shards, -1, np.int64)
        self.row[[r[0] for r in rows]] = np.arange(len(rows))
        self.first = np.cumsum([0] + [r[2] for r in rows])
        self.places = np.array([r[3] for r in rows], np.int64).reshape(len(rows), 3 + len(sequences) * (3 + len(PARTS)))
        self._space: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")} | {"_space": None}

    def _open(self) -> None:
        if self._space is not None:
            return
        self._space, begin = map_space(self.folder, self.files, self.places[:, 0].tolist())
        half, self._bytes, self._values = self._space.view(np.uint32), self._space.view(np.uint8), self._space.view(np.float64)
        self._levels, self._chances = self.places[:, 1] + begin // 8, self.places[:, 2] + begin
        self._found = {}
        for i, name in enumerate(self.sequences):
            at = 3 + i * (3 + len(PARTS))
            starts = self.places[:, at + 3 : at + 3 + len(PARTS)] + np.stack([begin // (8 if part in ("high", "low") else 4) for part in PARTS], axis=1)
            self._found[name] = Sequences([self._space, half, half, half, self._space], self.places[:, at : at + 3], starts)

    def find(self, shard: np.ndarray, contexts: np.ndarray, words: np.ndarray):
        """Parts of the queries whose words follow their context: which, the rows of their shards, and their places there."""
        self._open()
        order = in_file_order(shard, contexts)
        order = order[self.row[shard[order]] >= 0]
        for a in range(0, len(order), ASKED):
            which = order[a : a + ASKED]
            row = self.row[shard[which]]
            node = self._found["context"].find(row, contexts[which].astype(np.uint64))
            known = np.flatnonzero(node >= 0)
            which, row = which[known], row[known]
            at = self._found["word"].find(row, node[known].astype(np.uint64) * np.uint64(self.kinds) + words[which].astype(np.uint64))
            known = np.flatnonzero(at >= 0)
            yield which[known], row[known], at[known]

    def stored(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Stored log10 probabilities."""
        return self._values[self._levels[row] + self._bytes[self._chances[row] + at]]

    def counts(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._found["count"].steps(row, at).astype(np.int64)


class Trie:
    """The levels of a trained model; files are mapped when first used."""

    def __init__(self, folder: str, words: list[tuple], tokens: int):
        self.folder, self.words, self.tokens = folder, words, tokens
        self.starts = np.cumsum([0] + [w[1] for w in words])
        self.kinds = int(self.starts[-1])
        self.shift = 64 - (len(words).bit_length() - 1)
        self.pairs = self.triples = None
        self._open: list | None = None

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def _words(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Hashes and counts of each shard."""
        if self._open is None:
            space, begin = map_space(self.folder, [w[0] for w in self.words if w[1]], [w[2] for w in self.words if w[1]])
            signed, at = space.view(np.int64), dict(zip([s for s, w in enumerate(self.words) if w[1]], (begin // 8).tolist(), strict=True))
            self._open = [
                (space[at[s] + h // 8 :][:n], signed[at[s] + c // 8 :][:n]) if n else (space[:0], signed[:0])
                for s, (_, n, _, h, c) in enumerate(self.words)
            ]
        return self._open

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of tokens."""
        one, place = groups_of(hashes, hashes)
        kinds = hashes[one]
        ids = np.full(len(kinds), UNKNOWN, np.uint32)
        shards = (kinds >> np.uint64(self.shift)).astype(np.int64)
        cuts = np.searchsorted(shards, np.arange(len(self.words) + 1))
        for s, (known, _) in enumerate(self._words()):
            a, b = cuts[s], cuts[s + 1]
            if a == b or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, kinds[a:b]), len(known) - 1)
            ids[a:b] = np.where(known[at] == kinds[a:b], (at + self.starts[s]).astype(np.uint32), UNKNOWN)
        return ids[place]

    def end(self) -> np.uint32:
        return self.lookup(np.array([END]))[0]

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted known ids."""
        found = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.starts)
        for s, (_, counts) in enumerate(self._words()):
            if cuts[s] < cuts[s + 1]:
                found[cuts[s] : cuts[s + 1]] = counts[ids[cuts[s] : cuts[s + 1]].astype(np.int64) - self.starts[s]]
        return found

    def word_chance(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.kinds + 1)

    def pair_facts(self, shard: np.ndarray, contexts: np.ndarray, words: np.ndarray, counted: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes, counts (if wanted) and stored log10 probabilities of pairs of known ids; -1, 0 and NaN for unseen ones."""
        node, count, found = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64), np.full(len(words), np.nan)
        for which, row, at in self.pairs.find(shard, contexts, words):
            node[which], found[which] = self.pairs.first[row] + at, self.pairs.stored(row, at)
            if counted:
                count[which] = self.pairs.counts(row, at)
        return node, count, found

    def triple_scores(self, shard: np.ndarray, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Stored log10 probabilities of words after pairs, whose nodes are given; NaN for unseen triples."""
        found = np.full(len(words), np.nan)
        for which, row, at in self.triples.find(shard, nodes, words):
            found[which] = self.triples.stored(row, at)
        return found

    def score(self, ids: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of whole texts, whose ids follow one another; each ends with the end token, and none is empty."""
        n, end = len(sizes), self.end()
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        starts = np.zeros(len(ids), bool)
        starts[np.cumsum(sizes) - sizes] = True
        padded = np.concatenate([np.full(2, end, np.uint32), ids])
        totals = {name: np.zeros(n) for name in ("n_known", "base_score", "score", "score2")}
        for a in range(0, len(ids), SCORED):
            b, begin = min(a + SCORED, len(ids)), max(a - 1, 0)  # the pair before the first token is its context
            known, base, logs, deep = self._logs(padded[begin : b + 2], starts[begin:b])
            own = owner[a:b]
            for name, values in zip(totals, (known, base, deep, logs), strict=True):
                totals[name][own[0] : own[-1] + 1] += np.bincount(own - own[0], values[a - begin :])
        return {"n_tokens": sizes, **totals, "n_known": totals["n_known"].astype(np.int64)}

    def _logs(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """For the tokens from the third on: which are known, and log10 probabilities from words, pairs and all levels."""
        one, place = groups_of(ids[1:].astype(np.uint64) << HALF, ids[1:])
        kinds = ids[1:][one]
        there = kinds != UNKNOWN
        counts = np.zeros(len(kinds), np.int64)
        counts[there] = self.counts_of(kinds[there])
        first, context, word = ids[:-2], ids[1:-1], ids[2:]
        known = there[place]
        base = np.log10(self.word_chance(counts))[place[1:]]
        logs = base + np.where(there, np.log10(MU / (counts + MU)), 0.0)[place[:-1]]
        known, both = known[1:], np.flatnonzero(known[1:] & known[:-1])
        pair = np.full(len(word), -1, np.int64)
        if not len(both):
            return known, base, logs, logs
        shard, mixed = spread(None, context[both], word[both], self.pairs.shards)
        one, pair[both] = groups_of(mixed, context[both], word[both])
        node, count, stored = self.pair_facts(shard[one], context[both][one], word[both][one])
        place, rest = pair[both], logs[both]
        logs[both] = np.where(np.isnan(stored[place]), rest, stored[place])
        at = np.flatnonzero(~starts[1:]) + 1
        at = at[pair[at - 1] >= 0]
        at = at[node[pair[at - 1]] >= 0]
        deep = logs.copy()
        deep[at] += np.log10(MU / (count + MU))[pair[at - 1]]
        at = at[known[at]]
        before = pair[at - 1]
        shard, mixed = spread(first[at], context[at], word[at], self.triples.shards)
        one, place = groups_of(mixed, before, word[at])
        stored = self.triple_scores(shard[one], node[before[one]], word[at][one])[place]
        deep[at] = np.where(np.isnan(stored), deep[at], stored)
        return known, base, logs, deep


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value's one of 256 equal steps from least to most, and the steps' means."""
    if not len(values):
        return np.zeros(1), np.zeros(0, np.uint8)
    least, most = values.min(), values.max()
    step = np.minimum((values - least) / max(most - least, 1e-9) * 256, 255).astype(np.uint8)
    n = np.bincount(step, minlength=256)
    return np.bincount(step, values, minlength=256) / np.maximum(n, 1), step


def level_arrays(contexts: np.ndarray, words: np.ndarray, logs: np.ndarray, kinds: int) -> dict[str, np.ndarray]:
    """A shard's arrays from distinct (context, word) in this order and their log10 probabilities."""
    new = np.ones(len(contexts), bool)
    new[1:] = contexts[1:] != contexts[:-1]
    followers = (np.cumsum(new) - 1).astype(np.uint64) * np.uint64(kinds) + words.astype(np.uint64)
    levels, level = quantise(logs)
    parts = {"context": contexts[new], "word": followers}
    arrays = {f"{name}_{k}": v for name, values in parts.items() for k, v in encode(values).items()}
    return arrays | {"levels": levels, "chance": level}


def level_two(keys: np.ndarray, counts: np.ndarray, trie: Trie) -> dict[str, np.ndarray]:
    """A shard's arrays from its distinct sorted pairs (context << 32 | word)."""
    contexts, words = (keys >> HALF).astype(np.int64), (keys & LOW).astype(np.int64)
    kinds, place = np.unique(words, return_inverse=True)
    chance = trie.word_chance(trie.counts_of(kinds))[place]
    nodes, place = np.unique(contexts, return_inverse=True)
    total = trie.counts_of(nodes)[place]
    arrays = level_arrays(contexts, words, np.log10((counts + MU * chance) / (total + MU)), trie.kinds)
    return arrays | {f"count_{k}": v for k, v in encode(np.concatenate([[0], np.cumsum(counts)])).items()}


def level_three(pairs: np.ndarray, words: np.ndarray, counts: np.ndarray, trie: Trie) -> dict[str, np.ndarray]:
    """A shard's arrays from its distinct triples (pair's first << 32 | second, word)."""
    facts = []
    for first, second, counted in ((pairs >> HALF, pairs & LOW, True), (pairs & LOW, words.astype(np.uint64), False)):
        shard, mixed = spread(None, first, second, trie.pairs.shards)
        one, place = groups_of(mixed, first, second)
        facts.append([x[place] for x in trie.pair_facts(shard[one], first[one], second[one], counted)])
    (node, total, _), (_, _, log) = facts
    # a node and a word order as one number where both fit
    order = np.argsort(node * trie.kinds + words) if (int(node.max()) + 1) * trie.kinds < 1 << 63 else np.lexsort((words, node))
    return level_arrays(node[order], words[order], np.log10((counts + MU * 10**log) / (total + MU))[order], trie.kinds)


def by_shard(batches, columns: list[str]):
    """(shard, arrays) for rows that arrive sorted by shard; nothing of a shard is held here while it is worked on."""
    now, parts = None, []

    def taken() -> list[np.ndarray]:
        found = [np.concatenate(x) for x in zip(*parts, strict=True)]
        parts.clear()
        return found

    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        edges = np.flatnonzero(np.diff(shards)) + 1
        for a, b in zip(np.concatenate([[0], edges]), np.append(edges, len(shards)), strict=True):
            if a == b:
                continue
            if now is not None and shards[a] != now:
                yield now, taken()
            now = int(shards[a])
            parts.append([v[a:b] for v in values])
    if now is not None:
        yield now, taken()


def packed(shard: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each shard with its part of the 32-bit columns, which stand in order of shard; equal bytes of their numbers side by side."""
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    planes = [(c >> np.uint32(8 * i)).astype(np.uint8).tobytes() for c in columns for i in range(4)]
    data = [b"".join([p[a:b] for p in planes]) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(shard)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts].astype(np.int32)), pa.array(data, pa.binary())], ["shard", "data"])


def unpacked(batches, columns: int):
    """(shard, columns) for rows of ``packed`` that arrive sorted by shard; nothing of a shard is held here while it is worked on."""
    now, parts = None, []

    def taken() -> list[np.ndarray]:
        planes = [np.concatenate([p[i] for p in parts]).astype(np.uint32) for i in range(4 * columns)]
        parts.clear()
        return [a | (b << np.uint32(8)) | (c << np.uint32(16)) | (d << np.uint32(24)) for a, b, c, d in zip(*(planes[i::4] for i in range(4)), strict=True)]

    for batch in batches:
        for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data"), strict=True):
            if now is not None and shard != now:
                yield now, taken()
            now = shard
            parts.append(np.frombuffer(data.as_buffer(), np.uint8).reshape(4 * columns, -1))
    if now is not None:
        yield now, taken()


def ids_of(batch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch's texts behind one another, and tokens per text."""
    column = batch.column("ids")
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    ids = np.frombuffer(data, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])).view(np.uint32) if data is not None else np.zeros(0, np.uint32)
    return ids, np.diff(offsets) // 4


def blocks(batches, end: np.uint32):
    """Up to ``ASKED`` ids of training texts, and those one and two places before them."""
    for batch in batches:
        ids, _ = ids_of(batch)
        padded = np.concatenate([np.full(2, end, np.uint32), ids])
        for a in range(0, len(ids), ASKED):
            b = min(a + ASKED, len(ids))
            yield padded[a + 2 : b + 2], padded[a + 1 : b + 1], padded[a:b]


def gathered(parts):
    """Tuples of arrays, joined until they have ``GATHERED`` entries."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= GATHERED:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held, n = [], 0
    if n:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def summed(mixed: np.ndarray, counts: np.ndarray | None, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct keys in an order by ``mixed``, and their counts; a key may come more than once (see ``alike``)."""
    order, first = alike(mixed, *keys)
    if counts is None:
        return order[first], np.diff(np.append(first, len(order)))
    return order[first], np.add.reduceat(counts[order], first)


def distinct(mixed: np.ndarray, asked: int) -> bool:
    """Whether keys that ``summed`` left of ``asked`` ones are certain to come once: no two share the bits it sorted by."""
    top = mixed >> np.uint64(max(1, (asked - 1).bit_length()))
    return bool((top[1:] != top[:-1]).all())


def train(rows: DataFrame) -> tuple[Trie, DataFrame]:
    """Build the trie from the texts (binary ``_text``) that are not ``held_out``; also the ``ids`` of all texts."""
    folder = scratch_path(rows.sparkSession, "lm")

    def count_words(batches):
        tokens = ((tokens_of(group)[0],) for batch in batches for group in chunks((x or b"" for x in batch.column("_text").to_pylist())))
        for (some,) in gathered(tokens):
            kinds, counts = np.unique(some, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(counts)], ["h", "c"])

    counts = rows.filter(~F.col("held_out")).select("_text").mapInArrow(count_words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    counts = stage_table(counts, "lm_words")
    kinds, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    if kinds > MOST_WORDS:
        raise ValueError(f"{kinds} different words: ids of this trie have 32 bits")
    shards = shard_count(kinds, WORDS_PER_SHARD)
    shift = 64 - (shards.bit_length() - 1)

    def write_words(batches):
        for shard, (h, c) in by_shard(batches, ["h", "c"]):
            arrays = {"hash": h.view(np.uint64), "count": c}
            _, starts, size = layout(arrays)
            row = {"shard": [shard], "file": [write_arrays(folder, arrays)], "n": [len(h)], "size": [size], "hash": [starts["hash"]], "count": [starts["count"]]}
            yield pa.RecordBatch.from_pydict(row)

    sharded = counts.withColumn("shard", F.shiftrightunsigned("h", shift))
    written = sharded.repartition(shards, "shard").sortWithinPartitions("shard", "h").mapInArrow(
        write_words, "shard long, file string, n long, size long, hash long, count long"
    )
    level_one = {r[0]: tuple(r[1:]) for r in stage_table(written, "lm_level1").collect()}  # a row per shard
    trie = Trie(folder, [level_one.get(s, ("", 0, 0, 0, 0)) for s in range(shards)], tokens)

    def number(batches):
        for batch in batches:
            at = 0
            for group in chunks((x or b"" for x in batch.column("_text").to_pylist())):
                hashes, sizes = tokens_of(group)
                offsets = np.concatenate([[0], np.cumsum(sizes * 4)]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(group), [None, pa.py_buffer(offsets), pa.py_buffer(trie.lookup(hashes))])
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("held_out"), ids], ["_id", "held_out", "ids"])
                at += len(group)

    # every training token is known, and every text is closed by the end token
    id_type = rows.schema["_id"].dataType.simpleString()
    numbered = stage_table(rows.select("_id", "held_out", "_text").mapInArrow(number, f"_id {id_type}, held_out boolean, ids binary"), "lm_ids")
    training = numbered.filter(~F.col("held_out")).select("ids")
    shards = shard_count(tokens, PAIRS_PER_SHARD)
    train_pairs(training, trie, shards)
    train_triples(training, trie, shards)
    return trie, numbered


def written(packs: DataFrame, name: str, parts: int, write) -> list[tuple]:
    """The manifest of the shards that ``write`` stores from packed rows."""
    dealt = packs.repartitionById(parts, F.col("shard") % parts).sortWithinPartitions("shard")
    return [tuple(r) for r in stage_table(dealt.mapInArrow(write, "shard long, file string, n long, places array<long>"), name).collect()]


def manifest(shard: int, folder: str, arrays: dict[str, np.ndarray], sequences: tuple[str, ...]) -> pa.RecordBatch:
    """Store a shard's arrays."""
    row = [shard], [write_arrays(folder, arrays)], [len(arrays["chance"])], [places(arrays, sequences)]
    return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1]), pa.array(row[2], pa.int64()), pa.array(row[3], pa.list_(pa.int64()))], ["shard", "file", "n", "places"])


def train_pairs(training: DataFrame, trie: Trie, shards: int) -> None:
    sequences = ("context", "word", "count")

    def count(batches):
        for shard, mixed, context, word in gathered((*spread(None, context, word, shards), context, word) for word, context, _ in blocks(batches, trie.end())):
            which, counts = summed(mixed, None, context, word)
            yield packed(shard[which], [context[which], word[which], counts.astype(np.uint32)])

    def write(batches):
        for shard, (context, word, c) in unpacked(batches, 3):
            keys = (context.astype(np.uint64) << HALF) | word
            order = np.argsort(keys)
            keys, c = keys[order], c[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            yield manifest(shard, trie.folder, level_two(keys[first], np.add.reduceat(c, first), trie), sequences)

    rows = written(training.mapInArrow(count, "shard int, data binary"), "lm_level2", shards, write)
    trie.pairs = Level(trie.folder, rows, shards, trie.kinds, sequences)


def train_triples(training: DataFrame, trie: Trie, shards: int) -> None:
    """Level 3, a range of shards after the other."""
    ranges = min(RANGES, shards, 1 << max(0, -(-trie.tokens // TRIPLES_PER_RANGE) - 1).bit_length())
    size = shards // ranges  # a power of two
    jvm = training.sparkSession.sparkContext._jvm

    def chosen(batches, part: int):
        end = trie.end()
        for word, context, first in blocks(batches, end):
            shard, mixed = spread(first, context, word, shards)
            which = np.flatnonzero((shard >> (size.bit_length() - 1) == part) & (context != end))
            yield shard[which], mixed[which], first[which], context[which], word[which]

    def count(batches, part: int):
        for shard, mixed, first, context, word in gathered(chosen(batches, part)):
            which, counts = summed(mixed, None, first, context, word)
            yield packed(shard[which], [first[which], context[which], word[which], counts.astype(np.uint32)])

    def write(batches):
        for shard, (first, context, word, c) in unpacked(batches, 4):
            c = c.astype(np.int64)
            mixed = spread(first, context, word, shards)[1] << SHARD_BITS
            which, c = summed(mixed, c, first, context, word)
            pair, word = (first[which].astype(np.uint64) << HALF) | context[which], word[which].astype(np.int64)
            if not distinct(mixed[which], len(mixed)):
                order = np.lexsort((word, pair))
                pair, word, c = pair[order], word[order], c[order]
                new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (word[1:] != word[:-1])]))
                pair, word, c = pair[new], word[new], np.add.reduceat(c, new)
            yield manifest(shard, trie.folder, level_three(pair, word, c, trie), ("context", "word"))

    rows = []
    for part in range(ranges):
        triples = training.mapInArrow(lambda batches, part=part: count(batches, part), "shard int, data binary")
        rows += written(triples, "lm_level3", max(16, size), write)
        del triples
        gc.collect()
        jvm.System.gc()  # the exchange goes when the driver no longer refers to it
    trie.triples = Level(trie.folder, rows, shards, trie.kinds, ("context", "word"))


def score(numbered: DataFrame, trie: Trie) -> DataFrame:
    """Scores of a table with ``_id``, ``held_out`` and the ``ids`` of ``train``."""
    names = ["n_tokens", "n_known", "base_score", "score", "score2"]
    id_type = numbered.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = trie.score(*ids_of(batch))
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("held_out"), *(pa.array(found[n]) for n in names)], ["_id", "held_out", *names])

    return numbered.mapInArrow(run, f"_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double, score2 double")


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("_text"))


def report(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and score all of them."""
    trie, numbered = train(rows_of(docs))
    return score(numbered, trie).select(
        F.col("_id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(trie.tokens).cast("long").alias("train_tokens"), "base_score", "score", "score2"
    )
