"""Suffix order with common prefixes by induced sorting over disk-backed queues.

Bytes are shifted up by one; 0 ends every piece. Leftmost S-suffixes are ordered
first: the substrings between them get names by rank, and the string of names is
sorted by doubling until ``depth`` symbols are covered. All other suffixes follow by induction: one
queue per byte value holds (suffix, common prefix with the one before) in arrival
order, which is their sorted order; a queue is read in batches, and each batch
appends its predecessors to the queues of their first bytes. A common prefix is one
more than the least one passed since the queue's last arrival. Queues beyond
``MEMORY`` bytes are kept in a temporary file that is removed with them.
"""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

MEMORY = 64 << 20
BATCH = 1 << 18


class Queues:
    """Arrival-ordered queues of (position, prefix), spilled to one temporary file."""

    def __init__(self, n: int, memory: int = MEMORY):
        self.parts: list[deque] = [deque() for _ in range(n)]
        self.held, self.memory, self.file = 0, memory, None

    def add(self, queue: int, at: np.ndarray, prefix: np.ndarray) -> None:
        if not len(at):
            return
        if self.held + 9 * len(at) > self.memory:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            place = self.file.tell()
            self.file.write(at.astype(np.int64).tobytes() + prefix.astype(np.uint8).tobytes())
            self.parts[queue].append((place, len(at)))
        else:
            self.held += 9 * len(at)
            self.parts[queue].append((at.astype(np.int64), prefix.astype(np.uint8)))

    def take(self, queue: int, last: bool = False):
        """The next (or last) entries of a queue, about ``BATCH`` of them, or None."""
        taken, size = [], 0
        while self.parts[queue] and size < BATCH:
            a, b = self.parts[queue].pop() if last else self.parts[queue].popleft()
            if isinstance(b, int):
                self.file.seek(a)
                raw = self.file.read(9 * b)
                a, b = np.frombuffer(raw[: 8 * b], np.int64), np.frombuffer(raw[8 * b :], np.uint8)
            else:
                self.held -= 9 * len(a)
            taken.append((a, b))
            size += len(a)
        if not taken:
            return None
        at, prefix = zip(*(taken[::-1] if last else taken), strict=True)
        return np.concatenate(at), np.concatenate(prefix)

    def close(self) -> None:
        if self.file:
            self.file.close()


class Carry:
    """Least common prefix passed since each queue's last arrival."""

    def __init__(self, n: int, depth: int):
        self.least, self.depth = np.full(n, 0, np.int64), depth
        self.fresh = np.ones(n, bool)

    def arrivals(self, target: np.ndarray, sends: np.ndarray, passed: np.ndarray) -> np.ndarray:
        """Prefixes, with the arrival before, of the batch members that are sent on.

        ``passed[j]`` is member j's common prefix with the member before it in
        sorted order; ``sends`` are the members sent, ``target`` their queues.
        """
        table = [passed.astype(np.uint8)]
        while (1 << len(table)) <= len(passed):
            step = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:  # over passed[a..b], a <= b
            level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
            out = np.empty(len(a), np.int64)
            for k in np.unique(level):
                w = level == k
                out[w] = np.minimum(table[k][a[w]], table[k][b[w] - (1 << k) + 1])
            return out

        order = np.argsort(target, kind="stable")
        t, s = target[order], sends[order]
        first = np.concatenate([[True], t[1:] != t[:-1]])
        since = np.where(first, 0, np.concatenate([[0], s[:-1] + 1]))
        low = least(since, s)
        low = np.where(first, np.minimum(low, self.least[t]), low)
        low = np.where(first & self.fresh[t], -1, low)
        whole = int(passed.min())
        self.least = np.minimum(self.least, whole)
        last = np.concatenate([t[1:] != t[:-1], [True]])
        ends, queues = s[last], t[last]
        tail = np.full(len(ends), self.depth, np.int64)
        more = ends + 1 < len(passed)
        tail[more] = least(ends[more] + 1, np.full(more.sum(), len(passed) - 1))
        self.least[queues], self.fresh[queues] = tail, False
        return order, np.minimum(low + 1, self.depth)

    def passed_by(self, passed: np.ndarray) -> None:
        if len(passed):
            self.least = np.minimum(self.least, int(passed.min()))


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S)."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    step[-1] = -1
    known = np.where(step != 0, np.arange(n), n - 1)
    nearest = np.minimum.accumulate(known[::-1])[::-1]
    return step[nearest] > 0


def words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The seven symbols from each position as one big-endian number; 0 beyond the end."""
    out = np.zeros(len(at), np.uint64)
    for k in range(7):  # symbols of nine bits
        out = (out << np.uint64(9)) | text[np.minimum(at + k, len(text) - 1)].astype(np.uint64)
    return out


def substring_names(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks, from 1, of the substrings from each leftmost S-suffix to the next.

    Where one substring starts another, the longer goes first, as its type there is
    L: symbols beyond an end count as more than any other.
    """
    length = np.append(np.diff(at) + 1, len(text) - at[-1])

    def key(which: np.ndarray, offset: int) -> np.ndarray:
        beyond = np.clip(7 - (length[which] - offset), 0, 7).astype(np.uint64) * np.uint64(9)
        return words_at(text, at[which] + offset) | ((np.uint64(1) << beyond) - np.uint64(1))

    first = key(np.arange(len(at)), 0)
    order = np.argsort(first, kind="stable")
    change = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    offset = 7
    while True:
        group = np.cumsum(change)
        size = np.bincount(group)
        open_ = np.flatnonzero((size[group] > 1) & (length[order] > offset))
        if not len(open_):
            break
        again = np.zeros(len(size), bool)
        again[group[open_]] = True
        open_ = np.flatnonzero(again[group])
        value = key(order[open_], offset)
        inner = np.lexsort((value, group[open_]))
        order[open_], value, own = order[open_][inner], value[inner], group[open_][inner]
        change[open_] = np.concatenate([[True], (value[1:] != value[:-1]) | (own[1:] != own[:-1])])
        offset += 7
    names = np.empty(len(at), np.int64)
    names[order] = np.cumsum(change)
    return names


def order_leftmost(text: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Leftmost S-suffixes sorted to ``depth`` symbols, and prefixes with the one before.

    Names of substrings are doubled; any two starts are two symbols apart or more.
    """
    if not len(at):
        return at, np.zeros(0, np.int64)
    levels = [substring_names(text, at)]
    while (1 << len(levels)) < depth and levels[-1].max() < len(at):
        step, rank = 1 << (len(levels) - 1), levels[-1]
        later = np.concatenate([rank[step:], np.zeros(min(step, len(rank)), np.int64)])[: len(rank)]
        levels.append(np.unique(rank * (len(at) + 1) + later, return_inverse=True)[1] + 1)
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    start = at[a]
    ends = np.append(at, len(text))
    for k in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[k], 0)
        same = (rank[np.minimum(a, len(at))] == rank[np.minimum(b, len(at))]) & (np.maximum(a, b) < len(at))
        a, b = np.minimum(a + (same << k), len(at)), np.minimum(b + (same << k), len(at))
    known = np.minimum(ends[a] - start, depth)
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = known
    open_ = np.flatnonzero((known < depth) & (ends[a] < len(text)) & (ends[b] < len(text)))
    lcp[1 + open_] += fast_common_prefix(text, ends[a[open_]], ends[b[open_]], depth)
    return at[order], np.minimum(lcp, depth)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of suffix pairs, up to ``depth``."""
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    n = len(text)
    while len(open_):
        k = out[open_]
        x, y = a[open_] + k, b[open_] + k
        inside = (x < n) & (y < n) & (k < depth)
        same = np.zeros(len(open_), bool)
        same[inside] = text[x[inside]] == text[y[inside]]
        open_ = open_[same]
        out[open_] += 1
    return out


def fast_common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """As ``common_prefix``, seven symbols at a time."""
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    while len(open_):
        k = out[open_]
        x, y = np.minimum(a[open_] + k, len(text) - 1), np.minimum(b[open_] + k, len(text) - 1)
        same = (words_at(text, x) == words_at(text, y)) & (k < depth)
        open_ = open_[same]
        out[open_] += 7
    rest = np.flatnonzero(out < depth)
    out[rest] += common_prefix(text, np.minimum(a[rest] + out[rest], len(text)), np.minimum(b[rest] + out[rest], len(text)), 7)
    return np.minimum(out, depth)


def sorted_suffixes(text: np.ndarray, depth: int, memory: int = MEMORY):
    """Batches (positions, prefixes) of all suffixes in descending order, to ``depth`` symbols.

    ``text`` is uint16 and ends with 0. A suffix's prefix is the one it shares with
    the suffix before it in this order.
    """
    n, symbols = len(text), 257
    is_s = suffix_types(text)
    leftmost = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    leftmost, lcp = order_leftmost(text, leftmost, depth)
    seeds = Queues(symbols, memory)
    first = text[leftmost].astype(np.int64)
    cuts = np.searchsorted(first, np.arange(symbols + 1))
    for c in range(symbols):
        for a in range(cuts[c], cuts[c + 1], BATCH):
            b = min(a + BATCH, cuts[c + 1])
            seeds.add(c, leftmost[a:b], lcp[a:b])

    large, done, carry = Queues(symbols, memory), Queues(symbols, memory), Carry(symbols, depth)
    large.add(int(text[-1]), np.array([n - 1]), np.zeros(1, np.uint8))
    carry.fresh[text[-1]], carry.least[text[-1]] = False, depth
    for c in range(symbols):
        edge = -1  # the last large suffix of this byte
        while (batch := large.take(c)) is not None:
            at, prefix = batch
            done.add(c, at, prefix)
            edge = int(at[-1])
            _send(text, is_s, at, prefix, large, carry, want_s=False)
        while (batch := seeds.take(c)) is not None:
            at, prefix = batch
            if edge >= 0:
                prefix = prefix.copy()
                prefix[0] = fast_common_prefix(text, np.array([edge]), at[:1], depth)[0]
                edge = -1
            _send(text, is_s, at, prefix, large, carry, want_s=False)
    large.close()
    seeds.close()

    small, carry = Queues(symbols, memory), Carry(symbols, depth)
    for c in range(symbols - 1, -1, -1):
        edge, gap = -1, 0  # the last small suffix of this byte
        while (batch := small.take(c)) is not None:
            at, prefix = batch
            edge = int(at[-1])
            _send(text, is_s, at, prefix, small, carry, want_s=True)
            yield at, prefix
        while (batch := done.take(c, last=True)) is not None:
            at, prefix = batch[0][::-1], np.empty_like(batch[1])
            if edge >= 0:
                gap, edge = fast_common_prefix(text, np.array([edge]), at[:1], depth)[0], -1
            prefix[0], prefix[1:] = gap, batch[1][::-1][:-1]
            gap = batch[1][0]
            _send(text, is_s, at, prefix, small, carry, want_s=True)
            yield at, prefix
    small.close()
    done.close()


def _send(text, is_s, at, passed, queues: Queues, carry: Carry, want_s: bool) -> None:
    """Append the predecessors of the wanted kind to their queues."""
    passed = passed.astype(np.int64)
    before = at - 1
    good = np.flatnonzero(at > 0)
    good = good[is_s[before[good]] == want_s]
    if not len(good):
        carry.passed_by(passed)
        return
    target = text[before[good]].astype(np.int64)
    order, prefix = carry.arrivals(target, good, passed)
    moved, owner = before[good][order], target[order]
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        queues.add(int(owner[a]), moved[a:b], np.maximum(prefix[a:b], 0).astype(np.uint8))
