"""Elias-Fano sequences: monotone integers in about 2 + log2(universe / n) bits each.

The low ``bits`` of every value are packed; the rest is a bit vector in which value
i sets bit (value >> bits) + i. A directory of ones before each 64-bit word, and the
words of every 32nd one and every 32nd clear bit, make ``access`` and ``find``
(successor search by the high part, then over the few values that share it) work on
whole arrays of queries. ``Sequences`` looks up many sequences at once, so that a
look-up costs the same in however many the values are spread.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_BYTES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)
#: One or clear bits from one entry of a sample to the next, as a power of two.
SAMPLED = 5
PARTS = ("high", "ones", "zero_words", "one_words", "low")


def _places_in_byte() -> np.ndarray:
    """Place of the r-th set bit of a byte at r << 8 | byte."""
    places = np.zeros(8 << 8, np.int64)
    for byte in range(256):
        for r, place in enumerate(i for i in range(8) if byte >> i & 1):
            places[r << 8 | byte] = place
    return places


_PLACE = _places_in_byte()


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of the sequence; ``values`` must not decrease."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    bits = max(0, (top // max(n, 1)).bit_length() - 1)
    places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    words = (int(places[-1]) if n else 0) // 64 + 2
    high = np.zeros(words * 64, np.uint8)
    high[places] = 1
    high = np.packbits(high, bitorder="little").view(np.uint64)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high))])
    sampled = [
        np.minimum(np.searchsorted(before, np.arange(0, int(before[-1]) + (2 << SAMPLED), 1 << SAMPLED), side="right") - 1, words - 1).astype(np.uint32)
        for before in (np.arange(words + 1) * 64 - ones, ones)
    ]
    packed = np.zeros(-(-n * bits // 64) + 2, np.uint64)
    if n and bits:
        at = np.arange(n) * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        low = values & np.uint64((1 << bits) - 1)
        starts = -(-64 * np.arange(int(word[-1]) + 1) // bits)  # the first value that begins in each word
        packed[: len(starts)] = np.bitwise_or.reduceat(low << shift, starts)
        spill = np.flatnonzero(shift + np.uint64(bits) > np.uint64(64))
        packed[word[spill] + 1] |= low[spill] >> (np.uint64(64) - shift[spill])
    meta = np.array([n, bits, words], np.int64)
    return {"high": high, "ones": ones.astype(np.uint32 if n < 2**32 else np.uint64), "zero_words": sampled[0], "one_words": sampled[1], "low": packed, "meta": meta}


def _of(s, which: np.ndarray):
    """An array's entries, or a number that stands for all."""
    return s[which] if isinstance(s, np.ndarray) else s


class Sequences:
    """Sequences whose arrays begin at ``starts`` (a row each, as ``PARTS``) of the five arrays.

    Each query names its sequence, in an array ``s``; one number stands for all queries.
    """

    def __init__(self, arrays: list[np.ndarray], meta: np.ndarray, starts: np.ndarray):
        self.high, self.ones, self.zero_words, self.one_words, self.low = arrays
        self.n, self.bits, self.words = (np.ascontiguousarray(x) for x in meta.T)
        self.at = dict(zip(PARTS, (np.ascontiguousarray(x) for x in starts.T), strict=True))

    def _low(self, s, i: np.ndarray) -> np.ndarray:
        bits = self.bits[s]
        at = i * bits
        word, shift = self.at["low"][s] + (at >> 6), (at & 63).astype(np.uint64)
        ahead = (self.low[word + 1] << _ONE) << (np.uint64(63) - shift)
        return ((self.low[word] >> shift) | ahead) & ((_ONE << bits.astype(np.uint64)) - _ONE)

    def _select(self, s, rank: np.ndarray, clear: bool) -> np.ndarray:
        """Position of the rank-th (from 0) clear or set bit, which must be there."""
        name = "zero_words" if clear else "one_words"
        sample, at = getattr(self, name), self.at[name][s] + (rank >> SAMPLED)
        ones, high = self.at["ones"][s], self.at["high"][s]
        word, last = sample[at].astype(np.int64), sample[at + 1].astype(np.int64)

        def step(a, b, o, r):
            """Halve the words from a to b in which the bit may be."""
            middle = (a + b + 1) >> 1
            before = self.ones[o + middle].astype(np.int64)
            fits = (middle * 64 - before if clear else before) <= r
            return np.where(fits, middle, a), np.where(fits, b, middle - 1)

        word, last = step(word, last, ones, rank)
        open_ = np.flatnonzero(word < last)
        if len(open_):
            a, b, o, r = word[open_], last[open_], _of(ones, open_), rank[open_]
            while (a < b).any():
                a, b = step(a, np.maximum(a, b), o, r)
            word[open_] = a
        before = self.ones[ones + word].astype(np.int64)
        rest = (rank - (word * 64 - before if clear else before)).astype(np.uint64)
        value = self.high[high + word]
        if clear:
            value = ~value
        sums = value - ((value >> _ONE) & np.uint64(0x5555555555555555))
        sums = (sums & np.uint64(0x3333333333333333)) + ((sums >> np.uint64(2)) & np.uint64(0x3333333333333333))
        sums = ((sums + (sums >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _BYTES  # bits up to and with each byte
        byte = np.bitwise_count((((rest * _BYTES) | _TOPS) - sums) & _TOPS).astype(np.uint64) << np.uint64(3)
        rest -= ((sums << np.uint64(8)) >> byte) & np.uint64(255)
        found = _PLACE[((rest << np.uint64(8)) | ((value >> byte) & np.uint64(255))).astype(np.int64)]
        return word * 64 + byte.astype(np.int64) + found

    def _next(self, s, place: np.ndarray, rank: np.ndarray, clear: bool) -> np.ndarray:
        """Position of the rank-th clear or set bit, the first one from ``place`` on."""
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        at = self.at["high"][s] + word
        now, ahead = self.high[at], self.high[np.where(word + 1 < self.words[s], at + 1, at)]
        if clear:
            now, ahead = ~now, ~ahead
        value = (now >> shift) | ((ahead << _ONE) << (np.uint64(63) - shift))
        found = place + np.bitwise_count((value & (~value + _ONE)) - _ONE)
        far = np.flatnonzero((value == 0) | (found >> 6 >= self.words[s]))
        if len(far):
            found[far] = self._select(_of(s, far), rank[far], clear)
        return found

    def access(self, s, i: np.ndarray) -> np.ndarray:
        high = (self._select(s, i, False) - i).astype(np.uint64)
        return (high << self.bits[s].astype(np.uint64)) | self._low(s, i)

    def steps(self, s, i: np.ndarray) -> np.ndarray:
        """By how much value i + 1 is above value i."""
        place, bits = self._select(s, i, False), self.bits[s].astype(np.uint64)
        further = (self._next(s, place + 1, i + 1, False) - place - 1).astype(np.uint64)
        return (further << bits) + self._low(s, i + 1) - self._low(s, i)

    def find(self, s, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Position of each x within [first, last), or -1.

        Steps from the successor of x's high part to x's own successor.
        """
        found = np.full(len(x), -1, np.int64)
        part = x >> self.bits[s].astype(np.uint64)
        which = np.flatnonzero(part < (self.words[s] * 64 - self.n[s]).astype(np.uint64))
        if not len(which):
            return found
        s, h = _of(s, which), part[which].astype(np.int64)
        begin = np.where(h > 0, self._select(s, np.maximum(h - 1, 0), True) + 1, 0) - h
        end = self._next(s, begin + h, h, True) - h
        if first is not None:
            begin, end = np.maximum(begin, first[which]), np.minimum(end, last[which])
        low = x[which] & ((_ONE << self.bits[s].astype(np.uint64)) - _ONE)
        while True:
            open_ = np.flatnonzero(begin < end)
            which, s, begin, end, low = which[open_], _of(s, open_), begin[open_], end[open_], low[open_]
            if not len(which):
                return found
            middle = (begin + end) >> 1
            seen = self._low(s, middle)
            hit = seen == low
            found[which[hit]] = middle[hit]
            begin = np.where(seen < low, middle + 1, begin)
            end = np.where(hit, begin, np.where(seen > low, middle, end))


class EliasFano:
    """One sequence, from its arrays."""

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = ""):
        self.high, self.ones, self.low_words = (arrays[prefix + k] for k in ("high", "ones", "low"))
        meta = arrays[f"{prefix}meta"]
        self.n, self.bits = int(meta[0]), int(meta[1])
        self._only = Sequences([arrays[prefix + k] for k in PARTS], np.array([meta]), np.zeros((1, len(PARTS)), np.int64))

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return self._only.access(0, i)

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Position of each x within [first, last), or -1."""
        x = np.asarray(x, np.uint64)
        return self._only.find(0, x, first, last)
