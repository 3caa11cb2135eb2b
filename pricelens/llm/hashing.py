"""64-bit hashes of words, word runs and byte runs, vectorised over a batch of texts.

A run of bytes b_0..b_k hashes to the sum of (b_i + 1) * P^i modulo 2^64, mixed.
Prefix sums give the hash of any run without a loop in Python; P is odd, so its
powers have inverses. Different runs collide about as often as random 64-bit
numbers do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

P = 0x9E3779B97F4A7C15
P_INVERSE = pow(P, -1, 1 << 64)
WHITE = frozenset(b" \t\n\x0b\x0c\r")
CHUNK = 1 << 20
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits (the finaliser of a well-known public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i for i below n."""
    if "up" not in _tables or len(_tables["up"]) < n:
        for name, base in (("up", P), ("down", P_INVERSE)):
            steps = np.full(max(n, CHUNK), base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["up"][:n], _tables["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] for many runs."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the number of words of each text.

    Words are runs without ASCII white space, A-Z lower-cased.
    """
    data = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    is_white = np.zeros(256, bool)
    is_white[list(WHITE)] = True
    gap = np.concatenate([[True], is_white[data], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = run_hashes(prefix_sums(data), starts, ends)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words; fewer words are one shingle, none is none."""
    if len(words) == 0:
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total = total * np.uint64(P) + words[i : i + n]
    return mix(total)


def chunks(texts: Iterable[bytes], size: int = CHUNK) -> Iterator[list[bytes]]:
    """Whole texts in groups of about ``size`` bytes; a longer text is a group."""
    group, total = [], 0
    for text in texts:
        if group and total + len(text) > size:
            yield group
            group, total = [], 0
        group.append(text)
        total += len(text) + 1
    if group:
        yield group
