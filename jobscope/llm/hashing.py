"""Vectorised 64-bit hashing of byte texts (numpy, inside Spark tasks).

A substring's hash is a polynomial over random 64-bit byte codes modulo 2**64,
read off prefix sums, so all windows of a text cost a few array operations;
``mix64`` finishes it. The codes come from a fixed seed: every task agrees.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (kept, at most 4M entries; longer texts build their own)."""
    have = _POWERS.get("p")
    if have is not None and len(have[0]) >= n:
        return have[0][:n], have[1][:n]
    size = max(1 << 16, 1 << int(n).bit_length())
    out = []
    for base in (BASE, INVERSE):
        p = np.empty(size, np.uint64)
        p[0], k = 1, 1
        while k < size:
            p[k:2 * k] = p[:k] * np.uint64(pow(base, k, 2**64))
            k *= 2
        out.append(p)
    if size <= 1 << 22:
        _POWERS["p"] = tuple(out)
    return out[0][:n], out[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Prefix sums of one byte text; ``hashes(starts, ends)`` gives substring hashes."""

    def __init__(self, data: bytes):
        a = np.frombuffer(data, np.uint8)
        pow_, self.inv = _powers(len(a) + 1)
        self.sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(CODES[a] * pow_[:len(a)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inv[starts]
        return mix64(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles of an A-Z lower-cased text.

    Fewer words give the whole sequence as the one shingle, no words an empty array.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    p = Prefix(b" ".join(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(words, len(parts))
    return np.unique(p.hashes(starts[:len(parts) - k + 1], ends[k - 1:]))
