"""Word shingles as sets of 64-bit fingerprints, and their MinHash signatures."""

from __future__ import annotations

import math

import numpy as np
import xxhash

WIDTH = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_CHUNK = 2048


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of UTF-8 text, A-Z lower-cased; only the six ASCII blanks part them."""
    return (raw or b"").lower().split()


def word_marks(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _combined(marks: np.ndarray, width: int) -> np.ndarray:
    n = len(marks) - width + 1
    x = np.full(n, width, np.uint64)
    for i in range(width):
        x = (x ^ marks[i:i + n]) * _STEP
        x ^= x >> np.uint64(29)
    x *= _MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(marks: np.ndarray) -> np.ndarray:
    """Sorted distinct fingerprints of all runs of 5 words; of all words if there are fewer."""
    if not len(marks):
        return np.zeros(0, np.uint64)
    return np.unique(_combined(marks, min(WIDTH, len(marks))))


class MinHash:
    """Signatures of ``bands * rows`` minima under fixed hash functions, and their bands."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, size = bands, rows, bands * rows
        self.a = (rng.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, size, dtype=np.uint32)[:, None]

    def signatures(self, items: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of 32-bit minima per group of ``items``; groups begin at ``starts`` and none is empty."""
        x = items.astype(np.uint32)
        out = np.full((len(starts), len(self.a)), np.iinfo(np.uint32).max, np.uint32)
        for begin in range(0, len(x), _CHUNK):
            some = x[None, begin:begin + _CHUNK] * self.a
            some += self.b
            # Groups that reach into this chunk; the first may have begun before it.
            first = int(np.searchsorted(starts, begin, "right")) - 1
            last = int(np.searchsorted(starts, begin + some.shape[1]))
            cuts = np.maximum(starts[first:last] - begin, 0)
            out[first:last] = np.minimum(out[first:last], np.minimum.reduceat(some, cuts, axis=1).T)
        return out

    def buckets(self, signatures: np.ndarray) -> np.ndarray:
        """One signed 64-bit key per row and band."""
        parts = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        x = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), parts.shape[:2]) * _MIX
        for i in range(self.rows):
            x = (x ^ parts[:, :, i]) * _STEP
            x ^= x >> np.uint64(29)
        x *= _MIX
        return (x ^ (x >> np.uint64(32))).view(np.int64)


def posterior_bounds(size: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on) per batch.

    With all similarities equally likely beforehand, a pair with k matches of n
    is at least ``threshold`` alike with the chance that a binomial draw of n + 1
    at ``threshold`` has k at most; below ``miss`` the pair is given up.
    """
    out = []
    for n in range(batch, size + 1, batch):
        total, k = 0.0, -1
        while total < miss and k < n:
            k += 1
            total += math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
        out.append((n, k))
    return out


def likely(
    left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]], one: np.ndarray | None = None, other: np.ndarray | None = None
) -> np.ndarray:
    """Pairs of rows of two signature matrices that no batch gives up, as indexes: row by row, or rows ``one`` and ``other``."""
    if one is None or other is None:
        one = other = np.arange(len(left))
    alive, matches, done = np.arange(len(one)), np.zeros(len(one), np.int64), 0
    for n, fewest in bounds:
        if not len(alive):
            break
        matches = matches + (left[one[alive], done:n] == right[other[alive], done:n]).sum(1)
        stays = matches >= fewest
        alive, matches, done = alive[stays], matches[stays], n
    return alive
