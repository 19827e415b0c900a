"""Scoring texts by their maximum-scoring segments of token log-odds."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from zlib import crc32

import numpy as np

# Tokens are hashed to this many slots, so tables of them have one size for any corpus.
SLOTS = 1 << 18
# A word has three tokens: itself and its first 5 and 4 bytes.
LEVELS = 3
REMEMBERED = 300_000
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_APART = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, lower-cased and without ASCII punctuation, in order."""
    return (text or "").lower().encode("utf-8", "replace").translate(_APART).split()


def slots(word: bytes) -> tuple[int, int, int]:
    """Slots of a word's tokens, numbered through all levels."""
    least = SLOTS - 1
    return crc32(word) & least, SLOTS + (crc32(b"5" + word[:5]) & least), 2 * SLOTS + (crc32(b"4" + word[:4]) & least)


class Remember(dict):
    """A function of words, remembered in two generations of ``REMEMBERED`` words."""

    def __init__(self, function: Callable[[bytes], object]):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, word: bytes) -> object:
        value = self.older[word] if word in self.older else self.function(word)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, sum), first to last, by the linear-time scan.

    Neighbouring scores of one sign act as one, so the scan only visits runs of
    positive scores.
    """
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    breaks = np.flatnonzero(np.diff(up) > 1)
    firsts, lasts = up[np.concatenate(([0], breaks + 1))], up[np.concatenate((breaks, [len(up) - 1]))]
    # Each kept segment: (first, last, sum before it, sum up to its end).
    kept: list[tuple[int, int, float, float]] = []
    # under[i]: the nearest earlier segment whose left sum is smaller.
    under: list[int] = []
    for first, last in zip(firsts.tolist(), lasts.tolist(), strict=True):
        left, right = float(total[first]), float(total[last + 1])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = under[j]
            if j < 0 or kept[j][3] >= right:
                kept.append((first, last, left, right))
                under.append(j)
                break
            first, left = kept[j][0], kept[j][2]
            del kept[j:], under[j:]
    return [(first, last, right - left) for first, last, left, right in kept]


def log_odds(marked: np.ndarray, plain: np.ndarray, strength: float, certain: float) -> np.ndarray:
    """Log-odds ratio of each slot between two sets of counts, moved ``certain`` deviations towards 0.

    The Dirichlet prior is dealt like the counts of both sets together and
    weighs ``strength`` times as much as they do.
    """
    both = marked + plain
    alpha = (both + 1.0) * (strength * both.sum() / (both.sum() + len(both)))
    a, b = marked + alpha, plain + alpha
    ratio = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    margin = certain * np.sqrt(1 / a + 1 / b)
    return np.where(ratio > 0, np.maximum(ratio - margin, 0.0), np.minimum(ratio + margin, 0.0))


def gumbel_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(weights * exp(rate * scores)) = 1 for a negative mean; 1 if there is none."""
    share = weights / max(weights.sum(), 1e-12)
    if not (scores[share > 0] > 0).any() or float(share @ scores) >= 0:
        return 1.0
    low, high = 0.0, 1.0
    grow = lambda rate: float(share @ np.exp(np.minimum(rate * scores, 600))) - 1
    while grow(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grow(middle) < 0 else (low, middle)
    return max(high, 1e-6)


def fit_logistic(x: Sequence[float], ones: Sequence[float], zeros: Sequence[float], rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve through counts of ones and zeros at ``x``, ridge added."""
    x, ones, zeros = (np.asarray(v, float) for v in (x, ones, zeros))
    design = np.stack([x, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        n = ones + zeros
        slope = design.T @ (ones - n * p) - 1e-3 * beta
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


class SegmentModel:
    """Token scores with the constants that turn sums of segments into a chance."""

    def __init__(
        self, scores: np.ndarray, drift: float, rate: float = 1.0, log_k: float = 0.0, slope: float = 1.0, offset: float = 0.0
    ):
        self.scores, self.drift = scores.astype(np.float32), drift
        self.rate, self.log_k, self.slope, self.offset = rate, log_k, slope, offset
        self._known: Remember | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": None}

    def word_score(self, word: bytes) -> float:
        """The strongest sign of its tokens if one speaks for the label, else that of the whole word."""
        each = self.scores[list(slots(word))]
        return float(each.max() if each.max() > 0 else each[0]) - self.drift

    def word_scores(self, text: str | None) -> np.ndarray:
        if self._known is None:
            self._known = Remember(self.word_score)
        words = words_of(text)
        return np.fromiter(map(self._known.__getitem__, words), np.float64, len(words))

    def evidence(self, total: float, length: int) -> float:
        """Minus the log of how many such segments a plain text of this length has by chance."""
        return self.rate * total - self.log_k - math.log(max(length, 1))

    def overall(self, sums: Sequence[float], length: int) -> float:
        """Evidence of a text: of its segments beyond chance together, else of the best one (none: of a sum of 0)."""
        each = [self.evidence(s, length) for s in sums]
        return sum(e for e in each if e > 0) or max(each, default=self.evidence(0.0, length))

    def passages(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """Evidence of the whole text and (first word, last word, sum, evidence) per segment."""
        scores = self.word_scores(text)
        found = segments(scores)
        each = [(a, b, s, self.evidence(s, len(scores))) for a, b, s in found]
        return self.overall([s for _, _, s in found], len(scores)), each

    def chance(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, self.slope * evidence + self.offset))))
