"""Fast similarity sketching: one pass of hashed bin placement per round, until no bin is empty.

In round i every element goes to one hashed bin with a value in [i, i + 1); from round t on, all
elements compete for bin i - t. A bin keeps its smallest value. So rounds end once all bins are
filled, after 2 t rounds at the latest, and equal bins estimate the Jaccard similarity with the
concentration of t independent draws. A set of n elements costs about n + t log t steps.
"""

from __future__ import annotations

import numpy as np

from merchlake.llm.common import ODD, mix

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def sketch(elements: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """Sketches, one row per set; ``elements`` holds the sets' hashes one set after the other.

    Rows of empty sets hold EMPTY throughout.
    """
    count = len(sizes)
    table = np.full(count * bins, EMPTY, np.uint64)
    by_set = table.reshape(count, bins)
    owner = np.repeat(np.arange(count, dtype=np.int64), sizes)
    values, live = elements, np.flatnonzero(sizes)
    i = 0
    while len(live) and i < 2 * bins:
        # Small leftovers take many rounds; these are done together. A bin still keeps the value of
        # the earliest round, which stands in the upper half.
        rounds = np.arange(i, min(i + max(1, 8192 // len(values)), bins if i < bins else 2 * bins), dtype=np.uint64)[:, None]
        h = mix(values[None, :] + (rounds + np.uint64(1)) * ODD)
        if i < bins:
            place = ((h >> _HALF) * np.uint64(bins) >> _HALF).astype(np.int64)
        else:
            place = rounds.astype(np.int64) - bins
        np.minimum.at(table, (owner[None, :] * bins + place).ravel(), ((h & _LOW) | (rounds << _HALF)).ravel())
        full = (by_set[live] != EMPTY).all(axis=1)
        if full.any():
            done = np.zeros(count, bool)
            done[live[full]] = True
            left = ~done[owner]
            values, owner, live = values[left], owner[left], live[~full]
        i += len(rounds)
    return by_set


def bands(table: np.ndarray, rows: int) -> np.ndarray:
    """Hash of each band of ``rows`` bins, with the band's number in it; int64."""
    count, bins = table.shape
    parts = table.reshape(count, bins // rows, rows)
    h = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64) * ODD, parts.shape[:2]).copy()
    for k in range(rows):
        h = mix(h ^ parts[:, :, k])
    return h.view(np.int64)


def short(table: np.ndarray) -> np.ndarray:
    """One byte per bin, enough to estimate similarity."""
    return (mix(table) >> np.uint64(56)).astype(np.uint8)


def estimate(equal: np.ndarray | float) -> np.ndarray | float:
    """Similarity from the share of equal bytes, without the 1 in 256 that agree by chance."""
    return (equal - 1 / 256) / (1 - 1 / 256)


def cut(threshold: float, bins: int, deviations: float = 4.0) -> float:
    """Estimates below this belong to pairs under the threshold, up to that many deviations."""
    return threshold - deviations * (threshold * (1 - threshold) / bins) ** 0.5
