"""Sparse 0/1 matrices in compressed rows, and their products row by row."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Entries of the left matrix that one step of a product takes.
STEP = 1 << 20


class Csr(NamedTuple):
    """Row i has ones in the columns ``indices[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    indices: np.ndarray
    n_columns: int


def covering(sizes: np.ndarray) -> Csr:
    """Tokens by bytes: the tokens lie one after the other and cover ``sizes`` bytes each."""
    starts = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return Csr(starts, np.arange(starts[-1]), int(starts[-1]))


def members(group: np.ndarray, n_groups: int) -> Csr:
    """Tokens by groups: each token is in one group."""
    return Csr(np.arange(len(group) + 1), group.astype(np.int64), n_groups)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    counts = np.bincount(m.indices, minlength=m.n_columns)
    return Csr(np.append(0, np.cumsum(counts)), rows[np.argsort(m.indices, kind="stable")], len(m.starts) - 1)


def products(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of ``left`` times ``right``, by rows.

    A row of the product is the sum of those rows of ``right`` that the row of ``left`` names. A step
    takes whole rows with about STEP entries; what it adds up is sorted by column within its row.
    """
    n_rows = len(left.starts) - 1
    first = 0
    while first < n_rows:
        last = int(np.searchsorted(left.starts, left.starts[first] + STEP, side="right")) - 1
        last = min(max(last, first + 1), n_rows)
        named = left.indices[left.starts[first] : left.starts[last]]
        of = np.repeat(np.arange(first, last), np.diff(left.starts[first : last + 1]))
        size = right.starts[named + 1] - right.starts[named]
        ends = np.cumsum(size)
        at = np.repeat(right.starts[named] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        key = np.repeat(of - first, size) * np.int64(right.n_columns) + right.indices[at]
        key, value = np.unique(key, return_counts=True)
        yield first + key // max(right.n_columns, 1), key % max(right.n_columns, 1), value
        first = last


def row_sums(left: Csr, right: Csr) -> np.ndarray:
    """Sums of the rows of ``left`` times ``right``: the product with a vector of ones, taken from the right."""
    size = np.diff(right.starts)[left.indices]
    return np.diff(np.append(0, np.cumsum(size))[left.starts])
