"""The best few rows of each of many queries, kept while rows come in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LAST = np.iinfo(np.int64).max


def sortable(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers, and which of them are null; these are sorted after all others."""
    return np.asarray(ids.fill_null(LAST)), np.asarray(ids.is_null())


class Best:
    """The `k` best (score, id) of every query: high scores first, equal ones by ascending id."""

    def __init__(self, k: int, floor: np.ndarray) -> None:
        """`floor` has, for each query, what a score must reach to matter; it rises to the k-th best of a query."""
        self.k, self.floor = k, floor
        self.of, self.score = np.empty(0, np.int64), np.empty(0, np.int64)
        self.id, self.null = np.empty(0, np.int64), np.empty(0, bool)

    def add(self, of: np.ndarray, score: np.ndarray, id: np.ndarray, null: np.ndarray) -> None:
        of, score = np.concatenate([self.of, of]), np.concatenate([self.score, score])
        id, null = np.concatenate([self.id, id]), np.concatenate([self.null, null])
        # ~score orders as -score does, and also exists for the least 64-bit number
        order = np.lexsort((id, null, ~score, of))
        rank = np.arange(len(of)) - np.searchsorted(of[order], of[order])
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.of, self.score, self.id, self.null = of[order], score[order], id[order], null[order]
        last = rank == self.k - 1
        self.floor[self.of[last]] = np.maximum(self.floor[self.of[last]], self.score[last])

    def ids(self) -> pa.Array:
        return pa.array(self.id, mask=self.null)
