"""Cosines of batches of vectors, and the best of them, inside a task."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Ship the search code with the tasks, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE = 256
SCORE_DIGITS = 9
ROUNDING = 2e-9  # more than rounding can move two scores against each other


def arrow_type(spark_type: str) -> pa.DataType:
    return pa.string() if spark_type == "string" else {"bigint": pa.int64(), "int": pa.int32()}[spark_type]


def unit_rows(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, and which rows have no direction (those are left zero)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = flat.astype(np.float64).reshape(-1, dim)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    blank = ~(np.isfinite(norms) & (norms > 0))
    norms[blank] = 1.0
    rows /= norms[:, None]
    rows[blank] = 0.0
    return rows, blank


class Best:
    """The k best candidates of each query seen so far, in order of score and then id, from given floors up."""

    def __init__(self, n_queries: int, k: int, floors: np.ndarray | None = None):
        self.k = k
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.ids = None
        self.floor = np.full(n_queries, -np.inf) if floors is None else floors.astype(np.float64)

    def add(self, queries, index, ids: np.ndarray) -> None:
        """Search one batch. Only scores that can still enter the best are rounded and kept."""
        (asked, no_query), (rows, no_row) = queries, index
        for start in range(0, len(asked), TILE):
            tile = slice(start, start + TILE)
            scores = asked[tile] @ rows.T
            if no_row.any():
                scores[:, no_row] = -np.inf
            if no_query[tile].any():
                scores[no_query[tile]] = -np.inf
            floor = self.floor[tile].copy()
            fresh = np.isneginf(floor)
            if fresh.any() and scores.shape[1] > self.k:
                place = scores.shape[1] - self.k
                floor[fresh] = np.partition(scores[fresh], place, axis=1)[:, place]
            row, col = np.nonzero(scores >= (floor - ROUNDING)[:, None])
            self._merge(row + start, np.round(scores[row, col], SCORE_DIGITS), ids[col], tile)

    def _merge(self, query, score, ids, tile) -> None:
        if not len(query):
            return
        stay = (self.query >= tile.start) & (self.query < tile.stop)
        query = np.concatenate([self.query[stay], query])
        score = np.concatenate([self.score[stay], score])
        ids = ids if self.ids is None else np.concatenate([self.ids[stay], ids])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.r_[True, query[1:] != query[:-1]]
        starts = np.flatnonzero(first)
        rank = np.arange(len(query)) - starts[np.cumsum(first) - 1]
        keep = rank < self.k
        full = rank == self.k - 1
        self.floor[query[full]] = score[full]
        rest = ~stay
        self.query = np.concatenate([self.query[rest], query[keep]])
        self.score = np.concatenate([self.score[rest], score[keep]])
        self.ids = ids[keep] if self.ids is None else np.concatenate([self.ids[rest], ids[keep]])

    def rows(self, query_ids: np.ndarray, id_type, query_type) -> pa.RecordBatch:
        none = self.ids is None
        return pa.RecordBatch.from_arrays(
            [
                pa.array([] if none else query_ids[self.query], type=query_type),
                pa.array([] if none else self.ids, type=id_type),
                pa.array(self.score, type=pa.float64(), mask=np.isneginf(self.score)),
            ],
            names=["query_id", "id", "score"],
        )
