"""Exact top-k inner products: pivot-table elimination.

Every row stores its Euclidean distances to ``pivots`` vectors.  For a query q
and a row x the triangle inequality gives a lower bound of their distance at
each pivot, |d(q, p) - d(x, p)|; the greatest of them bounds the inner product
from above: q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2.  Clusters whose least
distances rule them out are not visited at all (:mod:`.vectors`); within a
block the same bound rules out groups of rows that can't reach the k-th score
found so far (ties are scored, as the lesser id wins), and the other groups are
scored exactly.  Bounds are widened by more than the rounding of distances,
then rounded down to integers, so the result is exact.

Where the bounds rule out little, as with directions at random, the exact
search takes all pairs of a query and a row: its time grows as their number,
a few nanoseconds each, and a task holds one block and some queries whatever
the table's size.

The pivots are fitted on a sample of ``sample`` rows; every row is indexed, and
no row is left out by anything but its bound.  Rows that take no part and rows
that share an id: see :mod:`.vectors`.  Fewer than k candidates: all of them.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V

SLACK = 1e-6   # of the squared norms; rounding stays below a hundredth of it


def distances(v: np.ndarray, norm: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = norm[:, None] ** 2 + (pivots ** 2).sum(axis=1) - 2 * (v @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def _upper(q_norm, x_norm, least):
    both = q_norm ** 2 + x_norm ** 2
    return np.floor((both - least ** 2) / 2 + SLACK * (both + 1))


def cluster_bounds(q: V.Rows, c: V.Clusters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    to = q.to[:, None, :]
    least = np.maximum(np.maximum(c.low - to, to - c.high), 0).max(axis=2, initial=0)
    high = _upper(q.norm[:, None], c.max_norm, least)
    return np.full(high.shape, -np.inf), high, np.ones(high.shape, bool)


def _match(k: int):
    def match(block: V.Rows, groups: V.Clusters, q: V.Rows):
        score = V.scores(block, groups, q, cluster_bounds)
        query, row = V.highest(score, q.lo[:, 0], q.hi[:, 0], block.ids, k)
        return query, np.zeros(len(query), np.int64), block.ids[row], score[query, row].astype(np.int64)
    return match


def top_k(rows: DataFrame, queries: Column, k: int = 20, scale: int = 64, vector: str = "embedding", pivots: int = 32,
          sample: int = 4096, block: int = 1024, probe: int = 4) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row where ``queries`` (of vec_id) holds its ``k`` highest scores.

    Vectors are the components times ``scale``, rounded down; a score is their
    inner product; a query's own row is no candidate.
    """
    known = V.integers(rows, scale, vector)
    index = V.build(known, V.references(known, pivots, sample, unit=False), distances, block)
    asks = index.rows.where(queries).drop("blk").select("*", *V.windows((F.lit(V.LEAST), F.lit(V.MOST))))
    found = V.search(index, asks, k, _match(k), cluster_bounds, probe)
    return found.select("query_id", "rank", "vec_id", "score")
