"""Hard negatives: angular triangle filtering.

Every row stores its angles to ``directions`` reference directions and its
norm.  For an anchor and a row the angles a and x to one direction bound the
angle between them, |a - x| <= angle <= min(a + x, 2 pi - a - x); the tightest
bounds over all directions, through the cosine and times both norms, bound
their inner product.  Bounds are widened by more than the rounding of angles
and rounded outward to integers.

Two searches use them (:mod:`.vectors`), on clusters and on groups of near
rows.  Positives: the ``positives`` highest other rows of the anchor's label;
only groups whose bounds reach the best scores so far are scored.  Negatives:
for each positive of score p, the rows of other labels with low * p <= 100 *
score <= high * p; only groups whose bounds overlap one of the anchor's windows
are scored, and once a window has its ``negatives`` rows it narrows to their
scores.  Both are exact.

A positive of score below zero has an empty window, one of zero the window
[0, 0].  Anchors without positives, and positives without negatives, give no
rows.  Zero vectors stand at a right angle to every direction.  The directions
are fitted on a sample of ``sample`` rows; every row is indexed.  Rows that take
no part and rows that share an id: see :mod:`.vectors`.  An empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V

SLACK = 1e-6   # of the product of norms; the rounding of angles stays below a tenth of it


def angles(v: np.ndarray, norm: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(v @ directions.T / np.where(norm > 0, norm, 1)[:, None], -1, 1))


def _scores(near, far, least_norm, most_norm):
    """Integer bounds of the inner product: angle within [near, far], product of norms within [least, most]."""
    high, low = np.cos(np.clip(near, 0, np.pi)), np.cos(np.clip(far, 0, np.pi))
    slack = SLACK * (most_norm + 1)
    return (np.ceil(np.where(low >= 0, low * least_norm, low * most_norm) - slack),
            np.floor(np.where(high >= 0, high * most_norm, high * least_norm) + slack))


def row_bounds(q: V.Rows, block: V.Rows) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of single rows: of groups of one."""
    return _group_bounds(q, block.to, block.to, block.norm, block.norm)


def _group_bounds(q: V.Rows, low, high, min_norm, max_norm) -> tuple[np.ndarray, np.ndarray]:
    a = q.to[:, None, :]
    near = np.maximum(np.maximum(low - a, a - high), 0).max(axis=2, initial=0)
    far = np.minimum(high + a, 2 * np.pi - low - a).min(axis=2, initial=np.pi)
    return _scores(near, far, q.norm[:, None] * min_norm, q.norm[:, None] * max_norm)


def _cluster_bounds(same: bool):
    def bounds(q: V.Rows, c: V.Clusters):
        low, high = _group_bounds(q, c.low, c.high, c.min_norm, c.max_norm)
        label = q.labels[:, None]
        may = ((c.min_label <= label) & (label <= c.max_label)) if same else (
            (c.min_label != label) | (c.max_label != label))
        return low, high, may
    return bounds


def _match(k: int, same: bool):
    def match(block: V.Rows, groups: V.Clusters, q: V.Rows):
        score = V.scores(block, groups, q, _cluster_bounds(same))
        score[(q.labels[:, None] == block.labels) != same] = V.below(score.dtype)
        out = []
        for j in range(q.lo.shape[1]):
            query, row = V.highest(score, q.lo[:, j], q.hi[:, j], block.ids, k)
            out.append((query, np.full(len(query), j), block.ids[row], score[query, row].astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out))
    return match


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, vector: str = "embedding", label: str = "label", directions: int = 16, sample: int = 4096,
         block: int = 1024, probe: int = 4) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors``: a condition on vec_id.  ``low`` and ``high`` are percentages of
    the positive's score.  Vectors are the components times ``scale``, rounded
    down.
    """
    known = V.integers(rows, scale, vector, label)
    index = V.build(known, V.references(known, directions, sample, unit=True), angles, block)
    own = index.rows.where(anchors).drop("blk")
    alike = V.stored(V.search(index, own.select("*", *V.windows((F.lit(V.LEAST), F.lit(V.MOST)))), positives,
                              _match(positives, True), _cluster_bounds(True), probe), "negatives-positives")
    # a few positives an anchor: their windows as one row
    p = F.col("score")
    window = F.struct("rank", F.when(p < 0, 1).otherwise(F.expr(f"({low} * score + 99) div 100")).alias("lo"),
                      F.when(p < 0, 0).otherwise(F.expr(f"({high} * score) div 100")).alias("hi"))
    asked = alike.groupBy("query_id").agg(F.sort_array(F.collect_list(window)).alias("w"))
    empty = F.array_repeat(F.struct(F.lit(0).alias("rank"), F.lit(1).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi")),
                           F.lit(positives) - F.size("w"))
    asks = (own.join(asked.withColumnRenamed("query_id", "vec_id"), "vec_id").withColumn("w", F.concat("w", empty))
            .select(*own.columns, F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi")))
    found = V.search(index, asks, negatives, _match(negatives, False), _cluster_bounds(False), probe)
    return (found.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id")
            .join(alike.select("query_id", (F.col("rank") - 1).alias("which"), F.col("vec_id").alias("positive_id"),
                               p.alias("positive_score")), ["query_id", "which"])
            .select(F.col("query_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
