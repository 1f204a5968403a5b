"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(t_k - w . x): one weight vector over hashed words,
shared by all grades, and ordered thresholds t_0 < t_1 < ... .  x holds the
text's hashed lower-cased words and word pairs (root of the count, length 1)
and a few shape features (length, share of repeated words, of symbols, of
capitals).  The expected grade orders documents; the tail probability
P(grade >= wanted) selects them.

Ratings come from at most about ``sample`` rated rows (by hash of the id; fold
0 of 5 is never used).  Training mixes parameters: in each round every
partition runs one pass over its rows from the common parameters, and Spark
averages the results, coordinate by coordinate; what a task or the driver holds
is ``2 ** bits`` numbers, and ``tasks`` tasks send that many in a round.  All documents are scored, whole.

Nulls and empty texts have no words: the thresholds alone grade them.  A null
``doc_id`` is scored and never learnt from; null ratings are left out, and of
several ratings of a document the lowest counts.  With fewer than two grades
the only one is certain.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, free_name, map_arrow, stored
from .words import SPACE_WORDS, U64, mix, slices, split_words

SHAPE = 5


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text a sparse row: text of each entry, its place (hashed words, then shape), its value."""
    w = split_words(column, SPACE_WORDS, lower=True)
    n, h, doc = w.counts, w.hashes(), w.doc()
    pairs, ph = w.runs(h, 2)
    rows = np.concatenate([doc, doc[pairs]])
    place = (np.concatenate([h, ph]) >> U64(64 - bits)).astype(np.int64)
    entry, count = np.unique((rows << bits) | place, return_counts=True)
    rows, place, value = entry >> bits, entry & ((1 << bits) - 1), np.sqrt(count)
    norm = np.sqrt(np.bincount(rows, value ** 2, len(n)))
    value = value / norm[rows]
    # shape: on scales of about 1
    some = np.maximum(n, 1)
    _, at = np.unique(mix(h + doc.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True)
    distinct = np.bincount(doc[at], minlength=len(n))
    raw = split_words(column, SPACE_WORDS)
    upto = np.zeros((2, len(raw.data) + 1))
    np.cumsum((raw.data >= 0x41) & (raw.data <= 0x5A), out=upto[0, 1:])
    np.cumsum((raw.data >= 0x21) & (raw.data <= 0x2F) | (raw.data >= 0x3A) & (raw.data <= 0x40), out=upto[1, 1:])
    capital, symbol = (np.bincount(raw.doc(), u[raw.ends] - u[raw.starts], len(n)) for u in upto)
    size = np.maximum(np.bincount(raw.doc(), raw.ends - raw.starts, len(n)), 1)
    shape = np.stack([np.log1p(n) / 5, 1 - distinct / some, np.sqrt(symbol / size), np.sqrt(capital / size),
                      size / some / 10], 1)
    shape[n == 0] = 0
    rows = np.concatenate([rows, np.repeat(np.arange(len(n)), SHAPE)])
    place = np.concatenate([place, np.tile((1 << bits) + np.arange(SHAPE), len(n))])
    return rows, place, np.concatenate([value, shape.ravel()])


@dataclass
class Model:
    grades: tuple           # ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than the grades
    bits: int

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each score and all but the last grade."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None] - score[:, None], -30, 30)))

    def grade(self, column: pa.Array) -> np.ndarray:
        """P(grade = k) for each text and grade."""
        rows, place, value = features(column, self.bits)
        score = np.bincount(rows, value * self.weights[place], len(column))
        upto = np.concatenate([np.zeros((len(column), 1)), self.at_most(score), np.ones((len(column), 1))], axis=1)
        return np.diff(upto, axis=1)


def _pass(model: Model, rows: list[tuple], rate: float, shrink: float) -> Model:
    """One pass of AdaGrad over rows (grade number, places, values)."""
    w, t = model.weights.copy(), model.thresholds.copy()
    seen_w, seen_t = np.full(len(w), 1e-2), np.full(len(t), 1e-2)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for g, place, value in rows:
        s = value @ w[place]
        upper = logistic(t[g] - s) if g < len(t) else 1.0
        lower = logistic(t[g - 1] - s) if g else 0.0
        p = max(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        step = (du - dl) * value + shrink * w[place]  # gradient of -log p
        seen_w[place] += step ** 2
        w[place] -= rate * step / np.sqrt(seen_w[place])
        for k, d in ((g, -du), (g - 1, dl)):
            if 0 <= k < len(t):
                seen_t[k] += d ** 2
                t[k] -= rate * d / np.sqrt(seen_t[k])
        t = np.maximum.accumulate(t)
    return Model(model.grades, w, t, model.bits)


def fit(docs: DataFrame, ratings: DataFrame, rating: str = "rating", text: str = "text", doc_id: str = "doc_id",
        sample: int = 12_000, bits: int = 16, rounds: int = 6, rate: float = 0.15, shrink: float = 1e-4,
        tasks: int = 4) -> Model:
    """``ratings``: ids and integer grades."""
    own = (ratings.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{rating}`").cast("int").alias("rating"))
           .where("doc_id is not null and rating is not null").groupBy("doc_id").agg(F.min("rating").alias("rating"))
           .where(fold("doc_id", 5) != 0))
    sizes = {r.rating: r.n for r in own.groupBy("rating").agg(F.count("*").alias("n")).collect()}  # a row a grade
    grades, total = tuple(sorted(sizes)), sum(sizes.values())
    below = np.cumsum([sizes[g] for g in grades])[:-1] / max(total, 1)
    model = Model(grades, np.zeros((1 << bits) + SHAPE), np.log(below / (1 - below)), bits)
    if len(grades) < 2:
        return model
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < min(1.0, sample / total) * (1 << 30))
    rows = (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .join(F.broadcast(picked), "doc_id"))  # about ``sample`` ids

    def sparse(batches):
        for b in slices(batches, "text"):
            doc, place, value = features(b.column("text"), bits)
            order = np.argsort(doc, kind="stable")
            bounds = np.searchsorted(doc[order], np.arange(len(b) + 1))
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x[order], kind))
            grade = pa.array([grades.index(r) for r in b.column("rating").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), grade, lists(place, pa.int32()),
                                              lists(value, pa.float32())], ["doc_id", "grade", "place", "value"])

    # dealt and mixed once, then read in that order by every round
    mixed = (rows.select("doc_id", "text", "rating").repartition(tasks, F.xxhash64("doc_id", "text"))
             .sortWithinPartitions(F.xxhash64("doc_id", "text", F.lit(1))))
    train = stored(map_arrow(mixed, sparse, "doc_id long, grade int, place array<int>, value array<float>"), "ordinal-rows")
    for i in range(rounds):
        sent = docs.sparkSession.sparkContext.broadcast(model)
        step = rate / (1 + i)

        def run(batches):
            now, n = sent.value, 0
            for b in batches:
                part = list(zip(b.column("grade").to_pylist(), _lists(b.column("place")), _lists(b.column("value"))))
                now, n = _pass(now, part, step, shrink), n + len(b)
            if n:
                both = np.concatenate([now.weights, now.thresholds])
                at = np.append(np.flatnonzero(both), len(both))  # beyond the last place: the rows
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(both, 1.0)[at] * n)], ["at", "value"])
        mean = (map_arrow(train.select("grade", "place", "value").coalesce(tasks), run, "at long, value double")
                .groupBy("at").agg(F.sum("value").alias("value")).toPandas())  # 2 ** bits rows
        both = np.zeros(len(model.weights) + len(model.thresholds) + 1)
        both[mean["at"].to_numpy()] = mean["value"].to_numpy()
        both = both[:-1] / max(both[-1], 1.0)
        model = Model(grades, both[: len(model.weights)], np.maximum.accumulate(both[len(model.weights):]), bits)
    return model


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.asarray(column.value_lengths()))
    return np.split(flat, ends[:-1]) if len(ends) else []


def score(docs: DataFrame, model: Model, wanted: int, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, last, one struct column ``quality`` (expected_grade, tail: P(grade >= wanted))."""
    out = free_name(docs, "quality")
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(out, T.StructType.fromDDL("expected_grade double, tail double"))])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        grades = np.array(sent.value.grades or (0,), float)
        for b in slices(batches, text):
            p = sent.value.grade(b.column(text))
            struct = pa.StructArray.from_arrays([pa.array(p @ grades), pa.array(p @ (grades >= wanted).astype(float))],
                                                ["expected_grade", "tail"])
            yield pa.RecordBatch.from_arrays([*b.columns, struct], [*b.schema.names, out])
    return docs.mapInArrow(run, schema)
