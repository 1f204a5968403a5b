"""Substring deduplication: seed and extend.

Every window of ``window`` words is owned by one anchor: the ``gram``-word run
of least hash in it (winnowing, rightmost on ties).  Equal windows hold the
same anchor at the same place, so comparing the contexts of equal anchors
finds every repeated window:

1. Seeds.  Each anchor occurrence stands with its hash and the hash of its
   context, the words of all windows that it owns.  Occurrences are joined by
   anchor; in a class of equal contexts all but the first are repeats as far as
   the context reaches on both sides.  A task sends one occurrence of a class
   to the others; its later ones are repeats already, so a passage that
   millions of documents share costs a row a task.
2. Extension.  An anchor with several contexts is extended window by window,
   for the first occurrence of each context only: equal windows (128-bit hash)
   are grouped, and all but the first are repeats.
3. Overlapping repeats join to maximal ones, and their words are removed.

A window is a repeat if its words also start earlier (lesser ``doc_id``, or
the same document and an earlier start).  All is judged on the input.

Nulls: a null text has no words; a null ``doc_id`` stands below all others.
Rows that repeat both id and text are one document, and get one result each;
texts that share an id stand in the texts' order.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored, texts
from .words import SPACE_WORDS, U64, mix, run_hashes, slices, split_words, windowed_minimum

FLUSH = 1_500_000  # occurrences that a task holds at once
_N = 256           # a range is kept as start * _N + number of windows


class _Firsts:
    """Collects occurrences of a task and tells the first of each class from the later ones."""

    def __init__(self, contexts: bool = False):
        self.parts, self.rows, self.contexts = [], 0, contexts

    def add(self, a, b, k, at):
        if len(a):
            self.parts.append((a, b, k, at))
            self.rows += len(a)
        return self.rows >= FLUSH

    def flush(self):
        if self.rows:
            a, b, k, at = (np.concatenate(x) for x in zip(*self.parts))
            order = np.lexsort((at, k, b, a))
            a, b, k, at = (x[order] for x in (a, b, k, at))
            late = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
            several = np.zeros(len(a), bool)
            if self.contexts:  # which context of its anchor each is, by the hash of the context
                first = np.append(True, a[1:] != a[:-1])
                own = np.cumsum(~late)
                own -= np.repeat(own[first] - 1, np.diff(np.append(np.flatnonzero(first), len(a))))
                several = ~late & (own > 2)
            # a later one needs no partner, and one known to stand in several contexts neither: they may go anywhere
            a = np.where(late | several, mix(k.view(U64) * U64(0x9E3779B97F4A7C15) + at.view(U64)), a)
            self.parts, self.rows = [], 0
            for i in range(0, len(a), 1 << 16):
                cut = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[cut].view(np.int64)), pa.array(b[cut].view(np.int64)), pa.array(k[cut]),
                     pa.array(at[cut]), pa.array(late[cut]), pa.array(several[cut])], ["a", "b", "k", "at", "late", "several"])


_OCCURRENCE = "a long, b long, k long, at long, late boolean, several boolean"


def seeds(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows (a, b, k, at, late, several): anchor hash, context hash, document, range of owned windows.

    ``late``: its class began earlier; ``several``: its anchor stands in other contexts as well.
    """
    if window - gram + 1 >= _N:
        raise ValueError(f"window - gram + 1 must be below {_N}")

    def run(batches):
        held = _Firsts(contexts=True)
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), SPACE_WORDS)
            x, y = w.hashes(0), w.hashes(1)
            grams = w.run_starts(gram)
            values = run_hashes(x, grams, grams + gram)
            _, place, _ = windowed_minimum(values, np.searchsorted(grams, w.first), window - gram + 1)
            at = w.run_starts(window)
            if not len(at):
                continue
            new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (np.diff(at) != 1)))
            many = np.diff(np.append(new, len(at)))
            doc = np.searchsorted(w.first, at[new], side="right") - 1
            k = batch.column("k").to_numpy(zero_copy_only=False)[doc]
            start = at[new] - w.first[doc]
            if held.add(values[place[new]], run_hashes(y, at[new], at[new] + many - 1 + window, 1), k,
                        start * _N + many):
                yield from held.flush()
        yield from held.flush()
    return map_arrow(keyed, run, _OCCURRENCE)


def _windows(opened: DataFrame, window: int) -> DataFrame:
    """Rows (a, b, k, at, late, several): the windows of the ranges ``open``, with their hashes."""
    def run(batches):
        held = _Firsts()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), SPACE_WORDS)
            lists = batch.column("open")
            at = lists.flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(batch)), np.asarray(lists.value_lengths()))
            many = at % _N
            each = np.repeat(np.arange(len(at)), many)
            start = (at // _N)[each] + np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
            doc = doc[each]
            i = start + w.first[doc]
            if held.add(run_hashes(w.hashes(0), i, i + window), run_hashes(w.hashes(1), i, i + window, 1),
                        batch.column("k").to_numpy(zero_copy_only=False)[doc], start):
                yield from held.flush()
        yield from held.flush()
    return map_arrow(opened, run, _OCCURRENCE)


def _repeat() -> F.Column:
    """Whether the row is a later one of its class; rows must be dealt by ``a``."""
    return F.col("late") | (F.row_number().over(Window.partitionBy("a", "b").orderBy("late", "k", "at")) > 1)


def repeats(keyed: DataFrame, window: int = 20, gram: int = 6) -> DataFrame:
    """Rows (k, whole, some): per document, ranges of repeated windows, and single repeated windows."""
    by_anchor = Window.partitionBy("a")  # at most two rows of an anchor from a task
    context = F.when(~F.col("late"), F.col("b"))
    many = F.col("several") | (F.min(context).over(by_anchor) != F.max(context).over(by_anchor))
    seen = (seeds(keyed, window, gram).repartition("a").withColumn("whole", _repeat())
            .withColumn("open", ~F.col("whole") & many)
            .where(F.col("whole") | F.col("open")))
    ranges = stored(seen.groupBy("k").agg(F.collect_list(F.when(F.col("whole"), F.col("at"))).alias("whole"),
                                          F.collect_list(F.when(F.col("open"), F.col("at"))).alias("open")),
                    "substring-seeds")
    opened = keyed.join(ranges.where(F.size("open") > 0).select("k", "open"), "k")
    some = (_windows(opened, window).repartition("a").withColumn("whole", _repeat()).where("whole")
            .groupBy("k").agg(F.collect_list("at").alias("some")))
    return ranges.where(F.size("whole") > 0).select("k", "whole").join(some, "k", "full_outer")


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 20,
                gram: int = 6) -> DataFrame:
    """One row per row: doc_id, n_words, repeats (maximal ranges of words that are removed), kept (the words left)."""
    own = texts(docs, doc_id, text).toDF("doc_id", "text")
    odd = own.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    if odd:  # ids that don't tell the rows apart: number the different ones in order
        keyed = stored(own.groupBy("doc_id", "text").agg(F.count("*").alias("n"))
                       .repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
                       .withColumn("k", F.monotonically_increasing_id()), "substring-documents")
    else:
        keyed = own.withColumn("k", F.col("doc_id"))
    found = repeats(keyed.select("k", "text"), window, gram)

    def run(batches):
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), SPACE_WORDS)
            data, starts, ends = w.normal()
            cover = np.zeros(len(starts) + 1, np.int32)
            for name in ("whole", "some"):
                lists = batch.column(name)
                at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(batch)), np.asarray(lists.value_lengths().fill_null(0)))
                many = at % _N if name == "whole" else np.ones(len(at), np.int64)
                first = (at // _N if name == "whole" else at) + w.first[doc]
                np.add.at(cover, first, 1)
                np.add.at(cover, first + many - 1 + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            keep = np.repeat(~gone, ends - starts + 1)
            kept = np.zeros(len(keep) + 1, np.int64)
            np.cumsum(keep, out=kept[1:])
            bounds = kept[np.append(starts, len(data))][w.first]
            left = data[keep].tobytes()
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)  # also cut between documents below
            edge = np.union1d(edge, w.first[:-1][w.counts > 0])
            edge = edge[gone[edge]]
            stop = np.union1d(np.flatnonzero(np.diff(gone.astype(np.int8), append=0) == -1), w.first[1:][w.counts > 0] - 1)
            stop = stop[gone[stop]]
            doc = np.searchsorted(w.first, edge, side="right") - 1
            spans = [[] for _ in range(len(batch))]
            for d, i, j in zip(doc.tolist(), (edge - w.first[doc]).tolist(), (stop + 1 - edge).tolist()):
                spans[d].append({"start": i, "length": j})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(w.counts.astype(np.int64)),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                 pa.array([left[i: max(i, j - 1)].decode() for i, j in zip(bounds, bounds[1:])], pa.string())],
                ["doc_id", "n_words", "repeats", "kept"])

    rows = keyed.join(found, "k", "left")
    if odd:
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return map_arrow(rows.select("doc_id", "text", "whole", "some"), run,
                     "doc_id long, n_words long, repeats array<struct<start:int,length:int>>, kept string")
