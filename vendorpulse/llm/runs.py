"""Periodic runs of words: maximal-pair enumeration over the LCP-interval tree.

A run is a stretch of consecutive words of one text with smallest period q
that no neighbouring word extends, of at least ``min_length`` words and
``min_exponent`` periods.  A stretch [s, e) with period q is a maximal pair:
the suffixes at s and s + q agree in exactly e - s - q words, and the words
before them differ.  So nothing is extended; runs are read off the pairs:

1. Suffixes are sorted by prefix doubling, all texts of a slice at once (the
   text is part of a word's first class, so texts never meet).  A place whose
   class is its own takes no part in later rounds, and only places whose first
   words (as many as a pair of a run must share) occur again enter the tree.
2. The LCP-interval tree is built bottom up.  Each node holds its places in
   order with their left words; nodes whose places all have one left word are
   merged without looking, as no pair among them is maximal.  Else each place of
   the lesser child looks at its neighbours in the greater one: places with
   different left words at distance d, where the node's LCP m has
   m >= (min_exponent - 1) * d and m + d >= min_length, are a run of period d.
   Neighbours suffice, since a place between s and s + q in the same node would
   give the run a smaller period.
3. Pairs at a multiple of the period span the same stretch; the least distance
   of a stretch is its period.

A text is one task's work at most; memory follows a slice (1 MB of text, or
one longer text: some 4 bytes a word and doubling round).

Nulls: a null text has no words, no runs and an empty ``kept``; a null
``doc_id`` stays.  Empty texts likewise.  Repeated rows give a result each.
An empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, texts
from .words import SPACE_WORDS, Words, slices, split_words

RUNS = "array<struct<start:int,length:int,period:int>>"
_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("period", pa.int32())]))
_FEW = 32        # so few places are put into a sorted list one by one
_MIXED = -2      # left words of a node that has several; -1 stands for a text's begin


def word_ids(w: Words) -> np.ndarray:
    """A number for each word, the same for equal words (by the words themselves, not by a hash)."""
    data, starts, _ = w.normal()
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.append(starts, len(data)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _doubling(ids: np.ndarray, first: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the blocks of 1, 2, 4 … words at each place, and the places whose ``least`` words occur again.

    A rank is the number of places that sort before the block's class.  Blocks
    that end with their text are classes of their own.
    """
    n = len(ids)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][doc]
    places, key, group = np.arange(n), doc * (int(ids.max()) + 1) + ids, np.zeros(n, np.int64)
    ranks, rank, step, repeated = [], np.zeros(n, np.int64), 0, np.zeros(0, np.int64)
    while True:
        order = np.lexsort((key, group))
        places, key, group = places[order], key[order], group[order]
        at = np.arange(len(places))
        new_group = np.append(True, group[1:] != group[:-1])
        new = new_group | np.append(True, key[1:] != key[:-1])
        base = np.maximum.accumulate(np.where(new_group, at, 0))
        begin = np.maximum.accumulate(np.where(new, at, 0))
        rank[places] = group + (begin - base)
        ranks.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
        last = np.append(new[1:], True)
        places = places[~(new & last)]  # what stands alone is sorted
        step = 2 * step or 1
        if step <= least:
            repeated = places
        if not len(places):
            return ranks, repeated
        group = rank[places]
        follow = places + step
        key = np.where(follow < end[places], rank[np.minimum(follow, n - 1)] + 1, 0)


def _common(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``i`` and ``j`` of one text."""
    out, n = np.zeros(len(i), np.int64), len(ranks[0])
    for k in range(len(ranks) - 1, -1, -1):
        a, b = i + out, j + out
        same = (a < end) & (b < end)
        same &= ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]
        out[same] += 1 << k
    return out


class _Tree:
    """Bottom-up traversal of the LCP-interval tree; ``found`` maps each stretch to its least distance."""

    def __init__(self, left: list[int], min_length: int, min_exponent: int):
        self.left, self.min_length, self.times = left, min_length, min_exponent - 1
        self.found: dict[tuple[int, int], int] = {}

    def _pair(self, i: int, j: int, m: int) -> None:
        d = j - i
        if m >= self.times * d and m + d >= self.min_length and self.left[i] != self.left[j]:
            stretch = (i, j + m)
            if d < self.found.get(stretch, d + 1):
                self.found[stretch] = d

    def merge(self, m: int, a: list, b: list) -> list:
        """Two children of a node of LCP ``m``: [left word or _MIXED, places in order]."""
        if len(a[1]) < len(b[1]):
            a, b = b, a
        large, small = a[1], b[1]
        if a[0] != b[0] or a[0] == _MIXED:
            n = len(large)
            for x in small:
                at = bisect_left(large, x)
                if at:
                    self._pair(large[at - 1], x, m)
                if at < n:
                    self._pair(x, large[at], m)
            a[0] = _MIXED
        if len(small) <= _FEW:
            for x in small:
                if x > large[-1]:
                    large.append(x)
                else:
                    insort(large, x)
        else:
            large.extend(small)
            large.sort()
        return a

    def add(self, places: list[int], lcp: list[int]) -> None:
        """Suffixes in sorted order; ``lcp[t]``: words that suffix t shares with the one before, 0 to begin a new tree."""
        stack: list[tuple[int, list]] = []
        node: list | None = None
        for p, m in zip(places, lcp):
            while stack and stack[-1][0] > m:
                above, first = stack.pop()
                node = self.merge(above, first, node)
            if m:
                if stack and stack[-1][0] == m:
                    stack[-1] = (m, self.merge(m, stack[-1][1], node))
                else:
                    stack.append((m, node))
            node = [self.left[p], [p]]
        while stack:
            above, first = stack.pop()
            node = self.merge(above, first, node)


def periodic_runs(ids: np.ndarray, first: np.ndarray, min_length: int = 24,
                  min_exponent: int = 3) -> np.ndarray:
    """Rows (start, end, period), by start and period, of the texts whose words are ``ids[first[d]:first[d + 1]]``."""
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    least = max(1, -(-min_length * (min_exponent - 1) // min_exponent))  # words that the pair of a run shares
    if len(ids) <= least:
        return np.zeros((0, 3), np.int64)
    ranks, repeated = _doubling(ids, first, least)
    if not len(repeated):
        return np.zeros((0, 3), np.int64)
    places = repeated[np.argsort(ranks[-1][repeated], kind="stable")]
    doc = np.searchsorted(first, places, side="right") - 1
    lcp = np.zeros(len(places), np.int64)
    lcp[1:] = np.where(doc[1:] == doc[:-1], _common(ranks, places[:-1], places[1:], first[1:][doc[1:]]), 0)
    lcp[lcp < least] = 0
    joined = lcp > 0
    joined[:-1] |= joined[1:]
    places, lcp = places[joined], lcp[joined]
    left = np.append(-1, ids[:-1])
    left[first[:-1][np.diff(first) > 0]] = -1
    tree = _Tree(left.tolist(), min_length, min_exponent)
    tree.add(places.tolist(), lcp.tolist())
    out = np.array([(s, e, d) for (s, e), d in tree.found.items()], np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def collapse(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = 24,
             min_exponent: int = 3) -> DataFrame:
    """One row per row: doc_id, n_words, runs (by start, then period), kept.

    ``kept``: the words, joined by one space, without those that some run
    contains after its first period.
    """
    def run(batches):
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), SPACE_WORDS)
            found = periodic_runs(word_ids(w), w.first, min_length, min_exponent)
            data, starts, ends = w.normal()
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, found[:, 0] + found[:, 2], 1)
            np.add.at(cover, found[:, 1], -1)
            stay = np.cumsum(cover[:-1]) == 0
            bytes_kept = np.repeat(stay, ends - starts + 1)
            upto = np.append(0, np.cumsum(bytes_kept))
            bounds = upto[np.append(starts, len(data))][w.first]
            left = data[bytes_kept].tobytes()
            doc = np.searchsorted(w.first, found[:, 0], side="right") - 1
            values = pa.StructArray.from_arrays(
                [pa.array((found[:, 0] - w.first[doc]).astype(np.int32)),
                 pa.array((found[:, 1] - found[:, 0]).astype(np.int32)), pa.array(found[:, 2].astype(np.int32))],
                fields=list(_RUNS.value_type))
            upto = np.searchsorted(doc, np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(w.counts.astype(np.int64)), pa.ListArray.from_arrays(upto, values, type=_RUNS),
                 pa.array([left[i: max(i, j - 1)].decode() for i, j in zip(bounds, bounds[1:])], pa.string())],
                ["doc_id", "n_words", "runs", "kept"])

    own = texts(docs, doc_id, text).toDF("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    return map_arrow(own, run, f"doc_id {kind}, n_words long, runs {RUNS}, kept string")
