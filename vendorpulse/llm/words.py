"""Word splitting and hashing of whole Arrow batches with numpy.

Both word definitions in use are byte classes of UTF-8 text (every separator is
ASCII), so a batch of texts is split by one table look-up over its bytes.
Words are hashed by XXH64, under two seeds where 128 bits are needed.  Runs of
words are hashed by doubling: blocks of 1, 2, 4 … words each mix the hashes of
their halves, and a run mixes the two blocks, from its begin and to its end,
that cover it.  A run hash depends on nothing but the run's words, and no step
is linear, so no words are known that collide under every seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
SLICE_BYTES = 1 << 20  # texts are handled in slices of about this size, so memory doesn't follow the batch

_SPACE = np.ones(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: bytes of words that end at space, tab, LF, VT, FF, CR
SPACE_WORDS = _SPACE
#: bytes of words of digits, lower-case letters and everything beyond ASCII
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_EMPTY, _LINE_FEED = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
#: seeds of the two word hashes, and odd multipliers of the two run hashes
_SEEDS = (0, 0x9E3779B97F4A7C15)
_STEPS = (U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits (a bijection)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


# the multipliers of XXH64 (fixed values)
P1, P2, P3, P4, P5 = map(U64, (11400714785074694791, 14029467366897019727, 1609587929392839161,
                               9650029242287828579, 2870177450012600261))
_LONG = 256  # longer ranges are hashed one by one


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U64(n)) | (x >> U64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each byte range."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lane8 = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    lane4 = np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))
    add = lambda *xs: U64(sum(map(int, xs)) % (1 << 64))
    h = np.full(len(starts), add(seed, P5), U64)
    at = starts.copy()
    long = np.flatnonzero((size >= 32) & (size <= _LONG))
    if len(long):
        acc = [np.full(len(long), v, U64) for v in (add(seed, P1, P2), add(seed, P2), seed, add(seed, -int(P1)))]
        p, left = starts[long], size[long] // 32
        for i in range(int(left.max())):
            on = np.flatnonzero(left > i)
            for k in range(4):
                acc[k][on] = _round(acc[k][on], lane8[p[on] + 32 * i + 8 * k])
        g = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for a in acc:
            g = (g ^ _round(np.zeros(len(g), U64), a)) * P1 + P4
        h[long], at[long] = g, p + 32 * left
    h += size.astype(U64)
    left = np.where(size <= _LONG, ends - at, 0)
    while len(on := np.flatnonzero(left >= 8)):
        h[on] = _rotl(h[on] ^ _round(np.zeros(len(on), U64), lane8[at[on]]), 27) * P1 + P4
        at[on] += 8
        left[on] -= 8
    on = np.flatnonzero(left >= 4)
    h[on] = _rotl(h[on] ^ (lane4[at[on]].astype(U64) * P1), 23) * P2 + P3
    at[on] += 4
    left[on] -= 4
    while len(on := np.flatnonzero(left >= 1)):
        h[on] = _rotl(h[on] ^ (data[at[on]].astype(U64) * P5), 11) * P1
        at[on] += 1
        left[on] -= 1
    h ^= h >> U64(33)
    h *= P2
    h ^= h >> U64(29)
    h *= P3
    h ^= h >> U64(32)
    for i in np.flatnonzero(size > _LONG):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]: ends[i]].tobytes(), seed)
    return h


@dataclass
class Words:
    """Words of a slice of texts: byte ranges in ``data`` and, per text, a range of words."""

    data: np.ndarray      # bytes of all texts, each followed by a line feed
    starts: np.ndarray    # byte range of each word
    ends: np.ndarray
    first: np.ndarray     # words first[d]:first[d + 1] are those of text d

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return xxh64(self.data, self.starts, self.ends, _SEEDS[which])

    def runs(self, hashes: np.ndarray, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of ``n`` words of one text, in order."""
        at = self.run_starts(n)
        return at, run_hashes(hashes, at, at + n, which)

    def run_starts(self, n: int) -> np.ndarray:
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= n)

    def normal(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words, each followed by one space, as bytes, with their new byte ranges."""
        size = self.ends - self.starts
        step = np.zeros(len(self.data), np.int8)
        step[self.starts], step[self.ends] = 1, -1
        keep = np.cumsum(step, dtype=np.int8).astype(bool)
        keep[self.ends] = True  # the separator after a word; the last text ends in one as well
        data = self.data.copy()
        data[self.ends] = 0x20
        ends = np.cumsum(size + 1) - 1
        return data[keep], ends - size, ends


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each range of words (one at least), from their hashes."""
    size, step = ends - starts, _STEPS[which]
    power = np.frexp(size)[1] - 1  # the largest power of two within the size
    out, block = np.zeros(len(starts), U64), hashes
    for k in range(int(power.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            block = mix(block[:-half] * step + _rotl(block[half:], 29))
        on = np.flatnonzero(power == k)
        out[on] = mix(mix(block[starts[on]] + size[on].astype(U64)) * step + _rotl(block[ends[on] - (1 << k)], 29))
    return out


def split_words(texts: pa.Array, word_bytes: np.ndarray = SPACE_WORDS, lower: bool = False) -> Words:
    """Split texts (null: no words); ``lower`` lower-cases A-Z first."""
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), _EMPTY, _LINE_FEED)
    n = len(joined)
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset: joined.offset + n + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0]: offsets[-1]] if n else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if n else np.zeros(1, np.int64)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = word_bytes[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``size`` bytes of text (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(lengths, dtype=np.int64), 0
        while at < len(batch):
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + size, side="right")))
            yield batch.slice(at, end - at)
            at = end


def windowed_minimum(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: for every ``width`` consecutive values of one text, the place of the rightmost minimum.

    ``first`` bounds the texts' values.  Returns the window starts and, for
    each, the place chosen, and the text of each window.  What a window
    chooses depends on its values alone.
    """
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    base = np.cumsum(np.maximum(counts - width + 1, 0)) - np.maximum(counts - width + 1, 0)
    at = np.arange(len(doc)) - base[doc] + first[:-1][doc]
    best, place = values[at].copy() if len(at) else np.zeros(0, values.dtype), at.copy()
    span = 1
    # doubling: after each step (best, place) covers span values from the window's start
    all_best, all_place = values.copy(), np.arange(len(values))
    while span * 2 <= width:
        nb, np_ = all_best[span:], all_place[span:]
        take = nb <= all_best[: len(nb)]
        all_best = np.concatenate([np.where(take, nb, all_best[: len(nb)]), all_best[len(nb):]])
        all_place = np.concatenate([np.where(take, np_, all_place[: len(nb)]), all_place[len(nb):]])
        span *= 2
    if len(at):
        best, place = all_best[at], all_place[at]
        tail = at + width - span
        take = (all_best[tail] < best) | ((all_best[tail] == best) & (all_place[tail] >= place))
        place = np.where(take, all_place[tail], place)
    return at, place, doc
