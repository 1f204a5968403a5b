"""Interpolated modified Kneser-Ney bigram model over a corpus, and document scores.

Counting: each task counts its words and word pairs, and sends sorted key
blocks to shards of the key space; a task per shard merges them.  The shards'
number follows the corpus (``shard_bytes`` of text each).  Pairs are sharded by
their context, so a shard also has its contexts' totals; pairs of contexts that
hold more than a share of 1 / (4 shards) of all tokens (at most 4 times the
shards of them, by arithmetic) are spread by the whole pair, and their totals
are summed afterwards.

Model: sorted arrays of word hashes and pair keys, three files a shard, in the
cluster's shared folder.  Workers memory-map them, and keep the maps; nothing of
the model but sizes, discounts and the hot contexts' totals passes through the
driver.  A lookup visits every shard that its keys are in, so texts are looked
up in rounds of some megabytes, whatever the batches.

Words end at space, tab, LF, VT, FF or CR, with A-Z lower-cased; every text
ends in one end token.  The model is p(w|h) = (c(hw) - D) / c(h) + g(h) p(w),
with p(w) from the number of distinct words before w, smoothed by the uniform
distribution over the vocabulary and one unknown word.

Nulls: a null text is empty (its end token alone); a null ``doc_id`` is kept,
with fold 0.  Repeated rows count and are scored each.  An empty table gives no
rows; with no training rows every word is unknown.
"""

from __future__ import annotations

import json
import mmap
import os
import sys
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, shared_path, stored
from .words import SPACE_WORDS, U64, mix, slices, split_words

END = mix(np.array([1], U64))[0]
FLUSH = 4_000_000  # keys that a task holds at once
ROUND_BYTES = 4 << 20  # of text that is looked up at once
MAPS = 32_768 if sys.version_info >= (3, 13) else 4096  # files mapped at once; before 3.13 each holds a file descriptor
_LOW = U64(0xFFFFFFFF)


# --- files in the shared folder -------------------------------------------------

_maps: dict[str, np.ndarray | list[np.ndarray]] = {}


def _local(path: str) -> str | None:
    u = urlparse(path)
    return u.path if u.scheme in ("", "file") else None


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array under a name; a repeated task replaces it by the same bytes."""
    if (own := _local(folder)) is not None:
        os.makedirs(own, exist_ok=True)
        fd, new = tempfile.mkstemp(dir=own, prefix=f".{name}-")
        with os.fdopen(fd, "wb") as f:
            np.save(f, array)
        os.replace(new, f"{own}/{name}.npy")
        return
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    with store.open_output_stream(new := f"{at}/.{name}-{os.getpid()}") as f:
        np.save(f, array)
    store.move(new, f"{at}/{name}.npy")


def get(folder: str, name: str) -> np.ndarray:
    """Memory-map an array (from a copy, if the shared folder isn't a mounted one)."""
    key = f"{folder}/{name}.npy"
    if key not in _maps:
        own = _local(key)
        if own is None:
            from pyarrow import fs

            own = os.path.join(tempfile.mkdtemp(), f"{name}.npy")
            fs.copy_files(key, own)
        if len(_maps) >= MAPS:
            _maps.clear()
        _maps[key] = _mapped(own)
    return _maps[key]


def _mapped(path: str) -> np.ndarray:
    """A file of :func:`put` as a plain array over its map."""
    with open(path, "rb") as f:
        read = np.lib.format.read_array_header_1_0 if np.lib.format.read_magic(f) == (1, 0) else np.lib.format.read_array_header_2_0
        shape, fortran, kind = read(f)
        if not np.prod(shape):
            return np.zeros(shape, kind)
        own = {"trackfd": False} if sys.version_info >= (3, 13) else {}
        flat = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **own), kind, int(np.prod(shape)), f.tell())
        return flat.reshape(shape, order="F" if fortran else "C")


def put_all(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Write several arrays as one file: their kinds, then each from a multiple of 64 bytes on."""
    kinds = json.dumps([(a.dtype.str, a.shape) for a in arrays]).encode()
    parts = [np.array([len(kinds)], "<i8").tobytes() + kinds, *(np.ascontiguousarray(a).tobytes() for a in arrays)]
    put(folder, name, np.frombuffer(b"".join(p + bytes(-len(p) % 64) for p in parts), np.uint8))


def get_all(folder: str, name: str) -> list[np.ndarray]:
    """The arrays of :func:`put_all`, over one map."""
    key = f"{folder}/{name}.npy"
    if not isinstance(_maps.get(key), list):
        raw, arrays = get(folder, name), []
        size = 8 + int(raw[:8].view("<i8")[0])
        at = size + -size % 64
        for kind, shape in json.loads(raw[8:size].tobytes()):
            n = int(np.prod(shape)) * np.dtype(kind).itemsize
            arrays.append(raw[at: at + n].view(kind).reshape(shape))
            at += n + -n % 64
        _maps[key] = arrays
    return _maps[key]


# --- sorted key blocks ----------------------------------------------------------

def reduced(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts as a compressed block: bytes of the gaps, by place, then the counts."""
    gaps = np.diff(keys, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    raw = b"".join([gaps.tobytes(), np.minimum(counts, 255).astype(np.uint8).tobytes(),
                    counts[counts >= 255].astype("<i8").tobytes()])
    return np.array([len(keys), len(raw)], "<i8").tobytes() + pa.compress(raw, "lz4", asbytes=True)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, size = (int(x) for x in np.frombuffer(block[:16], "<i8"))
    raw = pa.decompress(block[16:], decompressed_size=size, codec="lz4", asbytes=True)
    keys = np.cumsum(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T.copy().view("<u8").ravel(), dtype=U64)
    counts = np.frombuffer(raw, np.uint8, n, 8 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", offset=9 * n)
    return keys, counts


def _merged(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in blocks]
    return reduced(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


class _Counter:
    """Counts keys of a task and sends them by shard."""

    def __init__(self, shard_of):
        self.shard_of, self.parts, self.rows = shard_of, [], 0

    def add(self, keys: np.ndarray) -> bool:
        self.parts.append(reduced(keys))
        self.rows += len(self.parts[-1][0])
        return self.rows >= FLUSH

    def flush(self):
        if self.rows:
            keys, counts = reduced(*(np.concatenate(x) for x in zip(*self.parts)))
            self.parts, self.rows = [], 0
            shard = self.shard_of(keys)
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order], shard[order]
            names, first = np.unique(shard, return_index=True)
            blocks = [pack(keys[a:b], counts[a:b]) for a, b in zip(first, np.append(first[1:], len(keys)))]
            yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(blocks, pa.binary())],
                                             ["shard", "block"])


def _top(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


# --- the model ------------------------------------------------------------------

@dataclass
class Discounts:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, from the numbers of counts 1 to 4."""

    of: np.ndarray

    @classmethod
    def fit(cls, n: np.ndarray) -> Discounts:
        n1, n2, n3, n4 = (float(x) for x in n)
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        return cls(np.array([0.0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))]))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return self.of[np.minimum(counts, 3)]


@dataclass
class Model:
    folder: str
    bits: int = 0                     # the shards are 2 ** bits
    tokens: int = 0
    base: np.ndarray = None           # words before each shard's
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))  # contexts spread by pair, in order
    hot_totals: np.ndarray = None     # their c, N1, N2, N3+
    paired: frozenset = frozenset()   # shards that hold pairs
    pairs: Discounts = None
    words: Discounts = None
    word_total: int = 0               # distinct pairs
    word_backoff: float = 1.0

    @property
    def vocabulary(self) -> int:
        return int(self.base[-1])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each (sorted) hash among the vocabulary's, -1 if it isn't one."""
        return self.known(hashes, "words")[0]

    def known(self, hashes: np.ndarray, *names: str) -> list[np.ndarray]:
        """The :meth:`ids` of (sorted) hashes, and what the files of the names hold of them (0 for -1)."""
        out = [np.full(len(hashes), -1, np.int64), *(np.zeros(len(hashes), np.int64) for _ in names)]
        for s, at in _by_shard(_top(hashes, self.bits)):
            if self.base[s + 1] > self.base[s]:
                held = get_all(self.folder, f"words-{s}")[0]
                p = np.minimum(np.searchsorted(held, hashes[at]), len(held) - 1)
                hit = np.flatnonzero(held[p] == hashes[at])
                at, p = at[hit], p[hit]
                out[0][at] = p + self.base[s]
                for x, name in zip(out[1:], names):
                    x[at] = get_all(self.folder, f"{name}-{s}")[-1][p]
        return out

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        context = keys >> U64(32)
        return _top(mix(np.where(np.isin(context, self.hot), keys, context)), self.bits)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for s, at in _by_shard(self.shard_of(keys)):
            if s in self.paired:
                known, counts, places = get_all(self.folder, f"pairs-{s}")[:3]
                p = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
                n = np.where(known[p] == keys[at], counts[p], 0).astype(np.int64)
                big = np.flatnonzero(n == 255)
                if len(big):
                    n[big] = places[1][np.searchsorted(places[0], p[big])]
                out[at] = n
        return out

    def totals(self, contexts: np.ndarray) -> np.ndarray:
        """c, N1, N2, N3+ of each (sorted, distinct) context; zeros if it wasn't seen."""
        out = np.zeros((len(contexts), 4), np.int64)
        hot = np.isin(contexts, self.hot)
        out[hot] = self.hot_totals[np.searchsorted(self.hot, contexts[hot])] if hot.any() else 0
        for s, at in _by_shard(np.where(hot, -1, _top(mix(contexts), self.bits))):
            if s in self.paired:
                known, totals = get_all(self.folder, f"pairs-{s}")[3:]
                if len(known):  # else hot ones alone
                    p = np.minimum(np.searchsorted(known, contexts[at]), len(known) - 1)
                    out[at] = np.where((known[p] == contexts[at])[:, None], totals[p], 0)
        return out

    def score(self, column: pa.Array) -> dict[str, np.ndarray]:
        """Per text: n_tokens, n_known, base_score, score."""
        hashes, first = token_hashes(column)
        words, which = np.unique(hashes, return_inverse=True)
        ids, counts, before = self.known(words, "words", "before")
        v = self.vocabulary
        base = np.log10((counts + 0.1) / (self.tokens + 0.1 * (v + 1)))
        total = max(self.word_total, 1)
        lower = (before - self.words(before)) / total + self.word_backoff / (v + 1)
        target = ids[which]
        context = np.roll(target, 1)
        context[first[:-1]] = v  # the start
        p = lower[which]
        seen, back = np.unique(np.maximum(context, 0), return_inverse=True)
        totals = self.totals(seen.astype(U64))
        c = totals[:, 0]
        backoff = np.where(c > 0, totals[:, 1:] @ self.pairs.of[1:] / np.maximum(c, 1), 1.0)
        c, backoff = np.where(context >= 0, c[back], 0), np.where(context >= 0, backoff[back], 1.0)
        both = np.flatnonzero((context >= 0) & (target >= 0))
        n = np.zeros(len(target), np.int64)
        n[both] = self.pair_counts(context[both].astype(U64) << U64(32) | target[both].astype(U64))
        p = (n - self.pairs(n)) / np.maximum(c, 1) + backoff * p
        at = first[:-1]
        return {"n_tokens": np.diff(first), "n_known": np.add.reduceat((counts > 0)[which].astype(np.int64), at),
                "base_score": np.add.reduceat(base[which], at), "score": np.add.reduceat(np.log10(p), at)}


def _by_shard(shard: np.ndarray):
    """Each shard with the places that belong to it."""
    order = np.argsort(shard, kind="stable")
    names, first = np.unique(shard[order], return_index=True)
    return [(int(s), order[a:b]) for s, a, b in zip(names, first, np.append(first[1:], len(order)))]


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text ends in END), and the bounds of the texts."""
    w = split_words(column, SPACE_WORDS, lower=True)
    first = w.first + np.arange(len(w.first))
    out = np.full(first[-1], END, U64)
    out[np.arange(len(w.starts)) + w.doc()] = w.hashes()
    return out, first


def rounds(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of about ``ROUND_BYTES`` of text: large ones cut, small ones put together."""
    held, size = [], 0
    for b in slices(batches, text, ROUND_BYTES):
        n = b.column(text).nbytes
        if held and size + n > ROUND_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(b)
        size += n
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _counted(rows: DataFrame, keys_of, shard_of) -> DataFrame:
    def run(batches):
        held = _Counter(shard_of)
        for b in rounds(batches, "text"):
            if held.add(keys_of(b.column("text"))):
                yield from held.flush()
        yield from held.flush()
    return map_arrow(rows, run, "shard int, block binary")


def fit(train: DataFrame, text: str = "text", shard_bytes: int = 8 << 20) -> Model:
    """Count a training table and write the model to the shared folder."""
    rows = train.select(F.col(f"`{text}`").alias("text"))
    model = Model(shared_path(train.sparkSession, "lm"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model.bits = max(0, int(size // shard_bytes).bit_length())
    shards, folder, bits = 1 << model.bits, model.folder, model.bits

    def words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = _merged(table.column("block").to_pylist())
        put_all(folder, f"words-{shard}", keys, counts)
        top = np.argsort(counts)[-64:]
        return pa.table({"shard": pa.array([shard] * len(top), pa.int32()), "place": pa.array(top),
                         "n": pa.array(counts[top]), "distinct": pa.array([len(keys)] * len(top), pa.int64()),
                         "tokens": pa.array([int(counts.sum())] * len(top), pa.int64())})

    found = (_counted(rows, lambda c: token_hashes(c)[0], lambda k: _top(k, bits)).groupBy("shard")
             .applyInArrow(words, "shard int, place long, n long, distinct long, tokens long")).collect()  # 64 a shard
    sizes = {r.shard: (r.distinct, r.tokens) for r in found}
    model.tokens = sum(t for _, t in sizes.values())
    model.base = np.append(0, np.cumsum([sizes.get(s, (0, 0))[0] for s in range(shards)])).astype(np.int64)
    if model.vocabulary >= 1 << 32:
        raise ValueError("word ids of 32 bits hold no more than 4,294,967,295 distinct words")
    model.hot = np.sort(np.array([model.base[r.shard] + r.place for r in found if r.n * 4 * shards > model.tokens]
                                 + [model.vocabulary], U64))  # the start of a text is a context of every text

    def pair_keys(column: pa.Array) -> np.ndarray:
        hashes, first = token_hashes(column)
        known, which = np.unique(hashes, return_inverse=True)
        target = model.ids(known)[which]
        context = np.roll(target, 1)
        context[first[:-1]] = model.vocabulary
        return context.astype(U64) << U64(32) | target.astype(U64)

    def pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, counts = _merged(table.column("block").to_pylist())
        large = np.flatnonzero(counts >= 255)
        context = keys >> U64(32)
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        totals = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in
                           (counts, counts == 1, counts == 2, counts >= 3)], axis=1)
        names = context[first]
        cold = ~np.isin(names, model.hot)
        put_all(folder, f"pairs-{shard}", keys, np.minimum(counts, 255).astype(np.uint8),
                np.stack([large, counts[large]]), names[cold], totals[cold])
        after, distinct = reduced(keys & _LOW)
        owner = np.searchsorted(model.base, after.astype(np.int64), side="right") - 1
        out = [("before", s, pack(after[at], distinct[at]), None) for s, at in _by_shard(owner)]
        out += [("hot", int(c), None, t.tolist()) for c, t in zip(names[~cold], totals[~cold])]
        out.append(("counts", shard, None, [int((counts == k).sum()) for k in (1, 2, 3, 4)]))
        return pa.table({"kind": [o[0] for o in out], "shard": pa.array([o[1] for o in out], pa.int64()),
                         "block": pa.array([o[2] for o in out], pa.binary()),
                         "sums": pa.array([o[3] for o in out], pa.list_(pa.int64()))})

    made = stored(_counted(rows, pair_keys, model.shard_of).groupBy("shard")
                  .applyInArrow(pairs, "kind string, shard long, block binary, sums array<long>"), "lm-pairs")

    def before(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        ids, n = _merged(table.column("block").to_pylist())
        dense = np.zeros(model.base[shard + 1] - model.base[shard], np.int64)
        dense[ids.astype(np.int64) - model.base[shard]] = n
        put_all(folder, f"before-{shard}", dense.astype(np.uint32) if dense.max() < 1 << 32 else dense)
        return pa.table({"sums": pa.array([[*(int((dense == k).sum()) for k in (1, 2, 3, 4)), int((dense >= 3).sum()),
                                           int(dense.sum())]], pa.list_(pa.int64()))})

    sums = [np.array(r.sums) for r in made.where("kind = 'before'").groupBy("shard")
            .applyInArrow(before, "sums array<long>").collect()]  # one row a shard
    n = np.sum(sums, axis=0) if sums else np.zeros(6, np.int64)
    model.words, model.word_total = Discounts.fit(n[:4]), int(n[5])
    if model.word_total:
        model.word_backoff = float(np.array([n[0], n[1], n[4]]) @ model.words.of[1:] / model.word_total)
    add = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(4)]
    rest = made.where("kind <> 'before'").groupBy("kind", "shard").agg(*add).collect()  # shards, and hot contexts: 4 a shard
    model.pairs = Discounts.fit(np.sum([[r.s0, r.s1, r.s2, r.s3] for r in rest if r.kind == "counts"] or [[0] * 4], axis=0))
    model.paired = frozenset(r.shard for r in rest if r.kind == "counts")
    hot = {r.shard: [r.s0, r.s1, r.s2, r.s3] for r in rest if r.kind == "hot"}
    model.hot_totals = np.array([hot.get(int(c), [0] * 4) for c in model.hot], np.int64).reshape(-1, 4)
    return model


def score(docs: DataFrame, model: Model, held_out: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), perplexity."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.col(f"`{text}`").alias("text"))

    def run(batches):
        for b in rounds(batches, "text"):
            out = model.score(b.column("text"))
            n = len(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(out["n_tokens"]), pa.array(out["n_known"]),
                 pa.array(np.full(n, model.tokens)), pa.array(out["base_score"]), pa.array(out["score"]),
                 pa.array(np.power(10.0, np.minimum(-out["score"] / out["n_tokens"], 300)))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
    return map_arrow(rows, run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                "base_score double, score double, perplexity double")
