"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of tokens (its documents one after another, each ended
by an end token).  Queues are served ``quantum`` tokens at a time.  A queue
earns credit in proportion to its target share and is served when its credit
reaches half a quantum, so what it lacks or has too much is carried to the next
windows, whatever partition holds them.  Served quanta follow one another
without gaps; every ``window`` tokens are a sequence, and only the last one can
need padding.  A queue that runs dry leaves its turns to the others.

The quantum is the window cut by the number of queues (:func:`quantum_of`), so
that every window can hold every source of about average share.  While no queue
runs dry, a queue's tokens up to any window's end differ from its target by
(1 + share * queues) / 2 quanta at most, and in one window by twice that: credit
is rounded to half a quantum for each queue, and the round's length with it.

Quantum j of queue q is due at (2j + 1) periods, a queue's period being the
inverse of its share.  Its place in the round is the number of quanta due
earlier, a sum over the queues, so every document finds its places alone, from
the queues' lengths and its own place in its queue: no task holds a queue, and
a source with a third of all rows is just a longer one.  A task's documents lie
close together in the round, so it lists the quanta due in that stretch once
instead of summing over the queues for each of its own (:meth:`Schedule.places`).
Every source has a queue of its own, however many there are; the plan (a name
and three numbers a source) passes the driver.

Nulls: a null text is empty (its end token alone); a null source is a queue of
its own; a null ``doc_id`` is kept.  Repeated rows are packed each.  An empty
table gives no pieces.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .words import slices

_WIDE = re.compile(r"\s\s")
_CACHE_WORDS = 500_000


class Encoder:
    """Token ids of a byte-level BPE file, word by word.

    A blank after a non-blank always starts a new pre-token, so a text without
    two blanks in a row has the tokens of its first word and of each further
    word with the blank before it; those are kept for words met again.  Other
    texts, and texts that hold a special token, are encoded whole.  ``ranks``
    names the same vocabulary as a rank file, which encodes new words faster.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.full.get_vocab_size() <= 1 << 16 else "<u4")
        self.fast = self.size = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                          special_tokens={})
            self.size = np.zeros(max(table.values()) + 1, np.int64)
            for token, i in table.items():
                self.size[i] = len(token)
        self.words: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, words: list[str]) -> None:
        if len(self.words) + len(words) > _CACHE_WORDS:
            self.words.clear()
        if self.fast is None:
            for w, e in zip(words, self.full.encode_batch([" " + w for w in words], add_special_tokens=False)):
                self.words[w] = np.array(e.ids, self.kind).tobytes()
            return
        self.words[""] = self.whole(" ")
        words = [w for w in words if w]
        ids = np.array(self.fast.encode_ordinary("".join([" " + w for w in words])), np.int64)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        cuts = np.append(0, np.searchsorted(np.cumsum(self.size[ids]), ends) + 1) * self.kind.itemsize
        data, cuts = ids.astype(self.kind).tobytes(), cuts.tolist()
        self.words.update((w, data[a:b]) for w, a, b in zip(words, cuts, cuts[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of an array of ``kind``."""
        known, out = self.words, []
        new: set[str] = set()
        for text in texts:
            if _WIDE.search(text) or any(s in text for s in self.special):
                out.append(None)
                continue
            words = text.split(" ")
            parts = list(map(known.get, words[1:-1]))
            if None in parts:
                gaps = [k for k, x in enumerate(parts) if x is None]
                new.update(words[k + 1] for k in gaps)
                out.append((words, parts, gaps))
            else:
                out.append((words, parts, ()))
        missing = list(new)
        for i in range(0, len(missing), 100_000):
            self._learn(missing[i: i + 100_000])
        for i, found in enumerate(out):
            try:
                if found is None:
                    out[i] = self.whole(texts[i])
                    continue
                words, parts, gaps = found
                for k in gaps:
                    parts[k] = known[words[k + 1]]
                out[i] = self._head(words[0]) + b"".join(parts) + self._last(words)
            except KeyError:  # forgotten meanwhile
                out[i] = self.whole(texts[i])
        return out

    def _head(self, word: str) -> bytes:
        """A text's first word, which has no blank before it."""
        if word not in self.heads:
            if len(self.heads) >= _CACHE_WORDS:
                self.heads.clear()
            self.heads[word] = self.whole(word)
        return self.heads[word]

    def _last(self, words: list[str]) -> bytes:
        """A text's last word with its blank, which nothing follows."""
        if len(words) == 1:
            return b""
        return (self.words.get(words[-1]) if words[-1] else None) or self.whole(" " + words[-1])


_encoders: dict[tuple, Encoder] = {}


def tokenized(docs: DataFrame, path: str, ranks: str | None, text: str, doc_id: str, source: str,
              end_id: int) -> DataFrame:
    """Rows (doc_id, queue, part, start, n, ids), stored; start: place in the queue's tokens of this part."""
    src = F.col(f"`{source}`").cast("string")
    queue = F.when(src.isNull(), F.lit("null")).otherwise(F.concat(F.lit("source "), src))

    def run(batches):
        if (path, ranks) not in _encoders:
            _encoders[path, ranks] = Encoder(path, ranks)
        encoder = _encoders[path, ranks]
        part, served = TaskContext.get().partitionId(), {}
        end = np.array([end_id], encoder.kind).tobytes()
        for b in slices(batches, "text"):
            ids = [x + end for x in encoder.encode([t or "" for t in b.column("text").to_pylist()])]
            n = [len(x) // encoder.kind.itemsize for x in ids]
            starts = []
            for q, k in zip(b.column("queue").to_pylist(), n):
                starts.append(served.get(q, 0))
                served[q] = starts[-1] + k
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("queue"), pa.array([part] * len(n), pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "queue", "part", "start", "n", "ids"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), queue.alias("queue"),
                       F.col(f"`{text}`").alias("text"))
    return stored(map_arrow(rows, run, "doc_id long, queue string, part int, start long, n long, ids binary"),
                  "packing-tokens", compression="zstd")


MIN_QUANTUM = 32       # tokens; smaller pieces are of no use
_DIRECT, _BLOCK = 1 << 22, 4096
_HORIZON = 1 << 61


def quantum_of(window: int, queues: int) -> int:
    """The largest divisor of the window that gives every queue a turn in it, or ``MIN_QUANTUM`` if that is more."""
    most = max(min(MIN_QUANTUM, window), window // max(queues, 1))
    return next(q for q in range(min(most, window), 0, -1) if window % q == 0)


def targets(tokens: dict[str, int], shares: dict[str, float] | None, alpha: float) -> dict[str, float]:
    """Each queue's target: the given shares, else in proportion to its tokens to the power of ``alpha``."""
    if shares is None:
        return {q: float(n) ** alpha for q, n in tokens.items()}
    unknown = sorted(set(shares) - set(tokens))
    if unknown:
        raise ValueError(f"shares name queues that the documents don't have: {unknown[:5]}")
    if any(not x >= 0 or x == float("inf") for x in shares.values()) or not any(x > 0 for x in shares.values()):
        raise ValueError("shares must be numbers of 0 and more, one of them above 0")
    return {q: float(shares.get(q, 0.0)) for q in tokens}


class Schedule:
    """Places of the queues' quanta in the round: by due time, then by queue.

    Due times are whole numbers, (2j + 1) * period; periods are rounded to some
    2^-20 of the greatest share's.  Queues without a target follow when all
    others have run dry, in proportion to their tokens.
    """

    def __init__(self, tokens: dict[str, int], wanted: dict[str, float], quantum: int):
        self.names = sorted(tokens)
        self.index = {q: i for i, q in enumerate(self.names)}
        self.quantum = quantum
        total = np.array([tokens[q] for q in self.names], np.int64)
        self.quanta = -(-total // quantum)
        want = np.array([wanted.get(q, 0.0) for q in self.names], float)
        self.period, self.after = np.ones(len(total), np.int64), np.zeros(len(total), np.int64)
        end = 0
        for group, weight in ((want > 0, want), (want <= 0, total.astype(float))):
            if group.any():
                ratio = weight[group].max() / weight[group]
                unit = min(1 << 20, int((_HORIZON - end) / (2 * ratio * (self.quanta[group] + 1)).max()))
                if unit < 1 << 8:
                    raise ValueError("the shares are too far apart for the queues' lengths")
                self.period[group] = np.maximum(1, np.rint(ratio * unit)).astype(np.int64)
                self.after[group] = end
                end = int((self.after + 2 * self.quanta * self.period)[group].max())
        short = self.quanta * quantum - total
        last = np.flatnonzero(short > 0)
        at = self.places(last, self.quanta[last] - 1) if len(last) else np.zeros(0, np.int64)
        order = np.argsort(at)
        self.short_at, self.short = at[order], np.append(0, np.cumsum(short[last][order]))

    def _before(self, due: np.ndarray) -> np.ndarray:
        """How many quanta of each queue (last axis) are due before the times."""
        return np.clip(-((self.after + self.period - due) // (2 * self.period)), 0, self.quanta)

    def _direct(self, queue: np.ndarray, due: np.ndarray) -> np.ndarray:
        """Places by a sum over the queues."""
        out, step = np.empty(len(queue), np.int64), max(1, _DIRECT // len(self.names))
        others = np.arange(len(self.names))
        for i in range(0, len(queue), step):
            # of those due at once, the lesser queues come first
            out[i: i + step] = self._before(due[i: i + step, None] + (others < queue[i: i + step, None])).sum(axis=1)
        return out

    def places(self, queue: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of quanta due before quantum ``j`` of each queue (of those due at once, by queue)."""
        due = self.after[queue] + (2 * j + 1) * self.period[queue]
        if len(queue) * len(self.names) <= _DIRECT:
            return self._direct(queue, due)
        order = np.argsort(due, kind="stable")
        bounds = np.append(due[order[::_BLOCK]], due[order[-1]] + 1)
        bounds = bounds[np.append(True, bounds[1:] != bounds[:-1])]
        cut = np.searchsorted(due[order], bounds)
        out = np.empty(len(queue), np.int64)
        for lo, hi, low, high in zip(cut[:-1], cut[1:], bounds[:-1], bounds[1:]):
            own, first = order[lo:hi], self._before(low)
            many = self._before(high) - first
            if many.sum() > min(_DIRECT, len(own) * len(self.names)):
                out[own] = self._direct(queue[own], due[own])
                continue
            # all quanta due in this stretch, in order
            of = np.repeat(np.arange(len(many)), many)
            begin = np.cumsum(many) - many
            time = self.after[of] + (2 * (first[of] + np.arange(len(of)) - begin[of]) + 1) * self.period[of]
            rank = np.empty(len(of), np.int64)
            rank[np.lexsort((of, time))] = np.arange(len(of))
            out[own] = first.sum() + rank[begin[queue[own]] + j[own] - first[queue[own]]]
        return out

    def positions(self, queue: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Tokens before each quantum, the last quanta of queues being shorter."""
        at = self.places(queue, j)
        return at * self.quantum - self.short[np.searchsorted(self.short_at, at)]


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, window: int = 1024, quantum: int | None = None,
         shares: dict[str, float] | None = None, alpha: float = 1.0, text: str = "text", doc_id: str = "doc_id",
         source: str = "source", end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, queue, start, length, ids (bytes of 32-bit little-endian ids), doc_tokens,
    sequence_id, offset.

    ``shares`` gives target proportions by queue ("source NAME", "null"); names
    that no document has are refused, and queues that it doesn't name follow
    the others.  Without it targets are the queues' tokens to the power of
    ``alpha``: 1 for the corpus's own mixture, less to bring small sources
    forward.  ``quantum`` (a divisor of the window) is :func:`quantum_of` if None.
    """
    if quantum is not None and window % quantum:
        raise ValueError("quantum must divide window")
    tokens = tokenized(docs, tokenizer, ranks, text, doc_id, source, end_id)
    parts = stored(tokens.groupBy("part", "queue").agg(F.sum("n").alias("n")), "packing-parts")
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(parts.select("part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                  "packing-bases")
    sizes = {r.queue: r.n for r in parts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # a row a source
    quantum = quantum or quantum_of(window, len(sizes))
    sent = docs.sparkSession.sparkContext.broadcast(Schedule(sizes, targets(sizes, shares, alpha), quantum) if sizes else None)

    def run(batches):
        plan = sent.value
        for b in slices(batches, "ids"):
            raw, n = b.column("ids").to_pylist(), b.column("n").to_numpy()
            begin = b.column("start").to_numpy() + b.column("base").to_numpy()
            queue = np.array([plan.index[q] for q in b.column("queue").to_pylist()], np.int64)
            many = (begin + n - 1) // quantum - begin // quantum + 1
            doc = np.repeat(np.arange(len(n)), many)
            j = begin[doc] // quantum + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            lo, hi = np.maximum(j * quantum, begin[doc]), np.minimum((j + 1) * quantum, (begin + n)[doc])
            at = plan.positions(queue[doc], j) + lo - j * quantum
            # a quantum that crosses a sequence's end is cut there
            cut = np.minimum(hi - lo, window - at % window)
            rest = np.flatnonzero(cut < hi - lo)
            doc = np.concatenate([doc, doc[rest]])
            at = np.concatenate([at, at[rest] + cut[rest]])
            length = np.concatenate([cut, (hi - lo)[rest] - cut[rest]])
            start = np.concatenate([lo, lo[rest] + cut[rest]]) - begin[doc]
            order = np.lexsort((start, doc))
            doc, at, length, start = doc[order], at[order], length[order], start[order]
            # pieces of a document that stay together in a sequence are one
            joins = np.append(False, (doc[1:] == doc[:-1]) & (at[1:] == at[:-1] + length[:-1]) & (at[1:] % window != 0))
            first = np.flatnonzero(~joins)
            length = np.add.reduceat(length, first) if len(first) else length
            doc, at, start = doc[first], at[first], start[first]
            kind = np.dtype("<u2" if len(raw) and len(raw[0]) == 2 * n[0] else "<u4")
            wide = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in raw]
            pieces = [wide[d][4 * s: 4 * (s + k)] for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc)), b.column("queue").take(pa.array(doc)), pa.array(start),
                 pa.array(length), pa.array(pieces, pa.binary()), pa.array(n[doc]), pa.array(at // window),
                 pa.array(at % window)],
                ["doc_id", "queue", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return map_arrow(tokens.join(base, ["part", "queue"]).select("doc_id", "queue", "start", "n", "ids", "base"), run,
                     "doc_id long, queue string, start long, length long, ids binary, doc_tokens long, "
                     "sequence_id long, offset long")
