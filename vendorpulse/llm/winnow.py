"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark text; a text of fewer
words, but not none, is one window.  Of every window, in documents and
benchmark alike, the least hash of its ``gram``-word runs is its fingerprint
(rightmost on ties), so equal windows always choose the same fingerprint at the
same place: joining fingerprints misses no shared window.  Hits are extended
to their whole window and kept if the window's 128-bit hash is the same.

The benchmark's windows go to every task only if they number at most
``broadcast_windows`` (they are counted first); beyond that the fingerprints
join by shuffle, and so do the extended windows.  Both ways give the same rows.

Nulls: a null text has no words; a null ``doc_id`` is kept; a null ``item_id``
is an item named by the empty text.  Repeated benchmark rows are one item,
repeated documents are judged each.  Empty tables give no hits or no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, map_arrow, stored
from .words import ALNUM_WORDS, U64, Words, run_hashes, slices, split_words, windowed_minimum

BROADCAST_WINDOWS = 500_000  # 32 bytes each
HITS = "array<struct<start:int,length:int>>"


def chosen_grams(w: Words, hashes: np.ndarray, window: int, gram: int):
    """Start of every window of ``window`` words, with the hash and place of its fingerprint."""
    gram = min(gram, window)
    at = w.run_starts(gram)
    values = run_hashes(hashes, at, at + gram)
    _, place, _ = windowed_minimum(values, np.searchsorted(at, w.first), window - gram + 1)
    return w.run_starts(window), values[place], at[place]


def merged(starts: np.ndarray, lengths: np.ndarray) -> list[dict]:
    """Ranges joined where they meet or overlap; ``starts`` ascending."""
    ends = np.maximum.accumulate(starts + lengths)
    new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    last = np.append(new[1:], len(starts)) - 1
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(starts[new], ends[last])]


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """Rows (n, g, h0, h1, item): each window's length, fingerprint, hash and item."""
    def run(batches):
        for b in slices(batches, text):
            w = split_words(b.column(text), ALNUM_WORDS, lower=True)
            x, y = w.hashes(0), w.hashes(1)
            ids, counts = b.column(item_id), w.counts
            for n in [*np.unique(counts[(counts > 0) & (counts < window)]), window]:
                at, g, _ = chosen_grams(w, x, int(n), gram)
                if n < window:
                    own = np.isin(at, w.first[:-1][counts == n])
                    at, g = at[own], g[own]
                doc = np.searchsorted(w.first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), n, np.int32)), pa.array(g.view(np.int64)),
                     pa.array(run_hashes(x, at, at + n).view(np.int64)),
                     pa.array(run_hashes(y, at, at + n, 1).view(np.int64)), ids.take(pa.array(doc))],
                    ["n", "g", "h0", "h1", "item"])
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias(item_id),
                             F.col(f"`{text}`").alias(text))
    return map_arrow(items, run, "n int, g long, h0 long, h1 long, item string").distinct()


class Index:
    """A bounded benchmark's windows as sorted arrays, by window length."""

    def __init__(self, rows):
        self.by_length = {}
        for n in np.unique(rows["n"]):
            at = np.flatnonzero(rows["n"] == n)
            h0 = rows["h0"][at].view(U64)
            at = at[np.argsort(h0, kind="stable")]
            self.by_length[int(n)] = (np.unique(rows["g"][at].view(U64)), rows["h0"][at].view(U64),
                                      rows["h1"][at].view(U64), rows["item"][at])

    def judge(self, column: pa.Array, gram: int):
        """Per text: number of words, covered word ranges, items found."""
        w = split_words(column, ALNUM_WORDS, lower=True)
        x, y = w.hashes(0), None
        found = []  # (start, length, item)
        for n, (grams, h0, h1, items) in self.by_length.items():
            at, g, _ = chosen_grams(w, x, n, gram)
            p = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
            at = at[grams[p] == g]
            if not len(at):
                continue
            y = w.hashes(1) if y is None else y
            a, b = run_hashes(x, at, at + n), run_hashes(y, at, at + n, 1)
            lo, hi = np.searchsorted(h0, a), np.searchsorted(h0, a, side="right")
            many = hi - lo
            which = np.repeat(np.arange(len(at)), many)
            at_index = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + lo[which]
            same = h1[at_index] == b[which]
            found.append((at[which[same]], np.full(same.sum(), n), items[at_index[same]]))
        hits, names = [[] for _ in range(len(column))], [[] for _ in range(len(column))]
        if found:
            at, n, item = (np.concatenate(f) for f in zip(*found))
            order = np.argsort(at, kind="stable")
            at, n, item = at[order], n[order], item[order]
            doc = np.searchsorted(w.first, at, side="right") - 1
            cuts = np.flatnonzero(np.diff(doc)) + 1
            for a, k, i, d in zip(*(np.split(v, cuts) for v in (at, n, item, doc))):
                if len(d):
                    hits[d[0]] = merged(a - w.first[d[0]], k)
                    names[d[0]] = sorted(set(i))
        return w.counts, hits, names


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
             item_id: str = "item_id", item_text: str = "text", window: int = 13, gram: int = 5,
             broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """All columns of ``docs`` and one struct column ``overlap`` (n_words, hits, items)."""
    out = free_name(docs, "overlap")
    windows = stored(item_windows(benchmark, item_id, item_text, window, gram), "decontaminate-windows")
    kind = T.StructType.fromDDL(f"n_words long, hits {HITS}, items array<string>")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, kind)])
    if windows.count() > broadcast_windows:
        return _by_shuffle(docs, windows, text, window, gram, out, kind)
    pdf = windows.toPandas()
    index = docs.sparkSession.sparkContext.broadcast(Index({c: pdf[c].to_numpy() for c in pdf}))

    def run(batches):
        for b in slices(batches, text):
            n, hits, items = index.value.judge(b.column(text), gram)
            struct = pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()),
                 pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                 pa.array(items, pa.list_(pa.string()))], ["n_words", "hits", "items"])
            yield pa.RecordBatch.from_arrays([*b.columns, struct], [*b.schema.names, out])
    return docs.mapInArrow(run, schema)


def _by_shuffle(docs: DataFrame, windows: DataFrame, text: str, window: int, gram: int, out: str,
                kind: T.StructType) -> DataFrame:
    """The same rows for a benchmark of any size.  Documents are told apart by their text alone."""
    lengths = [int(r.n) for r in windows.select("n").distinct().collect()]  # at most ``window`` values
    bodies = (docs.select(F.col(f"`{text}`").alias("text")).where("text is not null").distinct()
              .select(F.sha2("text", 256).alias("body"), "text"))

    def fingerprints(batches):
        for b in slices(batches, "text"):
            w = split_words(b.column("text"), ALNUM_WORDS, lower=True)
            x = w.hashes(0)
            for n in lengths:
                at, g, _ = chosen_grams(w, x, n, gram)
                new = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (g[1:] != g[:-1]))) if len(at) else at
                doc = np.searchsorted(w.first, at[new], side="right") - 1
                last = np.append(new[1:], len(at))[: len(new)] - 1
                yield pa.RecordBatch.from_arrays(
                    [b.column("body").take(pa.array(doc)), pa.array(np.full(len(new), n, np.int32)),
                     pa.array(g[new].view(np.int64)), pa.array((at[new] - w.first[doc]).astype(np.int32)),
                     pa.array((at[last] - at[new] + 1).astype(np.int32))], ["body", "n", "g", "start", "many"])

    met = (map_arrow(bodies, fingerprints, "body string, n int, g long, start int, many int")
           .join(windows.select("n", "g").distinct(), ["n", "g"], "left_semi")
           .groupBy("body").agg(F.collect_set(F.struct("n", "start", "many")).alias("met")))

    def extend(batches):
        for b in slices(batches, "text"):
            w = split_words(b.column("text"), ALNUM_WORDS, lower=True)
            x, y = w.hashes(0), w.hashes(1)
            rows = [(d, r["n"], r["start"] + i) for d, m in enumerate(b.column("met").to_pylist())
                    for r in m for i in range(r["many"])]
            doc, n, start = (np.array(v, np.int64) for v in zip(*rows))
            at = start + w.first[doc]
            yield pa.RecordBatch.from_arrays(
                [b.column("body").take(pa.array(doc)), pa.array(n.astype(np.int32)), pa.array(start.astype(np.int32)),
                 pa.array(run_hashes(x, at, at + n).view(np.int64)),
                 pa.array(run_hashes(y, at, at + n, 1).view(np.int64))], ["body", "n", "start", "h0", "h1"])

    hits = (bodies.join(met, "body").mapInArrow(extend, "body string, n int, start int, h0 long, h1 long")
            .join(windows, ["n", "h0", "h1"])
            .groupBy("body").agg(F.array_sort(F.collect_set(F.struct("start", F.col("n").alias("length")))).alias("hits"),
                                 F.array_sort(F.collect_set("item")).alias("items")))
    # ranges in order of their start: a new one opens where a gap is, else the last one grows
    hits = hits.withColumn("hits", F.expr(
        "aggregate(hits, cast(array() as array<struct<start:int,length:int>>), (done, x) -> "
        "if(size(done) > 0 and element_at(done, -1).start + element_at(done, -1).length >= x.start, "
        "concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'length', "
        "greatest(element_at(done, -1).length, x.start + x.length - element_at(done, -1).start)))), "
        "concat(done, array(x))))"))
    n_words = F.size(F.expr(r"regexp_extract_all(translate(`%s`, '%s', '%s'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)"
                            % (text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))).cast("long")
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                      F.sha2(F.col(f"`{text}`"), 256).alias("body"),
                      F.coalesce(F.when(F.col(f"`{text}`").isNull(), F.lit(0)).otherwise(n_words), F.lit(0)).alias("n_words"))
    none = F.struct(F.col("n_words"), F.coalesce("hits", F.expr(f"cast(array() as {HITS})")).alias("hits"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
    return row.join(hits, "body", "left").select("row.*", none.cast(kind).alias(out))


def n_hit(overlap: str = "overlap") -> Column:
    return F.aggregate(F.col(f"{overlap}.hits"), F.lit(0).cast("long"), lambda a, x: a + x["length"])


def contaminated(overlap: str = "overlap", share: int = 20) -> Column:
    """A hit, and one word in ``share`` or more is hit."""
    return (n_hit(overlap) > 0) & (n_hit(overlap) * share >= F.col(f"{overlap}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that aren't contaminated, with their columns."""
    judged = overlaps(docs, benchmark, **options)
    out = judged.columns[-1]
    return judged.where(~contaminated(out)).select(*(judged[f"`{c}`"] for c in docs.columns))
