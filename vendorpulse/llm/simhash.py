"""SimHash near-duplicates: deletion-variant signatures.

Fingerprints link at ``max_distance`` or fewer differing bits.  The 64 bits are
cut into ``max_distance // 2 + 1`` segments: of that many segments one differs
by at most one bit.  Every distinct fingerprint is indexed under each segment's
one-wildcard variants (the segment without one of its bits); equal variants
join, and the whole distance is verified.

Copies collapse to one node before anything is joined, so a group of exact
copies costs one row.  A variant shared by more than ``dense`` distinct
fingerprints isn't paired up: its members look their possible neighbours up by
equality instead (every pattern of differing bits that this variant admits),
which grows with the members, not with their square.  Both ways are exact.
Components come from alternating star steps, each written to the shared folder.
No side whose size Spark guesses is broadcast: such joins are by sort and merge;
aggregates behind an exchange are, if they are measured to be small.

Nulls: a null text has no words and fingerprint zero, as any text without
words; a null ``doc_id`` is kept, and stands below every other id.  Repeated
rows and ties are copies.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, map_arrow, merged, stored, texts
from .words import SPACE_WORDS, U64, slices, split_words, xxh64

SEED = 42


def text_fingerprints(column: pa.Array, shingle: int = 3) -> np.ndarray:
    """Signed 64-bit fingerprint of each text: a bit is 1 if set in over half the shingle hashes."""
    w = split_words(column, SPACE_WORDS, lower=True)
    data, starts, ends = w.normal()
    n = w.counts
    whole = np.flatnonzero((n > 0) & (n < shingle))
    at = w.run_starts(shingle)
    first = np.concatenate([at, w.first[whole]])
    last = np.concatenate([at + shingle, w.first[whole + 1]]) - 1
    doc = np.concatenate([w.doc()[at], whole])
    order = np.argsort(doc, kind="stable") if len(whole) else slice(None)
    doc = doc[order]
    h = xxh64(data, starts[first[order]], ends[last[order]], SEED)
    out = np.zeros(len(n), U64)
    if len(doc):
        begins = np.flatnonzero(np.diff(doc, prepend=-1))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
        total = np.diff(np.append(begins, len(doc)))
        packed = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
        out[doc[begins]] = packed.view("<u8").ravel()
    return out.view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3) -> DataFrame:
    """One row per row: doc_id, fp."""
    def run(batches):
        for b in slices(batches, text):
            yield pa.RecordBatch.from_arrays(
                [b.column(doc_id).cast(pa.int64()), pa.array(text_fingerprints(b.column(text), shingle))], ["doc_id", "fp"])
    return map_arrow(texts(docs, doc_id, text), run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(max_distance: int) -> list[int]:
    """Bit masks of the segments."""
    n = max_distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _bit_masks(max_distance: int) -> tuple[list[int], list[int]]:
    """Per bit: the mask of its segment; the lowest bit of its segment."""
    masks, low = [], []
    for m in segments(max_distance):
        for _ in range(bin(m).count("1")):
            masks.append(m)
            low.append((m & -m).bit_length() - 1)
    return masks, low


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(_signed(v)).cast("long") for v in values))


def variants(nodes: DataFrame, max_distance: int) -> DataFrame:
    """Rows (bit, key, fp): the fingerprint's segment that holds ``bit``, without that bit."""
    masks, _ = _bit_masks(max_distance)
    keep = _longs([m & ~(1 << b) for b, m in enumerate(masks)])
    return (nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
            .select("bit", F.col("fp").bitwiseAND(F.element_at(keep, F.col("bit") + 1)).alias("key"), "fp"))


def links(nodes: DataFrame, max_distance: int = 2, dense: int = 256) -> DataFrame:
    """All pairs (a < b) of distinct fingerprints at 1 to ``max_distance`` differing bits, each once."""
    masks, low = _bit_masks(max_distance)
    index = variants(nodes, max_distance)
    size = index.groupBy("bit", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(merged(index, size, ["bit", "key"]), "simhash-variants")  # only variants that someone shares

    few, many = met.where(F.col("n") <= dense), met.where(F.col("n") > dense)
    xor = F.col("a").bitwiseXOR(F.col("b"))
    inside = xor.bitwiseAND(F.element_at(_longs(masks), F.col("bit") + 1))
    # of the variants that a pair shares in a segment: its differing bit, or the segment's lowest if none differs
    own = (inside == F.element_at(_longs([1 << b for b in range(64)]), F.col("bit") + 1)) | (
        (inside == 0) & (F.col("bit") == F.element_at(F.array(*map(F.lit, low)), F.col("bit") + 1)))
    pairs = (merged(few.select("bit", "key", F.col("fp").alias("a")), few.select("bit", "key", F.col("fp").alias("b")), ["bit", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(xor) <= max_distance) & own)
             .select("a", "b"))
    if many.limit(1).count():
        pairs = pairs.unionByName(_dense_links(many, nodes, max_distance, masks, low))
    return pairs.distinct()


def _dense_links(many: DataFrame, nodes: DataFrame, max_distance: int, masks: list[int], low: list[int]) -> DataFrame:
    """Pairs within shared variants of many members, by looking up each neighbour that the variant admits."""
    flips = []
    for bit, mask in enumerate(masks):
        rest = [b for b in range(64) if not mask >> b & 1]
        inner = [1 << bit] + [0] * (bit == low[bit])
        outer = [sum(1 << b for b in c) for n in range(max_distance + 1) for c in combinations(rest, n)]
        flips.append(sorted({i ^ o for i in inner for o in outer if 0 < bin(i ^ o).count("1") <= max_distance}))
    spark = many.sparkSession
    rows = [(b, _signed(x)) for b, xs in enumerate(flips) for x in xs]
    table = spark.createDataFrame(rows, "bit int, flip long")  # a fixed table: it depends on max_distance alone
    ask = (many.select("bit", "fp").distinct().join(F.broadcast(table), "bit")
           .select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("b"))
           .where("a < b"))
    # the partner shares the variant, so it is among the dense as well: asking from the lesser side is enough
    return merged(ask, nodes.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, root): every node of an edge with the least node that it reaches.

    Alternating large-star and small-star steps: neighbours above a node move
    to its least neighbour, then those below it.  Each step aggregates before
    its join, so a node with very many neighbours is split like any join key.
    """
    both = lambda e: e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    cur = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "simhash-links")
    before = None
    for _ in range(rounds):
        nb = both(cur)
        least = nb.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # left joins, though every node has its least: the edges, whose size is a guess, can't be the side to broadcast
        large = nb.where("v > u").join(least, "u", "left").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(~F.col("u").eqNullSafe(F.col("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u", "left").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = stored(joined.where(~F.col("u").eqNullSafe(F.col("v")))
                     .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "simhash-stars")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _groups(docs: DataFrame, text: str, doc_id: str, shingle: int, max_distance: int, dense: int):
    """Stored rows (doc_id, fp) of all documents, and (fp, root, least, component) of all fingerprints."""
    fps = stored(fingerprints(docs, text, doc_id, shingle), "simhash-fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id"))
                                         .alias("least")), "simhash-nodes")
    roots = components(links(nodes, max_distance, dense))
    labels = merged(nodes, roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    first = labels.groupBy("root").agg(F.min(F.struct("least", "fp")).alias("component"))
    return fps, stored(labels.join(first, "root", "left"), "simhash-components")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                    max_distance: int = 2, dense: int = 256) -> DataFrame:
    """One row per row: doc_id, fp, component_id (least doc_id that links reach)."""
    fps, groups = _groups(docs, text, doc_id, shingle, max_distance, dense)
    return merged(fps, groups.select("fp", F.col("component.least.doc_id").alias("component_id")), "fp")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                max_distance: int = 2, dense: int = 256) -> DataFrame:
    """The documents without those that a document of lesser id is linked to, with their columns."""
    fps, groups = _groups(docs, text, doc_id, shingle, max_distance, dense)
    own, of_first, id_of_first = (free_name(docs, c) for c in ("fp", "first_fp", "first_id"))
    first = groups.where(F.col("component.fp") == F.col("fp")).select(
        F.col("fp").alias(of_first), F.col("least.doc_id").alias(id_of_first))
    if not fps.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").limit(1).count():
        return merged(docs, first, docs[f"`{doc_id}`"] == F.col(id_of_first), "left_semi")
    # ids that don't tell rows apart: find the rows by fingerprint, and keep one of those that still agree
    schema = T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())])

    def run(batches):
        for b in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text_fingerprints(b.column(text), shingle))],
                                             [*b.schema.names, own])
    rows = docs.mapInArrow(run, schema)
    rows = merged(rows, first, (F.col(own) == F.col(of_first))
                  & rows[f"`{doc_id}`"].eqNullSafe(F.col(id_of_first)), "left_semi")
    return rows.groupBy(own).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("row")).select("row.*")


def hex64(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
