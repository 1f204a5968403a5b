"""Integer vectors in clustered blocks, and searches that visit only the blocks their bounds admit.

Shared by the vector operators.  Rows become integer vectors (each component
times a scale, rounded down), get a measure to each of a few reference vectors
(distances or angles), and are dealt by their nearest reference and a bucket of
their label to clusters; a cluster of many rows is cut into blocks by a hash of
``vec_id``.  A search visits the few blocks with the greatest bounds first; the
scores found there are thresholds, and only blocks whose bounds still reach
them are visited after that.  A task holds one block and a batch of queries.
A block's rows lie in groups of near ones: the same bounds rule out a query's
groups, and what is left is scored by matrix products, which for vectors of
some dozen components cost less than any bound of a single pair.

Rows that take no part: a null ``vec_id``, vector or label (where there is
one), a null or non-finite component.  ``vec_id`` names one row: of several
that share it the least label, then vector, stays.  Shorter vectors count as
followed by zeros.  Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored

# products below are exact in floats, in doubles, in 64-bit integers
SHORT, EXACT, WIDE = 2.0 ** 23, 2.0 ** 52, 2.0 ** 62
LEAST, MOST = -(1 << 62), 1 << 62    # an open window
BUCKETS = 16                         # of labels
PAIRS = 1 << 22                      # of a query and a row, for a task
SCORED = 1 << 20                     # pairs, at a time
BLOCKS, MOST_ROWS = 64, 1 << 16      # a table's blocks, until they would hold so many rows each
GROUP = 256                          # rows of a block that bounds rule out together


@dataclass
class Rows:
    """Some rows: arrays by row."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray         # integers as int32, one row each
    norm: np.ndarray
    to: np.ndarray        # measure to each reference
    lo: np.ndarray | None = None   # windows of scores that a query asks for
    hi: np.ndarray | None = None

    @classmethod
    def of(cls, batch: pa.RecordBatch, refs: int) -> "Rows":
        def column(name):
            return batch.column(name).to_numpy(zero_copy_only=False)

        def lists(name, width, kind):
            return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind, copy=False)
        n = len(batch)
        rows = cls(column("vec_id"), column("label"), _matrix(batch), column("norm"), lists("to", refs, float))
        if "lo" in batch.schema.names and batch.column("lo").null_count == 0:
            width = len(batch.column("lo")[0]) if n else 1
            rows.lo, rows.hi = lists("lo", width, np.int64), lists("hi", width, np.int64)
        return rows

    def take(self, at) -> "Rows":
        return Rows(*(None if x is None else x[at] for x in
                      (self.ids, self.labels, self.v, self.norm, self.to, self.lo, self.hi)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, which all have one length."""
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def number_type(a: Rows, b: Rows) -> type:
    """The type in which the inner products of ``a`` with ``b``, and their parts, are exact."""
    most = float(a.norm.max(initial=0)) * float(b.norm.max(initial=0))
    if most < SHORT:
        return np.float32
    if most < EXACT:
        return np.float64
    if most < WIDE:
        return np.int64
    raise ValueError("inner products of these vectors pass 64 bits")


def integers(rows: DataFrame, scale: int, vector: str = "embedding", label: str | None = None) -> DataFrame:
    """Stored rows (vec_id, label, v, norm) of the rows that take part."""
    own = rows.select(F.col("`vec_id`").cast("long").alias("vec_id"),
                      (F.col(f"`{label}`").cast("long") if label else F.lit(0).cast("long")).alias("label"),
                      F.col(f"`{vector}`").cast("array<double>").alias("x"))
    own = own.where("vec_id is not null and label is not null and x is not null")
    width = max(1, own.agg(F.max(F.size("x"))).first()[0] or 0)

    def run(batches):
        for b in batches:
            lists = b.column("x")
            sizes = np.asarray(pc.list_value_length(lists))
            flat = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(b)), sizes)
            bad = np.zeros(len(b), bool)
            bad[row[~np.isfinite(flat)]] = True
            y = np.floor(np.where(np.isfinite(flat), flat, 0.0) * scale)
            if (np.abs(y[~bad[row]]) >= 2.0 ** 31).any():
                raise ValueError(f"a component times {scale} passes 32 bits")
            v = np.zeros((len(b), width))
            v[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.where(bad[row], 0, y)
            v, keep = v[~bad], pa.array(~bad)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").filter(keep), b.column("label").filter(keep),
                 pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * width, v.astype(np.int32).ravel()),
                 pa.array(np.sqrt((v * v).sum(axis=1)))],
                ["vec_id", "label", "v", "norm"])

    out = stored(map_arrow(own, run, "vec_id long, label long, v array<int>, norm double"), "vectors")
    if out.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        least = out.groupBy("vec_id").agg(F.min(F.struct("label", "v", "norm")).alias("row"))
        out = stored(least.select("vec_id", "row.*"), "vectors-by-id")
    return out


def references(rows: DataFrame, n: int, sample: int, unit: bool) -> np.ndarray:
    """``n`` vectors far from each other, from a sample of ``sample`` rows (by a hash of their ids); unit: of length 1."""
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    x = np.array([r.v for r in got], float)
    if not len(x):
        return np.zeros((0, 1))
    if unit:
        size = np.sqrt((x * x).sum(axis=1))
        x = x[size > 0] / size[size > 0, None]
        if not len(x):  # nothing but zeros: any direction will do
            return np.eye(1, len(got[0].v))
    picked, away = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(picked) < n and away.max() > 1e-9:
        picked.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[picked[-1]]) ** 2).sum(axis=1))
    return x[picked]


@dataclass
class Clusters:
    """What is known of each cluster: by reference the least and the greatest measure, norms, labels, blocks."""

    low: np.ndarray
    high: np.ndarray
    min_norm: np.ndarray
    max_norm: np.ndarray
    min_label: np.ndarray
    max_label: np.ndarray
    base: np.ndarray      # first block (of a group: first row)
    blocks: np.ndarray    # number of blocks (of a group: rows)
    n: int                # rows in all


@dataclass
class Index:
    rows: DataFrame       # blk, vec_id, label, v, norm, to
    clusters: Clusters
    refs: int


def build(rows: DataFrame, refs: np.ndarray, measure: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
          block: int) -> Index:
    """Deal rows to clusters by nearest reference and label bucket, and to blocks of about ``block`` rows.

    Blocks of a large table hold more, so that a query's visits don't grow with the table.
    """
    def run(batches):
        for b in batches:
            if len(b):
                to = measure(_matrix(b).astype(float), b.column("norm").to_numpy(), refs)
                offsets = np.arange(len(b) + 1, dtype=np.int32) * len(refs)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.ListArray.from_arrays(offsets, to.ravel()), pa.array(to.argmin(axis=1).astype(np.int32))],
                    [*b.schema.names, "to", "near"])

    n = len(refs)
    known = stored(map_arrow(rows, run, "vec_id long, label long, v array<int>, norm double, to array<double>, near int")
                   .withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int")), "vectors-measured")
    # at most BUCKETS * n rows, whatever the table's size
    got = known.groupBy("bucket", "near").agg(
        F.count("*").alias("n"), F.min("norm"), F.max("norm"), F.min("label"), F.max("label"),
        *(f(F.get("to", F.lit(k))) for f in (F.min, F.max) for k in range(n))).orderBy("bucket", "near").collect()
    table = np.array([tuple(r) for r in got], float).reshape(len(got), 7 + 2 * n)
    total = int(table[:, 2].sum())
    blocks = np.ceil(table[:, 2] / max(block, min(total // BLOCKS, MOST_ROWS))).astype(np.int64)
    base = np.cumsum(blocks) - blocks
    labels = np.array([(r[5], r[6]) for r in got], np.int64).reshape(-1, 2)
    clusters = Clusters(table[:, 7:7 + n], table[:, 7 + n:], table[:, 3], table[:, 4], labels[:, 0], labels[:, 1],
                        base, blocks, total)
    where = rows.sparkSession.createDataFrame(
        [(int(r[0]), int(r[1]), int(b), int(k)) for r, b, k in zip(got, base, blocks)],
        "bucket int, near int, base long, blocks long")
    dealt = known.join(F.broadcast(where), ["bucket", "near"]).select(
        (F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).alias("blk"), "vec_id", "label", "v", "norm", "to")
    return Index(dealt, clusters, n)


def grouped(block: Rows) -> tuple[Rows, Clusters]:
    """The rows, halved by the measure that spreads them most until ``GROUP`` or fewer lie together, and their groups."""
    parts, groups = [np.arange(len(block.ids))], []
    while parts:
        at = parts.pop()
        if len(at) <= GROUP:
            groups.append(at)
            continue
        to = block.to[at]
        half = len(at) // 2
        at = at[np.argpartition(to[:, np.ptp(to, axis=0).argmax()], half)]
        parts += [at[half:], at[:half]]
    own = block.take(np.concatenate(groups))
    size = np.array([len(at) for at in groups])
    base = np.cumsum(size) - size
    return own, Clusters(np.minimum.reduceat(own.to, base), np.maximum.reduceat(own.to, base),
                         np.minimum.reduceat(own.norm, base), np.maximum.reduceat(own.norm, base),
                         np.minimum.reduceat(own.labels, base), np.maximum.reduceat(own.labels, base), base, size, len(own.ids))


def reaching(q: Rows, low: np.ndarray, high: np.ndarray, may: np.ndarray) -> np.ndarray:
    """By query and cluster: whether scores from ``low`` to ``high`` meet one of the query's windows."""
    out = np.zeros(high.shape, bool)
    for j in range(q.lo.shape[1]):
        lo, hi = q.lo[:, j, None], q.hi[:, j, None]
        out |= (high >= lo) & (low <= hi) & (lo <= hi)
    return out & may


def scores(block: Rows, groups: Clusters, q: Rows, cluster_bounds) -> np.ndarray:
    """Inner products by query and row; below LEAST where the row's group is ruled out, and for the query's own row."""
    kind = number_type(block, q)
    rows, asked = block.v.astype(kind), q.v.astype(kind)
    reach = reaching(q, *cluster_bounds(q, groups))
    if reach.all():
        score = asked @ rows.T
    else:
        score = np.full((len(asked), len(rows)), below(kind), kind)
        for g in np.flatnonzero(reach.any(axis=0)).tolist():
            live, own = np.flatnonzero(reach[:, g]), slice(groups.base[g], groups.base[g] + groups.blocks[g])
            score[live, own] = asked[live] @ rows[own].T
    _, asking, row = np.intersect1d(q.ids, block.ids, assume_unique=True, return_indices=True)
    score[asking, row] = below(kind)
    return score


def below(kind: type) -> float | int:
    """A number of this type below every score and window."""
    return LEAST - 1 if np.issubdtype(kind, np.integer) else -np.inf


def highest(score: np.ndarray, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, row) of each query's ``k`` highest scores from ``lo`` to ``hi``, ties to lesser ids."""
    fits = score >= lo.astype(score.dtype)[:, None]
    if (hi < MOST).any():
        fits &= score <= hi.astype(score.dtype)[:, None]
    many = np.flatnonzero(np.count_nonzero(fits, axis=1) > k)
    if len(many):
        some = np.where(fits[many], score[many], score.dtype.type(below(score.dtype)))
        fits[many] = some >= np.partition(some, -k, axis=1)[:, -k, None]
    query, row = np.divmod(np.flatnonzero(fits), max(1, len(ids)))
    order = np.lexsort((ids[row], -score[query, row], query))
    query, row = query[order], row[order]
    first = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[first], row[first]


_ASK = "vec_id long, label long, v array<int>, norm double, to array<double>, lo array<long>, hi array<long>"
_FOUND = "query_id long, which int, vec_id long, score long"


def _route(asks: DataFrame, index: Index, cluster_bounds, first: bool, probe: int) -> DataFrame:
    """Rows (blk, query): the ``probe`` blocks of greatest bounds, or those after them that a window still reaches."""
    c, refs = index.clusters, index.refs

    def run(batches):
        for b in batches:
            for i in range(0, len(b), 64):
                part = b.slice(i, 64)
                q = Rows.of(part, refs)
                low, high, may = cluster_bounds(q, c)
                reach = reaching(q, low, high, may)
                high = np.where(may, high, -np.inf)
                order = np.argsort(-high, axis=1, kind="stable")
                lists = []
                for k in range(len(part)):
                    mine = order[k][may[k][order[k]]]
                    some = c.blocks[mine]
                    blk = np.repeat(c.base[mine], some) + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                    if first:
                        lists.append(blk[:probe])
                    else:
                        lists.append(blk[probe:][np.repeat(reach[k][mine], some)[probe:]])
                upto = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32)
                flat = pa.array(np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(upto, flat)],
                                                 [*part.schema.names, "blks"])
    return map_arrow(asks, run, _ASK + ", blks array<long>").select(F.explode("blks").alias("blk"), *asks.columns)


def _visit(index: Index, visits: DataFrame, match, per_task: int, queries: int) -> DataFrame:
    """Rows (query_id, which, vec_id, score) that ``match`` finds, a block and a batch of queries at a time."""
    copies = max(1, -(-queries // per_task))  # of each block, so that a task's queries are bounded too
    part = F.pmod(F.xxhash64("vec_id"), F.lit(copies))
    none = F.lit(None).cast("array<long>")
    held = index.rows.select("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("part"),
                             F.lit(0).alias("kind"), *(c for c in index.rows.columns if c != "blk"),
                             none.alias("lo"), none.alias("hi"))
    ask = visits.select("blk", part.cast("long").alias("part"), F.lit(1).alias("kind"),
                        *(c for c in visits.columns if c != "blk"))
    refs, total = index.refs, int(index.clusters.blocks.sum()) * copies
    spark = visits.sparkSession
    # tasks of some PAIRS pairs, were none ruled out
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), index.clusters.n * queries // PAIRS)

    def run(batches):
        parts, block, groups, current = [], None, None, None
        for b in batches:
            if not len(b):
                continue
            key = np.stack([b.column(c).to_numpy() for c in ("blk", "part", "kind")])
            cuts = np.append(np.append(0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), len(b))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own, kind = (int(key[0, i]), int(key[1, i])), key[2, i]
                if kind == 0:
                    if own != current:
                        parts, block, current = [], None, own
                    parts.append(Rows.of(b.slice(i, j - i), refs))
                    continue
                if own != current:
                    continue  # nothing lies there
                if block is None:
                    block, groups = grouped(Rows(*(np.concatenate([getattr(p, f) for p in parts])
                                                   for f in ("ids", "labels", "v", "norm", "to"))))
                    parts, some = [], max(1, SCORED // len(block.ids))
                for at in range(i, j, some):
                    q = Rows.of(b.slice(at, min(some, j - at)), refs)
                    query, which, ids, scores = match(block, groups, q)
                    if len(query):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(q.ids[query]), pa.array(which.astype(np.int32)), pa.array(ids),
                             pa.array(scores.astype(np.int64))], ["query_id", "which", "vec_id", "score"])
    dealt = held.unionByName(ask).repartition(max(1, min(total, tasks)), "blk", "part")
    return map_arrow(dealt.sortWithinPartitions("blk", "part", "kind"), run, _FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of each query and window, ties to lesser ids, with their rank."""
    order = Window.partitionBy("query_id", "which").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, asks: DataFrame, k: int, match, cluster_bounds, probe: int = 4,
           per_task: int = 1 << 16) -> DataFrame:
    """Rows (query_id, which, rank, vec_id, score): per query and window the ``k`` highest scores within it.

    ``asks``: rows of the index with their windows ``lo`` and ``hi`` (arrays of
    one length).  ``match(block, groups, queries)`` gives at least each window's
    ``k`` best of the block; ``cluster_bounds`` the least and the greatest score
    that a cluster, or a group, may hold, and whether it may hold partners at all.
    """
    asks = stored(asks, "vectors-asks")
    n = asks.count()
    found = stored(best(_visit(index, _route(asks, index, cluster_bounds, True, probe), match, per_task, n), k), "vectors-first")
    least = found.where(F.col("rank") == k).groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("which", "score"))).alias("least"))
    rest = asks.join(least.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    tight = F.transform("lo", lambda x, i: F.coalesce(F.greatest(x, F.element_at("least", i)), x))
    rest = rest.select(*(tight.alias("lo") if c == "lo" else F.col(c) for c in asks.columns))
    more = _visit(index, _route(rest, index, cluster_bounds, False, probe), match, per_task, n)
    return best(found.drop("rank").unionByName(more), k)


def windows(*bounds: tuple[Column, Column]) -> list[Column]:
    """Columns lo and hi of the given windows."""
    return [F.array(*(a.cast("long") for a, _ in bounds)).alias("lo"), F.array(*(b.cast("long") for _, b in bounds)).alias("hi")]
