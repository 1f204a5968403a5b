"""Hard negatives, exact top-k search and periodic runs against brute force."""

from __future__ import annotations

import random
import time

import brute
import numpy as np
import pytest
from cases import SF001, pairs, rows
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from vendorpulse.llm import hard_negatives, runs, topk, vectors
from vendorpulse.llm import queries as Q

VEC = "vec_id long, embedding array<double>, label int"
TOP = ("query_id", "rank", "vec_id", "score")
MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.fixture(scope="module")
def points():
    """Clustered vectors with copies, ties, zeros, short and empty ones, nulls and values that aren't finite."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    out = [(i, (centres[i % 6] + rng.normal(scale=0.5, size=12)).tolist(), int(rng.integers(4))) for i in range(240)]
    out += [(240 + i, out[5][1], i % 3) for i in range(60)]                   # copies
    out += [(300, [0.0] * 12, 1), (301, [0.0] * 12, 2), (302, [], 1), (303, [1.0, -2.0], 2), (304, None, 1),
            (305, [None] + [0.1] * 11, 1), (306, [float("nan")] * 12, 2), (307, [float("inf")] + [0.0] * 11, 1),
            (308, [0.5] * 12, None), (None, [0.5] * 12, 1), (310, (-centres[0]).tolist(), 0), (311, [1e4] * 12, 3)]
    out += [out[20], out[20], (40, [0.25] * 12, 0)]                           # repeated rows, and another of an id
    return out


@pytest.fixture(scope="module")
def embedded(spark, points):
    df = spark.createDataFrame(points, VEC).repartition(5)
    for c in ("blk", "v", "norm", "to", "near", "bucket", "score", "rank", "query_id", "lo", "kind"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.mark.parametrize("k,block,pivots,probe", [(20, 1024, 32, 4), (3, 16, 4, 1), (400, 64, 8, 2)])
def test_top_k_equals_brute_force(embedded, points, k, block, pivots, probe):
    got = topk.top_k(embedded, F.col("vec_id") % 20 == 0, k, 64, pivots=pivots, block=block, probe=probe)
    want = brute.top_k([(i, x, 0) for i, x, _ in points], lambda i: i % 20 == 0, k, 64)
    assert rows(got, *TOP) == sorted(want, key=str)


@pytest.mark.parametrize("options", [{}, {"block": 16, "directions": 3, "probe": 1},
                                     {"positives": 2, "negatives": 3, "low": 10, "high": 100, "scale": 32}])
def test_hard_negatives_equal_brute_force(embedded, points, options):
    got = hard_negatives.mine(embedded, F.col("vec_id") % 10 == 0, **options)
    method = {k: v for k, v in options.items() if k in ("positives", "negatives", "low", "high", "scale")}
    want = brute.hard_negatives(points, lambda i: i % 10 == 0, **method)
    assert len(want) > 100 and rows(got, *MINED) == sorted(want, key=str)


def test_vectors_that_dont_fit(spark, embedded):
    for df in (embedded.limit(0), embedded.where("embedding is null")):
        assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
        assert hard_negatives.mine(df, F.col("vec_id") % 20 == 0).count() == 0
    zeros = spark.createDataFrame([(i, [0.0, 0.0], i % 2) for i in range(6)], VEC)
    assert rows(topk.top_k(zeros, F.col("vec_id") == 2, 3), *TOP) == [(2, 1, 0, 0), (2, 2, 1, 0), (2, 3, 3, 0)]
    assert rows(hard_negatives.mine(zeros, F.col("vec_id") == 2, 1, 2), *MINED) == [(2, 0, 1, 1, 0, 0), (2, 0, 2, 3, 0, 0)]
    far = spark.createDataFrame([(1, [1e300], 1), (2, [1.0], 1)], VEC)
    with pytest.raises(Exception, match="passes 32 bits"):
        topk.top_k(far, F.col("vec_id") == 1).collect()


def test_products_beyond_doubles_are_exact(spark):
    big = [(i, [2.0 ** 30 - i, 2.0 ** 30 + 7 * i, -float(i)], i % 2) for i in range(12)]
    got = topk.top_k(spark.createDataFrame(big, VEC), F.col("vec_id") < 3, 5, scale=1)
    assert rows(got, *TOP) == sorted(brute.top_k(big, lambda i: i < 3, 5, 1), key=str)


@pytest.mark.parametrize("bounds", ["distance", "angle"])
def test_bounds_hold_the_score(bounds):
    rng = np.random.default_rng(2)
    v = rng.integers(-300, 300, (200, 9)).astype("<i4")
    v[0], v[1], v[2] = 0, v[3], -v[3]
    norm = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    if bounds == "distance":
        to = topk.distances(v.astype(float), norm, v[10:16].astype(float))
    else:
        to = hard_negatives.angles(v.astype(float), norm, v[10:16] / norm[10:16, None])
    r = vectors.Rows(np.arange(200), np.zeros(200), v, norm, to)
    score = v.astype(np.int64) @ v.T.astype(np.int64)
    if bounds == "distance":
        least = np.abs(to[:, None] - to[None]).max(axis=2)
        assert (topk._upper(norm[:, None], norm, least) >= score).all()
    else:
        low, high = hard_negatives.row_bounds(r, r)
        assert (low <= score).all() and (score <= high).all()
        assert (high - low < 2 * norm[:, None] * norm).mean() > 0.5  # and say something


def _laid(rng, n, start=0, clustered=False):
    """Rows as tasks hold them, of directions at random or near four centres, with their distances to eight vectors."""
    x = rng.normal(size=(n, 64)) + (30 * np.eye(4, 64)[np.arange(n) % 4] if clustered else 0)
    v = np.floor(64 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int32)
    norm = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    refs = 64 * np.eye(8, 64)
    return vectors.Rows(np.arange(start, start + n), np.zeros(n, np.int64), v, norm, topk.distances(v.astype(float), norm, refs))


@pytest.mark.parametrize("clustered", [False, True])
def test_groups_of_a_block_lose_no_score(clustered):
    rng = np.random.default_rng(8)
    rows, q = _laid(rng, 3000, 0, clustered), _laid(rng, 90, 5000, clustered)
    q.ids[:5], q.v[:5], q.norm[:5], q.to[:5] = rows.ids[:5], rows.v[:5], rows.norm[:5], rows.to[:5]   # rows of the block
    want = q.v.astype(np.int64) @ rows.v.T.astype(np.int64)
    want[np.arange(5), np.arange(5)] = -(1 << 40)
    order = np.lexsort((np.broadcast_to(rows.ids, want.shape), -want), axis=1)[:, :20]
    q.lo, q.hi = np.take_along_axis(want, order, 1)[:, -1:], np.full((90, 1), vectors.MOST)
    block, groups = vectors.grouped(rows)
    assert groups.blocks.sum() == 3000 and groups.blocks.max() <= vectors.GROUP
    assert sorted(block.ids.tolist()) == rows.ids.tolist()
    reach = vectors.reaching(q, *topk.cluster_bounds(q, groups))
    assert not clustered or reach.mean() < 0.7  # bounds do rule out groups
    for kind in (block, vectors.Rows(block.ids, block.labels, block.v, block.norm * 1e13, block.to)):   # floats, wide integers
        if kind is not block:
            assert vectors.number_type(kind, q) is np.int64
        query, _, ids, score = topk._match(20)(kind, groups, q)
        assert ids.tolist() == order.ravel().tolist() and query.tolist() == np.repeat(np.arange(90), 20).tolist()
        assert score.tolist() == np.take_along_axis(want, order, 1).ravel().tolist()


def test_pairs_that_bounds_keep_are_cheap():
    """Where bounds rule out nothing a pair costs its product, which is less than its place in an order of all."""
    rng = np.random.default_rng(4)
    rows, q = _laid(rng, 1000), _laid(rng, 1000, 2000)
    plain = q.v.astype(float) @ rows.v.T.astype(float)
    q.lo, q.hi = np.sort(plain, axis=1)[:, -5:-4].astype(np.int64), np.full((1000, 1), vectors.MOST)
    block, groups = vectors.grouped(rows)
    match = topk._match(20)
    assert vectors.reaching(q, *topk.cluster_bounds(q, groups)).mean() > 0.9

    def seconds(f):
        took = []
        for _ in range(5):
            start = time.thread_time()
            f()
            took.append(time.thread_time() - start)
        return min(took)
    assert seconds(lambda: match(block, groups, q)) < seconds(lambda: np.argsort(-plain, axis=1, kind="stable"))


def test_visits_dont_grow_with_the_table(spark):
    """Blocks of a large table hold more rows: a query sees no more of them."""
    df = spark.range(20_000).selectExpr("id as vec_id", "transform(sequence(1, 4), i -> sin(id * i)) as embedding")
    known = vectors.integers(df, 64)
    index = vectors.build(known, vectors.references(known, 4, 64, unit=False), topk.distances, 16)
    size = index.rows.groupBy("blk").count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
    assert index.clusters.blocks.sum() <= vectors.BLOCKS + 4 and index.clusters.n == 20_000   # were 1,250 blocks
    assert size[0] <= vectors.BLOCKS + 4 and size[1] < 1000 and size[2] == 20_000


def test_kinds_of_numbers():
    def of(norm):
        return vectors.Rows(np.arange(1), np.zeros(1), np.zeros((1, 1)), np.array([norm]), np.zeros((1, 1)))
    kinds = [vectors.number_type(of(a), of(b)) for a, b in ((2.0 ** 11, 2.0 ** 11), (2.0 ** 12, 2.0 ** 11), (2.0 ** 26, 2.0 ** 26))]
    assert kinds == [np.float32, np.float64, np.int64]


@pytest.mark.parametrize("kind", [np.float32, np.float64, np.int64])
def test_highest_keeps_ties_to_lesser_ids(kind):
    rng = np.random.default_rng(6)
    score, ids = rng.integers(-4, 4, (40, 90)).astype(kind), rng.permutation(90)
    score[3], score[rng.random((40, 90)) < 0.2] = vectors.below(kind), vectors.below(kind)
    lo = np.where(np.arange(40) % 3 == 0, vectors.LEAST, rng.integers(-3, 3, 40))
    hi = np.where(np.arange(40) % 4 == 0, vectors.MOST, rng.integers(-1, 4, 40))
    query, row = vectors.highest(score, lo, hi, ids, 7)
    got = [[] for _ in range(40)]
    for a, b in zip(query, row):
        got[a].append((-score[a, b], ids[b]))
    for a in range(40):
        fits = sorted((-s, i) for s, i in zip(score[a], ids) if lo[a] <= s <= hi[a])
        assert got[a] == fits[:7]


@pytest.mark.parametrize("name", ["op3_decontaminate", "op6_substring", "op11_hard_negatives", "op12_topk", "op13_runs"])
def test_queries_match_sql(spark, name):
    r = compare(spark, name, SF001, duck(SF001))
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"] > 0, r


# --- op13
@pytest.mark.parametrize("seed", range(4))
def test_periodic_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(250):
        least, times = rng.choice([(24, 3), (4, 2), (6, 3), (5, 2), (8, 4), (1, 2), (3, 3)])
        docs = []
        for _ in range(rng.randint(0, 4)):
            words = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.choice([0, 1, 2, 5, 30, 60]))]
            if words and rng.random() < 0.5:
                a = rng.randrange(len(words))
                p = 1 + (len(words) - a) // rng.randint(2, 9)
                words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            docs.append(words)
        first = np.cumsum([0, *map(len, docs)])
        got = runs.periodic_runs(np.array([w for d in docs for w in d], np.int64), first, least, times)
        want = [(f + s, f + s + n, q) for d, f in zip(docs, first.tolist()) for s, n, q in brute.runs(d, least, times)]
        assert [tuple(r) for r in got.tolist()] == want


def test_runs_of_long_texts():
    n = 50_000
    assert runs.periodic_runs(np.zeros(n, np.int64), np.array([0, n])).tolist() == [[0, n, 1]]
    once = np.random.default_rng(1).integers(0, 9000, n // 5)
    assert runs.periodic_runs(np.tile(once, 5), np.array([0, n])).tolist() == [[0, n, n // 5]]
    broken = np.where(np.arange(n) % 17 == 16, np.arange(n), np.arange(n) % 17)  # a phrase with other words between
    assert len(runs.periodic_runs(broken, np.array([0, n]))) == 0


def _collapsed(df):
    return rows(df.select("doc_id", "n_words", F.transform("runs", lambda x: F.array(x["start"], x["length"], x["period"]))
                          .alias("runs"), F.sha2("kept", 256).alias("kept")), "doc_id", "n_words", "runs", "kept")


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2)])
def test_collapse_equals_brute_force(spark, messy, empty, least, times):
    texts = pairs(messy)
    extra = [(900, "a b " * 40 + "c " + "d " * 30), (901, "\n".join(["x y z"] * 9) + " x"), (902, "ab a b " * 12)]
    docs = messy.select("doc_id", "text", "k", "n_words").unionByName(
        spark.createDataFrame([(*r, "", "") for r in extra], "doc_id long, text string, k string, n_words string"))
    want = []
    for d, t in texts + extra:
        words = brute.SPACE.findall(t or "")
        found = brute.runs(words, least, times) if len(words) < 5000 else [(0, len(words), 1)]
        want.append((d, len(words), [list(r) for r in found], brute.sha(brute.collapsed(words, found))))
    assert _collapsed(runs.collapse(docs, min_length=least, min_exponent=times)) == sorted(want, key=str)
    assert runs.collapse(empty).count() == 0


def test_op13_query(spark, small, messy, monkeypatch):
    for docs in (small, messy.where("char_length(text) < 20000 or text is null")):
        monkeypatch.setattr(Q, "table", lambda *_, d=docs: d)
        out = Q.QUERIES["op13_runs"](spark, SF001)
        want = brute.op13(pairs(docs))
        assert rows(out, *out.columns) == sorted(want, key=str)
        assert sum(r[1] for r in want) > 0
