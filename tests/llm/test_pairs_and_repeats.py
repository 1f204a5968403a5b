"""Winnowing, substring deduplication and SimHash against brute force."""

from __future__ import annotations

import re

import brute
import numpy as np
import pytest
from cases import SF001, pairs, rows
from pyspark.sql import functions as F

from vendorpulse.llm import queries as Q
from vendorpulse.llm import simhash, substring, winnow
from vendorpulse.llm.words import SPACE_WORDS, run_hashes, split_words, windowed_minimum


# --- words
def test_words_hashes_and_runs_depend_on_words_alone():
    import pyarrow as pa
    a = split_words(pa.array(["x yy zzz", None, "", "yy\n zzz\ta"]), SPACE_WORDS)
    assert a.counts.tolist() == [3, 0, 0, 3]
    h = a.hashes()
    assert h[1] == h[3] and h[2] == h[4] and len({int(x) for x in h}) == 4
    at, runs = a.runs(h, 2)
    assert at.tolist() == [0, 1, 3, 4] and runs[1] == runs[2]


def complement(levels, a="a", b="b"):
    """Two sequences, each the other's complement, on which polynomial hashes modulo a power of two agree."""
    x, y = [a], [b]
    for _ in range(levels):
        x, y = x + y, y + x
    return x, y


def test_hashes_of_complementary_words_and_runs_differ():
    import pyarrow as pa
    for levels in (10, 11):
        x, y = ("".join(w) for w in complement(levels))
        w = split_words(pa.array([x, y]), SPACE_WORDS)
        assert all(len(set(w.hashes(i).tolist())) == 2 for i in (0, 1))
        x, y = complement(levels)
        w = split_words(pa.array([" ".join(x), " ".join(y)]), SPACE_WORDS)
        for i in (0, 1):
            h = run_hashes(w.hashes(i), w.first[:-1], w.first[1:], i)
            assert h[0] != h[1]


@pytest.mark.parametrize("n", [1, 2, 3, 6, 13, 20, 276])
def test_run_hashes_tell_runs_apart(n):
    rng = np.random.default_rng(n)
    h = rng.integers(1 << 62, size=4)[rng.integers(0, 4, 3000)].astype(np.uint64)
    at = np.arange(3000 - n + 1)
    for i in (0, 1):
        by_hash = {}
        for a, x in zip(at.tolist(), run_hashes(h, at, at + n, i).tolist()):
            by_hash.setdefault(x, set()).add(h[a: a + n].tobytes())
        assert all(len(v) == 1 for v in by_hash.values())
        assert len(by_hash) == len({h[a: a + n].tobytes() for a in at.tolist()})


def test_words_that_polynomial_hashes_confuse(spark):
    """Substrings, windows and counts of complementary words of 1,024 bytes, against brute force."""
    x, y = ("".join(w) for w in complement(10))
    around = [f"t{i}" for i in range(15)]
    docs = [(1, " ".join([*around, x, *around])), (2, " ".join([*around, y, *around]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.substring(set(docs))
    assert _op6(substring.deduplicate(df)) == sorted((want[r] for r in docs), key=str) and want[docs[1]][2] == 0
    items = spark.createDataFrame([("i", " ".join([*around[-6:], x, *around[:6]]))], "item_id string, text string")
    for limit in (winnow.BROADCAST_WINDOWS, 0):
        judged = winnow.overlaps(df, items, broadcast_windows=limit)
        assert _op3(judged) == sorted(brute.decontaminate(docs, [tuple(r) for r in items.collect()]), key=str)


def test_windowed_minimum_is_rightmost():
    v = np.array([3, 1, 2, 1, 5, 1, 1, 9], np.uint64)
    for width in range(1, 8):
        at, place, _ = windowed_minimum(v, np.array([0, 8]), width)
        want = [max(range(i, i + width), key=lambda j: (-int(v[j]), j)) for i in range(8 - width + 1)]
        assert at.tolist() == list(range(8 - width + 1)) and place.tolist() == want


# --- op3
def _op3(judged):
    out = judged.columns[-1]
    return rows(judged.select("doc_id", F.col(f"{out}.n_words").alias("n"), winnow.n_hit(out).alias("hit"),
                              F.size(f"{out}.items").alias("items"),
                              F.sha2(F.concat_ws(",", F.array_sort(f"{out}.items")), 256).alias("sha"),
                              winnow.contaminated(out).alias("bad")), "doc_id", "n", "hit", "items", "sha", "bad")


@pytest.fixture(scope="module")
def benchmark(spark, messy):
    texts = dict(pairs(messy))
    items = [(1, " ".join(texts[9].split()[5:30])), (2, "Two words"), (3, ""), (4, None), (5, "i j k"), (None, "same line"),
             (6, texts[20]), (7, texts[20]), (7, texts[20]), (8, "long long long")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [winnow.BROADCAST_WINDOWS, 0])
def test_decontamination_both_ways_equal_brute_force(messy, benchmark, limit):
    judged = winnow.overlaps(messy, benchmark, broadcast_windows=limit)
    assert judged.columns[:-1] == messy.columns
    want = brute.decontaminate(pairs(messy), [tuple(r) for r in benchmark.collect()])
    assert _op3(judged) == sorted(want, key=str)


def test_decontamination_empty_tables(messy, benchmark, empty):
    assert winnow.overlaps(empty, benchmark).count() == 0
    for limit in (10, 0):
        judged = winnow.overlaps(messy, benchmark.limit(0), broadcast_windows=limit)
        assert {r[3] for r in _op3(judged)} == {0}
    assert winnow.decontaminate(messy, benchmark.limit(0)).count() == messy.count()


def test_op3_query(spark, small):
    out = Q.QUERIES["op3_decontaminate"](spark, SF001)
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(out, *out.columns) == sorted(brute.decontaminate(pairs(small), items), key=str)
    assert any(r.contaminated for r in out.collect())


# --- op6
def _op6(out):
    removed = F.aggregate("repeats", F.lit(0), lambda a, x: a + x["length"])
    return rows(out.select("doc_id", "n_words", removed.alias("gone"), F.sha2("kept", 256).alias("sha")),
                "doc_id", "n_words", "gone", "sha")


@pytest.mark.parametrize("window,gram", [(20, 6), (5, 2), (3, 3)])
def test_substring_equals_brute_force(messy, window, gram):
    own = pairs(messy)
    want = brute.substring(set(own), window)
    assert _op6(substring.deduplicate(messy, window=window, gram=gram)) == sorted((want[r] for r in own), key=str)


def test_substring_ids_that_tell_rows_apart(plain, empty):
    own = pairs(plain)
    want = brute.substring(set(own))
    assert _op6(substring.deduplicate(plain)) == sorted((want[r] for r in own), key=str)
    assert substring.deduplicate(empty).count() == 0


def test_op6_query(spark, small):
    own = pairs(small)
    want = brute.substring(set(own))
    out = Q.QUERIES["op6_substring"](spark, SF001)
    assert rows(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted((want[r] for r in own), key=str)
    assert sum(r[2] for r in want.values()) > 0


def test_substring_flushes_between_slices(plain, monkeypatch):
    """Few rows held at once: a class may reach the shuffle several times from one task."""
    own = pairs(plain)
    want = brute.substring(set(own))
    monkeypatch.setattr(substring, "FLUSH", 50)
    assert _op6(substring.deduplicate(plain)) == sorted((want[r] for r in own), key=str)


def test_an_anchor_in_many_contexts_meets_few_rows(spark):
    """Documents that share a passage in different surroundings: a task sends two rows of an anchor."""
    rng = np.random.default_rng(8)
    shared = " ".join(f"s{i}" for i in range(30))
    docs = [(i, " ".join([*(f"w{x}" for x in rng.integers(1 << 30, size=25)), shared, *(f"w{x}" for x in rng.integers(1 << 30, size=25))]))
            for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = substring.seeds(df.selectExpr("doc_id as k", "text"), 20, 6)
    assert out.where("several").count() > 500
    assert out.groupBy("a").count().agg(F.max("count")).first()[0] <= 2 * 3
    want = brute.substring(set(docs))
    assert _op6(substring.deduplicate(df)) == sorted((want[r] for r in docs), key=str)
    assert sum(r[2] > 0 for r in want.values()) == 599


# --- op10
def test_xxh64_of_all_lengths():
    import xxhash
    data = np.random.default_rng(1).integers(0, 256, 4000).astype(np.uint8)
    ends = np.concatenate([np.arange(0, 300), [4000]])
    starts = np.zeros(len(ends), np.int64)
    starts[:-1] = np.minimum(7, ends[:-1])
    got = simhash.xxh64(data, starts, ends)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends)]


def test_simhash_equals_brute_force(messy, empty):
    out = simhash.near_duplicates(messy).select("doc_id", simhash.hex64().alias("f"), "component_id")
    assert rows(out, *out.columns) == sorted(brute.simhash(pairs(messy)), key=str)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_group_stays(messy, plain, empty):
    for docs in (messy, plain):
        own = pairs(docs)
        want = {c for _, _, c in brute.simhash(own)}
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns
        got = pairs(kept)
        prints = [brute.fingerprint(t) for _, t in got]
        assert {d for d, _ in got} == want
        assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
    assert simhash.one_of_each(empty).count() == 0


@pytest.mark.parametrize("distance,dense", [(2, 10**9), (2, 4), (3, 6), (1, 3), (0, 2)])
def test_links_of_a_dense_ball(spark, distance, dense):
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 62))
    ball = {base ^ sum(1 << int(b) for b in rng.choice([*range(12), 40, 63], rng.integers(0, 5), replace=False))
            for _ in range(150)}
    ball |= {int(x) for x in rng.integers(1 << 62, size=30)}
    nodes = spark.createDataFrame([(simhash._signed(x),) for x in ball], "fp long")
    got = {tuple(r) for r in simhash.links(nodes, distance, dense).collect()}
    signed = sorted((simhash._signed(x), x) for x in ball)
    want = {(a, b) for i, (b, y) in enumerate(signed) for a, x in signed[:i] if (x ^ y).bit_count() <= distance}
    assert got == want


@pytest.mark.parametrize("run", [simhash.near_duplicates, simhash.one_of_each])
def test_simhash_broadcasts_no_side_of_guessed_size(spark, messy, plain, monkeypatch, run):
    """The guesses are too low (variants count as their fingerprints, before the explode); aggregates are measured first."""
    plans, keep = [], simhash.stored
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(simhash, "stored", lambda df, *a: keep(seen(df), *a))
    for docs in (messy, plain):
        seen(run(docs))
    for plan in plans:
        assert "Generate" not in plan or "BroadcastExchange" not in plan
        for part in re.split(r"BroadcastExchange.*\n", plan)[1:]:
            first = next(x for x in re.findall(r"[-+:] (\w+)", part) if not re.match("Project|Filter|Sort$|.*Aggregate", x))
            assert first == "Exchange", plan


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(59, 129)] + [(500, 501)]
    got = dict((r.node, r.root) for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 0 for i in range(30)}, 500: 500, 501: 500}


def test_op10_query(spark, small):
    out = Q.QUERIES["op10_simhash"](spark, SF001)
    assert rows(out, *out.columns) == sorted(brute.simhash(pairs(small)), key=str)
