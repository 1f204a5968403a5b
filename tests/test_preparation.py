"""Boosted trees, target encoding, bins and medians."""

from __future__ import annotations

import hashlib
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from shop import SF001

import __spark_entry__ as E
from vendorpulse import FeaturePlan, driver_roles
from vendorpulse.operators import preparation as P
from vendorpulse.operators import trees
from vendorpulse.session import shared_dir


# --- trees
def test_trained_trees_equal_the_transformer(spark):
    """The expression compiled from a trained model predicts what the model's own transformer does, missing values too."""
    from pyspark.ml.classification import GBTClassifier

    rng = np.random.default_rng(4)
    data = [(i, *(rng.choice([None, float("nan")]) if rng.random() < 0.1 else float(v) for v in rng.normal(size=3))) for i in range(600)]
    rows = spark.createDataFrame(data, "seller_id long, a double, b double, c double").withColumns({
        "dt_ref": F.lit("2018-01-01").cast("date"), "fl_venda": F.expr("int(coalesce(nanvl(a, null), 0) * coalesce(nanvl(b, null), 0.5) > 0.1)")})
    features = ["a", "b", "c"]
    vectors = trees.vectors(rows, trees.beyond(rows, features)).withColumn("label", F.col("fl_venda").cast("double"))
    model = GBTClassifier(maxIter=6, maxDepth=3, seed=2).fit(vectors)
    want = {r.seller_id: (r.prediction, r.rawPrediction[1]) for r in model.transform(vectors).collect()}
    scorer = trees.TreeScorer.of_model(model, features)
    got = {r.seller_id: r for r in rows.select("seller_id", scorer.margin().alias("m"), scorer.column().alias("p")).collect()}
    assert len({p for p, _ in want.values()}) == 2
    for i, (p, raw) in want.items():
        assert got[i].p == p and abs(got[i].m - raw) < 1e-9
    own = trees.train_trees(rows, features, trees=6, depth=3)
    right = rows.select((own.column() == F.col("fl_venda")).cast("int").alias("x")).agg(F.avg("x")).first()[0]
    assert right > 0.85 and set(own.fit_vars) <= set(features)
    with pytest.raises(ValueError, match="encoded first"):
        trees.train_trees(rows.withColumn("t", F.lit("x")), ["a", "t"])


def test_trees_train_on_the_feature_table(spark):
    abt = FeaturePlan.of(driver_roles(spark, "/root/testdata/sf0.01"), E.LABEL_DATES).layer2().select(
        "dt_ref", "seller_id", "fl_venda", *E.LINEAR.fit_vars).cache()
    scorer = trees.train_trees(abt, E.LINEAR.fit_vars, trees=3, depth=2)
    scored = trees.score_with_trees(abt, scorer)
    assert scored.columns == ["dt_ref", "seller_id", "fl_venda_predict"]
    right = abt.join(scored, ["dt_ref", "seller_id"]).select(F.avg((F.col("fl_venda") == F.col("fl_venda_predict")).cast("int"))).first()[0]
    most = max(r["count"] for r in abt.groupBy("fl_venda").count().collect()) / abt.count()
    assert right >= most
    assert "BatchEvalPython" not in scored._jdf.queryExecution().executedPlan().toString()


def test_tree_scorer_checks():
    with pytest.raises(ValueError, match="one weight per tree"):
        trees.TreeScorer((trees.Leaf(1.0),), ())
    assert trees.TreeScorer((trees.Leaf(1.0),), (2.0,)).fit_vars == ()


@pytest.mark.parametrize("name", ["score_trees", "score_prepared"])
def test_fixed_trees_predict_both_classes(spark, name):
    assert E.queries()[name](spark, "/root/testdata/sf0.01").select("fl_venda_predict").distinct().count() == 2


# --- target encoding
def _fold(key, folds):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % folds


@pytest.mark.parametrize("folds,weight", [(3, 2.0), (50, 0.0)])
def test_target_encoding_equals_brute_force(spark, folds, weight):
    rng = random.Random(folds)
    data = [(i % 40, rng.choice(["x", "y", "z", None, "missing", ""]), rng.choice([0, 0, 1, None])) for i in range(200)]
    data += [(7, "only one", 1)]
    rows = spark.createDataFrame(data, "seller_id long, g string, fl_venda int").withColumn("te_n", F.lit("extra"))
    encoder = P.TargetEncoder.fit(rows, ["g"], folds=folds, weight=weight)
    taught = [(s, g, y) for s, g, y in data if y is not None]

    def want(s, g, training):
        own = [r for r in taught if not training or _fold(r[0], folds) != _fold(s, folds)]
        prior = sum(y for _, _, y in own) / len(own)
        mine = [y for _, h, y in own if h == g]
        return (sum(mine) + weight * prior) / (len(mine) + weight) if len(mine) + weight else prior

    for training in (True, False):
        out = encoder.transform(rows, training)
        assert out.columns == [*rows.columns, "g_te"] and out.count() == len(data)
        for r in out.collect():
            assert abs(r.g_te - want(r.seller_id, r.g, training)) < 1e-12
    new = spark.createDataFrame([(1, "never seen", None)], "seller_id long, g string, fl_venda int")
    assert abs(encoder.transform(new).first().g_te - sum(y for _, _, y in taught) / len(taught)) < 1e-12


def test_target_encoding_of_no_rows(spark):
    rows = spark.createDataFrame([], "seller_id long, g string, fl_venda int")
    encoder = P.TargetEncoder.fit(rows, ["g"])
    assert encoder.transform(rows).count() == 0
    new = spark.createDataFrame([(1, "x", None)], rows.schema)
    assert encoder.transform(new).first().g_te is None and encoder.transform(new, training=True).first().g_te is None


# --- bins
def test_exact_bins(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, float("nan"), *map(float, range(12))]), float(rng.randint(0, 2)), None) for _ in range(300)]
    rows = spark.createDataFrame(data, "x double, few double, none double").where("not isnan(x) or x is null")
    fitted = P.Binner.fit(rows, ["x", "few", "none"], bins=5)
    present = sorted(x for x, _, _ in data if x is not None and x == x)
    want = sorted({present[max(0, -(-len(present) * k // 5) - 1)] for k in range(1, 5)})
    assert list(fitted.edges["x"]) == want and fitted.edges["none"] == () and len(fitted.edges["few"]) <= 3
    for r in fitted.transform(spark.createDataFrame(data, "x double, few double, none double")).collect():
        assert r.x_bin == (-1 if r.x is None or r.x != r.x else sum(e < r.x for e in want)) and r.none_bin == -1
    path = tempfile.mkdtemp(dir=shared_dir(spark).removeprefix("file:"))
    fitted.save(spark, path)
    assert P.Binner.load(spark, path) == fitted


@pytest.mark.parametrize("values", [1, 30, 10_000])
def test_exact_quantiles_hold_no_column_in_a_task(spark, values, monkeypatch):
    """The values that percentile_disc finds, for many distinct ones and few, without its buffer of a column."""
    rng = random.Random(values)
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0]
    data = [(float(rng.randrange(values)), rng.choice([*odd, float(rng.randrange(values))]), None) for _ in range(3_000)]
    rows = spark.createDataFrame(data, "x double, odd double, none double").repartition(5)
    shares = [k / 7 for k in range(1, 7)] + [0.5, 0.1, 1.0]
    want = rows.agg(*(F.array(*(F.expr(f"percentile_disc({s!r}) WITHIN GROUP (ORDER BY {c})") for s in shares)).alias(c) for c in rows.columns)).first()
    monkeypatch.setattr(F, "expr", lambda text: pytest.fail(text))
    assert [list(map(str, q)) for q in P.exact_quantiles(rows, rows.columns, shares)] == [list(map(str, q)) for q in want]


def test_fits_read_rows_that_were_built_once(spark, monkeypatch):
    """The feature table is built once for fitting and transforming."""
    built = []
    plan = E._plan
    monkeypatch.setattr(E, "_plan", lambda *a: built.append(a) or plan(*a))
    for query, plans in ((E.q_bin_features, 1), (E.q_encode_target, 1), (E.q_score_prepared, 2)):
        built.clear()
        text = query(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert len(built) == plans and text.count("lineitem.parquet") + text.count("l_orderkey") < 40, query
        if plans == 1:
            assert "l_orderkey" not in text


@pytest.mark.parametrize("error", [0.01, 0.002])
def test_sketched_bins_keep_their_rank_error(spark, error):
    rows = spark.range(0, 60_000, 1, 7).select((F.pow(F.rand(5), 6) * 1e6).alias("x"))
    values = np.sort([r.x for r in rows.collect()])
    edges = P.Binner.fit(rows, ["x"], bins=20, error=error).edges["x"]
    assert len(edges) == 19
    for k, e in enumerate(edges, 1):
        assert abs(np.searchsorted(values, e, side="right") / len(values) - k / 20) <= error + 1 / len(values)


def test_medians(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0), (4, 9.0)], "i int, x double")
    fitted = P.Imputer.fit(rows.withColumn("y", F.lit(None).cast("double")), ["x", "y"])
    assert fitted.medians == {"x": 5.0, "y": 0.0}
    out = sorted((r.i, r.x_filled, r.x_missing) for r in P.Imputer({"x": 5.0}).transform(rows).collect())
    assert out == [(1, 5.0, 0), (2, 5.0, 1), (3, 1.0, 0), (4, 9.0, 0)]
    assert P.Imputer.fit(rows, ["x"], error=0.01).medians == {"x": 5.0}


@pytest.mark.parametrize("name", ["encode_target", "bin_features"])
def test_prepared_features_differ_between_rows(spark, name):
    df = E.queries()[name](spark, SF001)
    n = df.agg(*(F.count_distinct(c).alias(c) for c in df.columns[2:])).first()
    assert all(x > 1 for x in n), n
