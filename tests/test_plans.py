"""Plan-level checks on the driver tables: oracle parity, invariants, job modes, scoring."""

from __future__ import annotations

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F
from shop import SF001

import __spark_entry__ as E
from oracle_compare import compare, duck
from vendorpulse import FeaturePlan, driver_roles, read_abt
from vendorpulse.operators import derived, features, scoring
from vendorpulse.plans import job, reference_shaped
from vendorpulse.session import shared_dir


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.fixture(scope="module")
def roles(spark):
    return driver_roles(spark, SF001)


OWN = sorted(n for n in E.queries() if n != "pipeline" and not n.startswith("op"))  # the others: tests/llm


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    assert name in E.oracle_sql()
    r = compare(spark, name, SF001, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("name,column", [("seller_profile", "fl_venda"), ("score_linear", "fl_venda_predict"),
                                         ("score_pipeline", "fl_venda_predict"), ("score_category", "fl_venda_predict")])
def test_labels_and_predictions_differ(spark, sf, name, column):
    assert E.queries()[name](spark, sf).select(column).distinct().count() >= 2


def test_outputs_are_not_constant(spark):
    """Every output that the data lets vary has at least two values over the label dates."""
    df = FeaturePlan.of(driver_roles(spark, SF01), E.LABEL_DATES).layer2()
    n = df.agg(*(F.count_distinct(F.col(f"`{c}`")).alias(c) for c in df.columns)).first().asDict()
    assert {c for c, k in n.items() if k < 2} <= {"qtd_categorias_vendendo", "proporcao_ativacao_meses"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == derived.layer2_columns()
    assert df.count() > 0


def test_layer_column_counts():
    assert len(features.layer1_columns()) == 195
    assert len(derived.layer2_columns()) == 201
    assert len(set(derived.layer2_columns())) == 201


def test_invariants(spark, roles):
    l1 = FeaturePlan.of(roles, E.DATES).layer1()
    assert l1.groupBy("dt_ref", "seller_id").count().where("count > 1").count() == 0
    w = [features.window_name("qtd_pedidos", n) for n in (1, 2, 3, 4, 5, 6)]
    bad = l1.where(" OR ".join(f"{a} > {b}" for a, b in zip(w, w[1:])) + f" OR {w[-1]} > qtd_pedidos_ate_hoje")
    assert bad.count() == 0
    parts = " + ".join(f"qtd_pedidos_{k}_ate_hoje" for k in ("entregues", "cancelados", "outros_status"))
    assert l1.where(f"{parts} > qtd_pedidos_ate_hoje").count() == 0


def test_multi_date_equals_stacked_single_dates(spark, roles):
    multi = FeaturePlan.of(roles, E.DATES).layer2()
    single = None
    for d in E.DATES:
        one = FeaturePlan.of(roles, [d]).layer2()
        single = one if single is None else single.unionByName(one)
    assert multi.exceptAll(single).count() == 0 and single.exceptAll(multi).count() == 0


def test_reference_shaped_plan_agrees_and_main_plan_has_no_expand(spark, roles):
    main = FeaturePlan.of(roles, E.DATES).layer1()
    ref = reference_shaped.layer1(roles, E.DATES).select(*main.columns)
    assert main.exceptAll(ref).count() == 0 and ref.exceptAll(main).count() == 0
    p = FeaturePlan.of(roles, E.DATES)
    for df in (main, p.layer2(), p.seller_products()):
        assert "Expand" not in _plan_text(df)


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning(spark, roles):
    plan = _plan_text(FeaturePlan.of(roles, E.DATES).layer2())
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and not any(c in line for line in schemas for c in ("l_discount", "o_custkey", "o_totalprice", "s_acctbal"))


def test_fewer_exchanges_and_joins_at_cluster_scale(spark, roles):
    """With no side small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan_text(FeaturePlan.of(roles, E.DATES).layer2())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") < 18 and plan.count("SortMergeJoin") < 9
    assert not any(x in plan for x in ("BroadcastExchange", "CartesianProduct", "SortAggregate"))


@pytest.mark.parametrize("kind", ["month", "day"])
def test_joins_by_order_keep_all_shuffle_partitions(spark, roles, kind):
    """Coalesced to the advisory size, a task of the joins by order holds over 20 times what it reads."""
    from vendorpulse.plans.abt import DayPlan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = DayPlan.of(roles, E.DAYS) if kind == "day" else FeaturePlan.of(roles, E.DATES)
        fixed = lambda: re.findall(r"hashpartitioning\((\w+)#\d+L?, 4\), REPARTITION_BY_NUM", _plan_text(plan.layer2()))
        assert "order_id" in fixed()
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")  # skewed joins are AQE's to split
        assert "order_id" not in fixed()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")


@pytest.mark.parametrize("n_dates", [3, 36])
def test_rows_of_the_date_generator_follow_the_months(spark, roles, n_dates):
    from vendorpulse.functions.dates import monthly_range
    from vendorpulse.operators.features import expand_dates
    dates = monthly_range("1996-01-01", "1998-12-01")[-n_dates:]
    groups = FeaturePlan.of(roles, dates).month_groups()
    out = expand_dates(groups, dates)
    most = out.groupBy("seller_id", "pm", "ld", "paid", "k", "v", "dm").count().agg(F.max("count")).first()[0]
    assert 0 < most <= 13
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") <= 60  # the expressions don't follow the number of dates either


def test_dates_are_attached_behind_one_exchange_by_seller(spark, roles):
    """Levels A and B, for month groups and for segments, run on the sellers' own partitioning."""
    from vendorpulse.plans.abt import DayPlan
    for plan in (FeaturePlan.of(roles, E.DATES), DayPlan.of(roles, E.DAYS)):
        text = _plan_text(plan.layer1())
        assert len(re.findall(r"Exchange hashpartitioning\(seller_id#\d+L?, 4\), REPARTITION_BY_NUM", text)) == 1
        assert "Exchange hashpartitioning(dt_ref" not in text


def test_installment_means_over_many_values(spark):
    """Each value of a window once, however many buckets and orders have it."""
    import datetime as dt
    rows = [(1, pm, ("main", "cc", "voucher")[k], v) for pm in (-1, -2, -9) for k, vs in enumerate(((0,), (1, 1, 4), (2, 7))) for v in vs]
    groups = spark.createDataFrame([(s, pm, k, v) for s, pm, k, v in rows], "seller_id long, off int, kind string, v0 long").distinct()
    ref = dt.date(1998, 9, 1)
    month = 1998 * 12 + 9
    num = {"main": 0, "cc": features.KIND_CC, "voucher": features.KIND_VOUCHER}
    k = F.when(F.col("kind") == "main", 0).when(F.col("kind") == "cc", num["cc"]).otherwise(num["voucher"])
    main = F.col("kind") == "main"
    day = F.lit(dt.date(1998, 8, 3))
    parts = {n: F.when(main, F.lit(1)).cast("long").alias(n) for f in features.FAMILIES for n in features._partial_names(f)}
    x = groups.select("seller_id", (F.lit(month) + F.col("off")).alias("pm"), F.lit(False).alias("ld"), F.lit(True).alias("paid"),
                      k.alias("k"), F.when(~main, F.col("v0")).alias("v"), F.lit(None).cast("int").alias("dm"),
                      *(F.when(main, day).alias(c) for c in ("min_pdate", "max_pdate", "max_est", "max_dlv")),
                      F.when(main, F.lit(4)).cast("long").alias("day_bits"), *parts.values())
    r = features.layer1(x, [ref]).first()
    assert r.media_qtd_parcelas_pedidos_pgto_cc_ate_hoje == r.media_qtd_parcelas_pedidos_pgto_cc_ultimo_mes == 2.5
    assert r.media_qtd_parcelas_pedidos_pgto_voucher_ultimos_2_meses == 4.5 and r.qtd_pedidos_ate_hoje == 3


def test_hot_product_and_hot_seller(spark, roles):
    """A third of all item rows of one product, another third of one seller; no forced skew setting."""
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin", "false") == "false"
    i = roles.items
    items = i.withColumn("product_id", F.when(F.col("order_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("product_id"))) \
             .withColumn("seller_id", F.when(F.col("order_id") % 3 == 1, F.lit(2).cast("bigint")).otherwise(F.col("seller_id")))
    hot = roles.__class__(**{**roles.as_dict(), "items": items})
    p = FeaturePlan.of(hot, E.FLAGSHIP_DATE)
    ref = reference_shaped.layer1(hot, E.FLAGSHIP_DATE)
    main = p.layer1()
    assert main.exceptAll(ref.select(*main.columns)).count() == 0
    pairs = items.select("seller_id", "product_id").distinct().join(roles.products, "product_id")
    want = {r.seller_id: r.n for r in pairs.groupBy("seller_id").agg(F.count("*").alias("n")).collect()}
    assert {r.seller_id: r.qtd_produtos_vendendo for r in p.seller_products().collect()} == want


def test_write_is_idempotent_and_job_modes(spark, roles):
    base = tempfile.mkdtemp(prefix="vp-job-", dir=shared_dir(spark))
    abt = os.path.join(base, "abt")
    models = os.path.join(base, "models")
    job.run_job(spark, roles, abt, E.DATES, build=True, score=False)
    first = read_abt(spark, abt).count()
    job.run_job(spark, roles, abt, E.DATES[1:], build=True, score=False)   # rewrite two months
    table = read_abt(spark, abt)
    assert table.count() == first
    assert table.groupBy("dt_ref", "seller_id").count().where("count > 1").count() == 0

    fit_vars = list(E.LINEAR.fit_vars)
    model = scoring.train_pipeline(table, fit_vars)
    scoring.save_model(model, fit_vars, models, "model_2018-01-01")
    scoring.save_model(model, fit_vars, models, "model_2018-09-01")
    os.makedirs(os.path.join(models, "model_2018-10-01", "pipeline"))  # not saved to its end
    assert scoring.newest_version(models, spark) == "model_2018-09-01"
    out = os.path.join(base, "pred")
    pred = job.run_job(spark, roles, abt, E.DATES, build=False, score=True, models_dir=models,
                       predictions_path=out)
    assert pred.columns == ["dt_ref", "seller_id", "fl_venda_predict"]
    assert spark.read.option("header", True).csv(out).count() == first


def test_scoring_paths_agree(spark, roles):
    abt = FeaturePlan.of(roles, E.DATES).layer2()
    a = scoring.score_with_column(abt, E.LINEAR)
    b = scoring.score_with_predict(abt, E.LINEAR, E.LINEAR.fit_vars)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.select(F.sum("fl_venda_predict")).first()[0] is not None


def test_purchase_window_reaches_parquet_scan(spark, roles):
    """With a stored purchase timestamp the window union is a pushed Parquet filter."""
    base = tempfile.mkdtemp(prefix="vp-roles-", dir=shared_dir(spark))
    roles.orders.write.mode("overwrite").parquet(os.path.join(base, "orders"))
    stored = spark.read.parquet(os.path.join(base, "orders"))
    plan = FeaturePlan.of(roles.__class__(**{**roles.as_dict(), "orders": stored}), E.DATES).layer2()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")     # do not truncate PushedFilters
    try:
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(order_purchase_timestamp,1997-07-01" in text
    assert "LessThan(order_purchase_timestamp,1998-09-30" in text


def test_job_command_line_build_only(spark):
    base = tempfile.mkdtemp(prefix="vp-cli-", dir=shared_dir(spark))
    abt = os.path.join(base, "abt")
    job.main(["--driver-tables", SF001, "--abt", abt, "--first", "1998-08-01", "--last", "1998-09-01",
              "--build-only"])
    table = read_abt(spark, abt)
    assert sorted(r[0].isoformat() for r in table.select("dt_ref").distinct().collect()) == \
        ["1998-08-01", "1998-09-01"]


def test_both_layers_as_sql_views(spark, roles):
    from vendorpulse.plans.abt import register_views
    register_views(FeaturePlan.of(roles, E.DATES), prefix="vw_test")
    n1 = spark.sql("SELECT count(*) FROM vw_test_p1").first()[0]
    n2 = spark.sql("SELECT count(*) FROM vw_test_p2").first()[0]
    assert n1 >= n2 > 0
    assert len(spark.table("vw_test_p2").columns) == 202


def test_job_both_modes_versions_and_command_line(spark, roles):
    base = tempfile.mkdtemp(prefix="vp-both-", dir=shared_dir(spark))
    models, abt, out = E._models(spark), os.path.join(base, "abt"), os.path.join(base, "pred")
    args = ["--driver-tables", SF001, "--abt", abt, "--first", "1998-08-01", "--last", "1998-09-01"]
    job.main([*args, "--models", models, "--predictions", out])
    read = lambda: spark.read.option("header", True).csv(out)
    assert read().select("fl_venda_predict").distinct().count() == 2
    job.main([*args, "--score-only", "--models", models, "--model-version", "model_1998-08-01", "--predictions", out])
    assert {r.fl_venda_predict for r in read().collect()} == {"1"}
    job.main([*args, "--score-only", "--scorer", "__spark_entry__:BY_STATE", "--prediction-type", "double",
              "--predictions", out])
    assert read().where("fl_venda_predict like '%.%'").count() > 0
    with pytest.raises(ValueError, match="models folder or a scorer"):
        job.run_job(spark, roles, abt, E.DATES, build=False)


def test_predictions_keep_their_type(spark, roles):
    abt = FeaturePlan.of(roles, E.FLAGSHIP_DATE).layer2()
    fit = ["seller_state", "qtd_pedidos_ate_hoje"]

    class Fixed:  # local: pickled with the function
        def __init__(self, values):
            self.values = values

        def predict(self, pdf):
            import numpy as np
            return np.resize(np.array(self.values), len(pdf))

    out = scoring.score_with_predict(abt, Fixed([0.7, 1.4]), fit, "double")
    assert {r.fl_venda_predict for r in out.collect()} == {0.7, 1.4}
    assert {r.fl_venda_predict for r in scoring.score_with_predict(abt, Fixed([0.0, 1.0]), fit).collect()} == {0, 1}
    with pytest.raises(Exception, match="whole numbers"):
        scoring.score_with_predict(abt, Fixed([0.7, 1.4]), fit).collect()


def test_fitted_pipeline_with_a_text_feature_on_later_dates(spark):
    roles01 = driver_roles(spark, SF01)
    past = FeaturePlan.of(roles01, ["2001-06-01", "2001-07-01"]).layer2()
    fit = [*E.LINEAR.fit_vars, "seller_state"]
    model = scoring.train_pipeline(past, fit, max_iter=5)
    now = FeaturePlan.of(roles01, ["2001-08-01"]).layer2()
    out = scoring.score_with_pipeline(now, model, fit)
    assert out.count() == now.count() and {r[0] for r in out.select("fl_venda_predict").distinct().collect()} <= {0, 1}


def test_a_month_that_becomes_empty_and_files_per_date(spark, roles):
    path = os.path.join(tempfile.mkdtemp(prefix="vp-empty-", dir=shared_dir(spark)), "abt")
    job.run_job(spark, roles, path, E.DATES, score=False)
    for d in E.DATES:
        assert len([f for f in os.listdir(f"{path}/dt_ref={d}") if f.endswith(".parquet")]) == 1
    before = read_abt(spark, path).where("dt_ref <> '1998-09-01'").count()
    nobody = roles.__class__(**{**roles.as_dict(), "orders": roles.orders.where("order_purchase_timestamp < '1995-01-01'")})
    job.run_job(spark, nobody, path, E.DATES[2:], score=False)
    left = read_abt(spark, path)
    assert left.where("dt_ref = '1998-09-01'").count() == 0 and left.count() == before


def _text_roles(spark, roles, **changes):
    from vendorpulse.sources.roles import conform
    out = {}
    for name, df in roles.as_dict().items():
        text = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))
        out[name] = conform(name, changes.get(name, lambda x: x)(text))
    return roles.__class__(**out)


def test_text_sources_with_empty_strings(spark, roles):
    text = _text_roles(spark, roles)
    a = FeaturePlan.of(text, E.FLAGSHIP_DATE).layer1().withColumn("seller_id", F.col("seller_id").cast("bigint"))
    b = FeaturePlan.of(roles, E.FLAGSHIP_DATE).layer1()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert text.orders.where("order_delivered_customer_date is null").count() > 0


@pytest.mark.parametrize("role,column,value", [
    ("orders", "order_purchase_timestamp", "yesterday"), ("items", "price", "12,50"), ("items", "price", "1.23456"),
    ("reviews", "review_score", "4.5"), ("payments", "payment_installments", "two")])
def test_unreadable_text_raises(spark, roles, role, column, value):
    bad = _text_roles(spark, roles, **{role: lambda df: df.limit(3).withColumn(column, F.lit(value))})
    with pytest.raises(Exception, match=f"column {column}: unreadable value {value}"):
        bad.as_dict()[role].collect()


def test_reader_options_and_csv_files(spark, roles):
    from vendorpulse import read_roles
    from vendorpulse.sources.schemas import ROLES
    base = tempfile.mkdtemp(prefix="vp-csv-", dir=shared_dir(spark))
    for name, df in roles.as_dict().items():
        df.write.option("header", True).option("sep", ";").csv(f"{base}/{name}")
    back = read_roles(spark, {n: f"{base}/{n}" for n in ROLES}, "csv", {"sep": ";"})
    assert back.items.count() == roles.items.count()
    abt = os.path.join(base, "abt")
    job.main(["--roles-dir", base, "--format", "csv", "--option", "sep=;", "--abt", abt, "--first", "1998-09-01",
              "--last", "1998-09-01", "--build-only"])
    assert read_abt(spark, abt).count() == FeaturePlan.of(roles, E.FLAGSHIP_DATE).layer2().count()


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace as N
    conf = N(get=lambda k, d=None: None)
    cluster = N(conf=conf, sparkContext=N(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster)
