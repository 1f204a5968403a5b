"""

``entry(spark)`` runs the flagship query (the 201-column feature table of
one reference date) on sf0.001.  ``queries()`` holds one callable per
operator group of SURVEY §2; ``oracle_sql()`` the DuckDB SQL of each, written
in the shape of the original definitions (see ``vendorpulse.oracle``).

Every query reads the whole driver tables; those of the feature table through
the role mapping of FIXTURES §B.  Reference dates: 1998-07-01, 1998-08-01,
1998-09-01, and 2001-08-01 where labels and predictions must differ.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vendorpulse import oracle as O  # noqa: E402
from vendorpulse.operators import features as FE  # noqa: E402
from vendorpulse.operators import derived as DV  # noqa: E402
from vendorpulse.operators import asof, preagg, preparation, scoring, segments, trees  # noqa: E402
from vendorpulse.functions.arith import money  # noqa: E402
from vendorpulse.plans import job  # noqa: E402
from vendorpulse.plans.abt import DayPlan, FeaturePlan, build_abt, build_abt_range, publish_abt, read_abt  # noqa: E402
from vendorpulse.plans.abt import read_published, write_abt  # noqa: E402
from vendorpulse.plans.state import MonthState  # noqa: E402
from vendorpulse.session import bloom_filters  # noqa: E402
from vendorpulse.sources.bucketed import read_bucketed, write_bucketed  # noqa: E402
from vendorpulse.sources.roles import driver_roles, read_roles  # noqa: E402
from vendorpulse.sources.schemas import ROLES  # noqa: E402

try:  # the training-data operators, and what they import, are an optional part
    import corpus_pipeline  # noqa: E402
    from vendorpulse.llm import queries as LQ  # noqa: E402
    HAS_LLM = True
except ImportError:
    HAS_LLM = False

DATES = ("1998-07-01", "1998-08-01", "1998-09-01")
# with a month that only some sellers sell in: labels and predictions of both classes
LABEL_DATES = (*DATES, "2001-08-01")
# any days: month shifts that run over, windows that overlap, labels of both classes
DAYS = ("1998-03-31", "1998-04-15", "1998-04-30", "2001-07-31")
FLAGSHIP_DATE = ("1998-09-01",)
SF_SMOKE = "/root/testdata/sf0.001"

def _plan(spark: SparkSession, sf_dir: str, dates=DATES) -> FeaturePlan:
    return FeaturePlan.of(driver_roles(spark, sf_dir), dates)


def _fams(*names: str) -> list[str]:
    return [FE.window_name(n, w) for n in names for w, _ in FE.WINDOW_SUFFIXES]


FEATURE_GROUPS: dict[str, list[str]] = {
    "feat_activation": ["min_purchase_yearmonth", "min_purchase_date", "qt_total_dias_considerado", "qt_dias_venda",
                        "min_purchase_date_considerada", "qt_total_meses_considerado", "qt_meses_venda_considerado"],
    "feat_recency": ["max_purchase_date", "max_delivered_customer_date", "dias_desde_ult_venda",
                     "dias_desde_ult_estimativa_entrega", "dias_desde_ult_entrega_pedido"],
    "feat_orders": _fams("qtd_pedidos", "qtd_pedidos_entregues", "qtd_pedidos_cancelados",
                         "qtd_pedidos_outros_status", "qtd_pedidos_dt_prevista_menor_data_entrega"),
    "feat_products": _fams("qtd_produtos"),
    "feat_delivery_days": _fams("media_dias_entre_dt_compra_dt_estim_entrega", "media_dias_entre_dt_compra_dt_entrega",
                                "media_dias_entre_dt_estimada_dt_entrega"),
    "feat_value": _fams("total_vlr_pedido", "total_vlr_frete", "total_vlr_pedidos_entregues",
                        "total_vlr_pedidos_cancelados"),
    "feat_pay_orders": _fams("qtd_pedidos_pgto_cc", "qtd_pedidos_pgto_boleto", "qtd_pedidos_pgto_outros"),
    "feat_installments": _fams("media_qtd_parcelas_pedidos_pgto_cc", "media_qtd_parcelas_pedidos_pgto_voucher",
                               "max_qtd_parcelas_pedidos_pgto_cc", "max_qtd_parcelas_pedidos_pgto_voucher"),
    "feat_pay_value": _fams("total_valor_pedidos_pgto_cc", "total_valor_pedidos_pgto_boleto",
                            "total_valor_pedidos_pgto_outros"),
    "feat_reviews": _fams("qtd_review", "media_notas_review", "media_dias_entre_criacao_resposta_review"),
}

_DERIVED_PREFIXES = ("proporcao_", "tend_", "media_vlr_", "media_do_perc_", "media_valores_", "media_valor_pedidos_")
DERIVED_RATIOS = [c for c in DV.layer2_columns() if c.startswith(_DERIVED_PREFIXES)]
SELLER_PROFILE = ["fl_venda", "seller_zip_code_prefix", "seller_city", "seller_state",
                  "quantidade_de_produtos_por_categoria", "media_num_fotos_por_produto",
                  "media_fotos_por_produto_categoria", "media_tamanho_descriçao_por_produto",
                  "qtd_categorias_vendendo"]

# Fixed-weight sample scorer (B3-B5), the same in Spark and in SQL.
LINEAR = scoring.LinearScorer(
    fit_vars=("qtd_pedidos_ultimos_3_meses", "dias_desde_ult_venda", "proporcao_ativacao_meses",
              "tend_pedidos_m1_m3", "media_notas_review_ultimos_6_meses", "media_vlr_pedido_ultimos_6_meses"),
    weights=(0.35, -0.08, 1.5, 0.9, 0.2, -0.00001),
    intercept=-9.0,  # about half the sellers on each side
)
OLD_LINEAR = scoring.LinearScorer(fit_vars=LINEAR.fit_vars, weights=(0.0,) * 6, intercept=1.0)
# A real-valued scorer with a text feature.
BY_STATE = scoring.CategoryScorer(
    numbers=("qtd_pedidos_ultimos_6_meses", "dias_desde_ult_venda", "media_vlr_pedido_ultimos_6_meses"),
    weights=(0.25, -0.03125, 0.0000152587890625), category="seller_state",
    offsets=(("NATION_1", 0.5), ("NATION_7", -1.5), ("NATION_12", 2.0), ("NATION_20", -0.75)),
    intercept=0.125)


# Fixed boosted trees over features of the table (B6); a missing feature goes right.
_L, _S = trees.Leaf, trees.Split
BOOSTED = trees.TreeScorer(
    trees=(_S("qtd_pedidos_ultimos_3_meses", 2.5, _S("dias_desde_ult_venda", 61.0, _L(-0.25), _L(-0.75)),
              _S("media_notas_review_ultimos_6_meses", 2.75, _L(0.125), _L(0.5))),
           _S("proporcao_ativacao_meses", 0.9, _L(-0.5), _S("tend_pedidos_m1_m3", 0.25, _L(-0.125), _L(0.375))),
           _S("media_vlr_frete_ultimo_mes", 1500.0, _L(0.25), _S("max_qtd_parcelas_pedidos_pgto_cc_ultimos_6_meses", 10.0,
                                                                 _L(-0.375), _L(0.0625)))),
    weights=(1.0, 0.5, 0.25), cut=0.6)

# Preparation fitted on the dates TRAIN, and trees over what it makes.
TRAIN, SCORED = DATES, ("2001-08-01",)
ENCODED = ("seller_state", "seller_city")
BINNED = ("media_vlr_pedido_ultimos_6_meses", "dias_desde_ult_venda", "qtd_produtos_ate_hoje")
FILLED = ("media_vlr_pedido_ultimo_mes", "max_qtd_parcelas_pedidos_pgto_voucher_ultimo_mes")
FOLDS, WEIGHT, BINS = 4, 8.0, 7
PREPARED = trees.TreeScorer(
    trees=(_S("dias_desde_ult_venda_bin", 3.5, _S("seller_state_te", 0.9, _L(-0.25), _L(0.5)), _L(-0.5)),
           _S("media_vlr_pedido_ultimo_mes_filled", 150000.0, _S("qtd_produtos_ate_hoje_bin", 1.5, _L(-0.5), _L(0.25)),
              _S("media_vlr_pedido_ultimo_mes_missing", 0.5, _L(0.5), _L(-0.25)))),
    weights=(1.0, 0.5), cut=0.0)


def _rounded(df: DataFrame) -> DataFrame:
    """Means of means to the digits that both sides are compared to."""
    return df.select(*(F.round(F.col(f"`{c}`") + O.NUDGE, O.DIGITS).alias(c) if O.is_rounded(c) else F.col(f"`{c}`")
                       for c in df.columns))


def _linear_pipeline(spark: SparkSession, scorer: scoring.LinearScorer):
    """The linear scorer as a Spark ML pipeline of one SQL stage."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    z = f"double('{float(scorer.intercept)!r}')"
    for v, w in zip(scorer.fit_vars, scorer.weights):
        z = f"({z} + double('{float(w)!r}') * coalesce(cast({v} as double), double('0')))"
    return PipelineModel([SQLTransformer(
        statement=f"SELECT *, CASE WHEN {z} >= double('{scorer.cut!r}') THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__")])


def _models(spark: SparkSession) -> str:
    """A folder with two saved versions; the newest is LINEAR."""
    folder = _new_path(spark, "models")
    for version, scorer in (("model_1998-08-01", OLD_LINEAR), ("model_1998-09-01", LINEAR)):
        scoring.save_model(_linear_pipeline(spark, scorer), scorer.fit_vars, folder, version)
    return folder


def _new_path(spark: SparkSession, name: str) -> str:
    from vendorpulse.session import shared_dir

    return f"{shared_dir(spark)}/vendorpulse-{name}-{uuid.uuid4().hex}"


def _kept(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder: fits and transforms read them there instead of building them again."""
    path = _new_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _layer1_query(cols):
    def q(spark, sf_dir):
        return _rounded(_plan(spark, sf_dir).layer1().select("dt_ref", "seller_id", *cols))
    return q


def _layer2_query(cols, dates=DATES):
    def q(spark, sf_dir):
        return _rounded(_plan(spark, sf_dir, dates).layer2().select("dt_ref", "seller_id", *cols))
    return q


def q_preagg_payments(spark, sf_dir):
    return preagg.payments_per_order(driver_roles(spark, sf_dir).payments)


def q_preagg_items(spark, sf_dir):
    a2 = preagg.items_per_order_product(driver_roles(spark, sf_dir).items)
    return a2.select("seller_id", "order_id", "product_id", "qt_itens",
                     money(F.col("value_price")).alias("value_price"),
                     money(F.col("value_freight")).alias("value_freight"))


def q_preagg_reviews(spark, sf_dir):
    return preagg.reviews_per_order(driver_roles(spark, sf_dir).reviews)


def q_preagg_products(spark, sf_dir):
    return _plan(spark, sf_dir).seller_products()


def q_sale_label(spark, sf_dir):
    return _plan(spark, sf_dir).label()


def q_orders_asof(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return asof.orders_asof(p.roles.orders, p.dates)


def q_abt_layer1(spark, sf_dir):
    return _rounded(_plan(spark, sf_dir, FLAGSHIP_DATE).layer1().drop("dt_ref"))


def q_abt_layer2(spark, sf_dir):
    return _rounded(_plan(spark, sf_dir, FLAGSHIP_DATE).layer2().drop("dt_ref"))


def q_abt_backfill(spark, sf_dir):
    """Every month of a range."""
    return _rounded(build_abt_range(driver_roles(spark, sf_dir), DATES[0], DATES[-1]))


def q_abt_midmonth(spark, sf_dir):
    """Reference dates of any day, in one plan."""
    return _rounded(build_abt(driver_roles(spark, sf_dir), DAYS))


def q_orders_asof_midmonth(spark, sf_dir):
    """F1/F3/F9/X2 for any days."""
    plan = DayPlan.of(driver_roles(spark, sf_dir), DAYS)
    return segments.orders_asof(plan.roles.orders, plan.line(with_label=False))


def q_sale_label_midmonth(spark, sf_dir):
    """A5/F2 for any days, whose label months overlap."""
    return DayPlan.of(driver_roles(spark, sf_dir), DAYS).label()


def q_abt_from_text(spark, sf_dir):
    """The roles written as CSV text and read back; keys are text there."""
    folder = _new_path(spark, "roles")
    for name, df in driver_roles(spark, sf_dir).as_dict().items():
        df.write.option("header", True).csv(f"{folder}/{name}")
    roles = read_roles(spark, {name: f"{folder}/{name}" for name in ROLES}, "csv")
    out = _rounded(FeaturePlan.of(roles, FLAGSHIP_DATE).layer2().drop("dt_ref"))
    return out.withColumn("seller_id", F.col("seller_id").cast("bigint"))


def q_abt_rewrite(spark, sf_dir):
    """Three dates built and written, one written again, two read back by a date filter."""
    path, roles = _new_path(spark, "abt"), driver_roles(spark, sf_dir)
    job.run_job(spark, roles, path, DATES, score=False)
    job.run_job(spark, roles, path, DATES[1:2], score=False)
    return _rounded(read_abt(spark, path, DATES[1:]))


def q_abt_published(spark, sf_dir):
    """A published table whose readers are pinned; one date is written again, another write is left unpublished."""
    from vendorpulse.plans.versions import Versions

    path, roles = _new_path(spark, "abt"), driver_roles(spark, sf_dir)
    first = publish_abt(build_abt(roles, DATES, reduced=True), path, DATES)
    none = roles.__class__(**{**roles.as_dict(), "orders": roles.orders.where("order_status = 'canceled'")})
    publish_abt(build_abt(none, DATES[1:2], reduced=True), path, DATES[1:2])
    with bloom_filters(spark):
        Versions(spark, path).stage("abt", build_abt(none, DATES[2:], reduced=True), "dt_ref")  # as a write that fails before its last step
    kept = read_published(spark, path, DATES[1:2], first)                     # the version that a reader has opened
    return _rounded(read_published(spark, path, (DATES[0], DATES[2])).unionByName(kept))


def q_abt_reduced(spark, sf_dir):
    """Payments and reviews of the orders in scope alone."""
    return _rounded(_plan(spark, sf_dir, FLAGSHIP_DATE).reduced().layer2().drop("dt_ref"))


def q_abt_bucketed(spark, sf_dir):
    """The roles stored in buckets of orders; the large joins of the build need no exchange."""
    path = _new_path(spark, "bucketed")
    write_bucketed(driver_roles(spark, sf_dir), path)
    return _rounded(FeaturePlan.of(read_bucketed(spark, path), DATES).layer2())


#: stamps of the logs of q_abt_incremental: a month, and rows of every kind for old months, arrive in the second delivery
LATE = {"orders": "order_purchase_timestamp >= '1998-08-01' OR order_id % 17 = 0", "items": "order_id % 13 = 0 AND order_item_id = 2",
        "payments": "order_id % 11 = 0 AND payment_sequential > 1", "reviews": "order_id % 7 = 0"}


def stamped_logs(roles):
    """The roles as logs with a stamp; some orders have an earlier row that the second delivery corrects."""
    logs = {n: (df.withColumn("ingested_at", F.when(F.expr(LATE[n]), 2).otherwise(1)) if n in LATE else df)
            for n, df in roles.as_dict().items()}
    other = roles.orders.where("order_id % 19 = 0").withColumns({
        "order_status": F.lit("shipped"), "order_delivered_customer_date": F.lit(None).cast("date"),
        "order_purchase_timestamp": F.expr("order_purchase_timestamp - INTERVAL 40 DAYS"), "ingested_at": F.lit(0)})
    logs["orders"] = logs["orders"].unionByName(other)
    return roles.__class__(**logs)


def q_abt_incremental(spark, sf_dir):
    """S3: the stored month state, built from a first delivery and refreshed by a second."""
    logs = stamped_logs(driver_roles(spark, sf_dir))
    state = MonthState(spark, _new_path(spark, "state"))
    state.refresh(logs.__class__(**{n: df.where("ingested_at <= 1") if "ingested_at" in df.columns else df
                                    for n, df in logs.as_dict().items()}))
    state.refresh(logs)
    return _rounded(state.layer2(DATES, logs.products, logs.sellers))


def q_job_both(spark, sf_dir):
    """Build and score in one run with the newest model; the predictions as they were written."""
    predictions = _new_path(spark, "predictions")
    job.run_job(spark, driver_roles(spark, sf_dir), _new_path(spark, "abt"), LABEL_DATES, models_dir=_models(spark),
                predictions_path=predictions)
    return spark.read.schema("dt_ref date, seller_id bigint, fl_venda_predict int").option("header", True).csv(predictions)


def q_score_linear(spark, sf_dir):
    return scoring.score_with_column(_plan(spark, sf_dir, LABEL_DATES).layer2(), LINEAR)


def q_score_predict(spark, sf_dir):
    """B4 through ``mapInPandas`` with the same fixed-weight model."""
    return scoring.score_with_predict(_plan(spark, sf_dir, LABEL_DATES).layer2(), LINEAR, LINEAR.fit_vars)


def q_score_category(spark, sf_dir):
    """A text feature and real-valued predictions."""
    return scoring.score_with_predict(_plan(spark, sf_dir, LABEL_DATES).layer2(), BY_STATE, BY_STATE.fit_vars, "double")


def q_score_trees(spark, sf_dir):
    """Boosted trees as one column expression."""
    return trees.score_with_trees(_plan(spark, sf_dir, LABEL_DATES).layer2(), BOOSTED)


def q_encode_target(spark, sf_dir):
    """Categories as smoothed label means, out of fold and over all rows."""
    abt = _kept(_plan(spark, sf_dir, LABEL_DATES).layer2().select("dt_ref", "seller_id", "fl_venda", *ENCODED))
    encoder = preparation.TargetEncoder.fit(abt, ENCODED, folds=FOLDS, weight=WEIGHT)
    both = encoder.transform(encoder.transform(abt, training=True, suffix="_out_of_fold"))
    return both.select("dt_ref", "seller_id", *(F.round(F.col(f"{c}{s}") + O.NUDGE, O.DIGITS).alias(f"{c}{s}")
                                                for c in ENCODED for s in ("_out_of_fold", "_te")))


def q_bin_features(spark, sf_dir):
    """Numbers as quantile bins."""
    abt = _kept(_plan(spark, sf_dir, LABEL_DATES).layer2().select("dt_ref", "seller_id", *BINNED))
    return preparation.Binner.fit(abt, BINNED, BINS).transform(abt).select("dt_ref", "seller_id", *(f"{c}_bin" for c in BINNED))


def q_score_prepared(spark, sf_dir):
    """Encodings, bins and medians fitted on earlier months, trees over them for a later one."""
    past, now = (_plan(spark, sf_dir, d).layer2().select("dt_ref", "seller_id", "fl_venda", *ENCODED, *BINNED, *FILLED)
                 for d in (TRAIN, SCORED))
    past = _kept(past)
    rows = preparation.TargetEncoder.fit(past, ENCODED, folds=FOLDS, weight=WEIGHT).transform(now)
    rows = preparation.Binner.fit(past, BINNED, BINS).transform(rows)
    return trees.score_with_trees(preparation.Imputer.fit(past, FILLED).transform(rows), PREPARED)


def q_score_pipeline(spark, sf_dir):
    """B1-B5 with Spark ML: the written feature table, scored with the newest of two saved pipelines."""
    path = _new_path(spark, "abt")
    write_abt(_plan(spark, sf_dir, LABEL_DATES).layer2(), path, dates=LABEL_DATES)
    model, fit_vars = scoring.load_model(_models(spark), spark)
    return scoring.score_with_pipeline(read_abt(spark, path), model, fit_vars)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the 201-column feature table of 1998-09-01 on sf0.001."""
    return q_abt_layer2(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "preagg_payments": q_preagg_payments,
        "preagg_items": q_preagg_items,
        "preagg_reviews": q_preagg_reviews,
        "preagg_products": q_preagg_products,
        "sale_label": q_sale_label,
        "orders_asof": q_orders_asof,
    }
    qs.update({name: _layer1_query(cols) for name, cols in FEATURE_GROUPS.items()})
    qs.update({
        "derived_ratios": _layer2_query(DERIVED_RATIOS),
        "seller_profile": _layer2_query(SELLER_PROFILE, LABEL_DATES),
        "abt_layer1": q_abt_layer1,
        "abt_layer2": q_abt_layer2,
        "abt_backfill": q_abt_backfill,
        "abt_midmonth": q_abt_midmonth,
        "orders_asof_midmonth": q_orders_asof_midmonth,
        "sale_label_midmonth": q_sale_label_midmonth,
        "abt_from_text": q_abt_from_text,
        "abt_rewrite": q_abt_rewrite,
        "abt_published": q_abt_published,
        "abt_incremental": q_abt_incremental,
        "abt_bucketed": q_abt_bucketed,
        "abt_reduced": q_abt_reduced,
        "job_both": q_job_both,
        "score_linear": q_score_linear,
        "score_category": q_score_category,
        "score_predict": q_score_predict,
        "score_pipeline": q_score_pipeline,
        "score_trees": q_score_trees,
        "encode_target": q_encode_target,
        "bin_features": q_bin_features,
        "score_prepared": q_score_prepared,
    })
    if HAS_LLM:
        qs.update(LQ.QUERIES)
        qs["pipeline"] = corpus_pipeline.run
    return qs


def _weighted_sql(numbers, weights, intercept) -> str:
    z = f"cast({float(intercept)!r} as double)"
    for v, w in zip(numbers, weights):
        z = f"({z} + {float(w)!r} * coalesce(cast({v} as double), 0.0))"
    return z


def _linear_sql() -> str:
    z = _weighted_sql(LINEAR.fit_vars, LINEAR.weights, LINEAR.intercept)
    return O.sql_over_layer2(LABEL_DATES, f"select dt_ref, seller_id, case when {z} >= {LINEAR.cut!r} then 1 else 0 end"
                                          " as fl_venda_predict from abt")


def _category_sql() -> str:
    z = _weighted_sql(BY_STATE.numbers, BY_STATE.weights, BY_STATE.intercept)
    state = " ".join(f"when '{k}' then {v!r}" for k, v in BY_STATE.offsets)
    return O.sql_over_layer2(LABEL_DATES, f"select dt_ref, seller_id, {z} + cast(case seller_state {state} else 0.0 end"
                                          " as double) as fl_venda_predict from abt")


def _tree_sql(node) -> str:
    """A tree as nested conditions; written here, not by the library."""
    if isinstance(node, trees.Leaf):
        return f"{node.value!r}::double"
    return (f'(case when "{node.feature}"::double <= {node.threshold!r} then {_tree_sql(node.left)} '
            f'else {_tree_sql(node.right)} end)')


def _boosted_sql(scorer) -> str:
    total = " + ".join(f"{w!r}::double * {_tree_sql(t)}" for w, t in zip(scorer.weights, scorer.trees))
    return f"select dt_ref, seller_id, cast(({total}) > {scorer.cut!r} as int) as fl_venda_predict"


_FOLD_SQL = f"('0x' || substr(md5(cast(seller_id as varchar)), 1, 8))::bigint % {FOLDS}"


def _encoded_sql(column: str, train: str, row: str, out_of_fold: bool) -> str:
    """The encoding of the row ``row``: over the rows of ``train`` that have its category, and aren't of its fold."""
    other = f" and {_FOLD_SQL.replace('seller_id', 't.seller_id')} <> {_FOLD_SQL.replace('seller_id', row + '.seller_id')}" if out_of_fold else ""
    prior = f"(select avg(fl_venda) from {train} t where true{other})"
    sums = f"from {train} t where t.{column} is not distinct from {row}.{column}{other}"
    return (f"((select coalesce(sum(fl_venda), 0) {sums}) + {WEIGHT} * {prior}) / ((select count(*) {sums}) + {WEIGHT})")


def _bin_sql(column: str, train: str, row: str) -> str:
    """How many different edges are below the value; edges are the least values with a share k/BINS at or below them."""
    edges = ", ".join(f"quantile_disc({column}::double, {k / BINS!r})" for k in range(1, BINS))
    return (f"case when {row}.{column} is null then -1 else cast(len(list_filter(list_distinct((select [{edges}] from {train})), "
            f"lambda e: e < {row}.{column}::double)) as int) end")


def _encode_sql() -> str:
    cols = ", ".join(f"round({_encoded_sql(c, 'abt', 'a', s == '_out_of_fold')} + {O.NUDGE!r}, {O.DIGITS}) as {c}{s}"
                     for c in ENCODED for s in ("_out_of_fold", "_te"))
    return O.sql_over_layer2(LABEL_DATES, f"select dt_ref, seller_id, {cols} from abt a")


def _bins_sql() -> str:
    return O.sql_over_layer2(LABEL_DATES, "select dt_ref, seller_id, "
                             + ", ".join(f"{_bin_sql(c, 'abt', 'a')} as {c}_bin" for c in BINNED) + " from abt a")


def _prepared_sql() -> str:
    past = f"(select * from abt where dt_ref < DATE '{SCORED[0]}')"
    cols = [f"{_encoded_sql(c, past, 'a', False)} as {c}_te" for c in ENCODED]
    cols += [f"{_bin_sql(c, past, 'a')} as {c}_bin" for c in BINNED]
    cols += [f"coalesce(a.{c}::double, (select quantile_disc({c}::double, 0.5) from {past})) as {c}_filled, "
             f"cast(a.{c} is null as int) as {c}_missing" for c in FILLED]
    rows = f"select dt_ref, seller_id, {', '.join(cols)} from abt a where dt_ref = DATE '{SCORED[0]}'"
    return O.sql_over_layer2((*TRAIN, *SCORED), f"{_boosted_sql(PREPARED)} from ({rows})")


def oracle_sql() -> dict[str, str]:
    sql = {name: O.sql_preagg(name) for name in ("preagg_payments", "preagg_items", "preagg_reviews",
                                                  "preagg_products")}
    sql["sale_label"] = O.sql_label(DATES)
    sql["orders_asof"] = O.sql_orders_asof(DATES)
    for name, cols in FEATURE_GROUPS.items():
        sql[name] = O.sql_layer1(DATES, ["seller_id", *cols])
    sql["derived_ratios"] = O.sql_layer2(DATES, ["seller_id", *DERIVED_RATIOS])
    sql["seller_profile"] = O.sql_layer2(LABEL_DATES, ["seller_id", *SELLER_PROFILE])
    sql["abt_layer1"] = O.sql_layer1(FLAGSHIP_DATE, FE.layer1_columns(), with_date=False)
    sql["abt_layer2"] = O.sql_layer2(FLAGSHIP_DATE, DV.layer2_columns(), with_date=False)
    sql["abt_backfill"] = O.sql_layer2(DATES, DV.layer2_columns())
    sql["abt_midmonth"] = O.sql_layer2(DAYS, DV.layer2_columns())
    sql["orders_asof_midmonth"] = O.sql_orders_asof(DAYS)
    sql["sale_label_midmonth"] = O.sql_label(DAYS)
    sql["score_linear"] = _linear_sql()
    sql["abt_from_text"] = sql["abt_reduced"] = sql["abt_layer2"]
    sql["abt_rewrite"] = O.sql_layer2(DATES[1:], DV.layer2_columns())
    sql["score_trees"] = O.sql_over_layer2(LABEL_DATES, f"{_boosted_sql(BOOSTED)} from abt")
    sql["encode_target"], sql["bin_features"], sql["score_prepared"] = _encode_sql(), _bins_sql(), _prepared_sql()
    sql["abt_published"] = sql["abt_incremental"] = sql["abt_bucketed"] = sql["abt_backfill"]
    sql["score_category"] = _category_sql()
    for name in ("score_predict", "score_pipeline", "job_both"):
        sql[name] = sql["score_linear"]
    if HAS_LLM:
        sql.update(LQ.ORACLE_SQL)
    return sql
