"""Layer 1 of the feature table: 13 single measures + 26 families x 7 windows per seller.

Every family is one aggregate over the seller's rows of a window.  Windows:
``_ate_hoje`` (the whole 12-month observation scope), ``_ultimo_mes`` and
``_ultimos_N_meses`` (N = 2..6).  They share their upper bound and nest, so
each row falls in one recency bucket ``b`` and window N is ``b <= N``.

Three aggregation levels, none of them with a distinct aggregate:

* month grain (:func:`month_groups`): every (order, seller) row once, keyed
  by date-independent month keys — the pass over the big data;
* level A: the month groups attached to each reference date
  (:func:`expand_dates`) and combined per (dt_ref, seller, kind, value) — for
  ``main`` rows the value is the recency bucket;
* level B: the level-A rows of a seller brought to one row a bucket, and those
  (at most eight) folded into the seven windows.

The definitions count *distinct orders*, *distinct sale days and months*,
and average *distinct installment counts*.  At the (order, seller) grain a
distinct order count is a plain ``count_if``; sale days and months are exact
bitmaps (a bucket 1..6 is exactly one month, so day-of-month bits do not
collide); installment values are grouping keys of their own rows.  No
``count(distinct …)`` reaches the planner, so there is no ``Expand``.

The generated aggregates are written as SQL expression text: one ``F.expr``
per aggregate builds the same plan as the Column API at a fraction of the
driver-side cost (hundreds of expressions per feature table).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.arith import MONEY, MONEY_SCALE, safe_div_sql
from .asof import KIND_CC, KIND_LABEL, KIND_MAIN, KIND_VOUCHER

c = F.col

# Window suffixes of the feature names, in output order.
WINDOW_SUFFIXES = (
    (None, "ate_hoje"),
    (1, "ultimo_mes"),
    (2, "ultimos_2_meses"),
    (3, "ultimos_3_meses"),
    (4, "ultimos_4_meses"),
    (5, "ultimos_5_meses"),
    (6, "ultimos_6_meses"),
)


def window_name(family: str, n: int | None) -> str:
    return f"{family}_{dict(WINDOW_SUFFIXES)[n]}"


@dataclass(frozen=True)
class Family:
    """One feature family; ``value`` and ``cond`` are Spark SQL expressions over the row columns.

    kind:
      ``orders``       number of distinct orders with ``cond``
      ``lines``        number of product lines
      ``line_sum``     sum of a line-level value (price, freight)
      ``order_sum``    sum of an order-level value repeated on each product line
      ``order_avg``    mean of an order-level value over product lines
      ``order_max``    maximum of an order-level value
      ``distinct_avg`` mean over the distinct values of an order-level value
    """
    name: str
    kind: str
    value: str | None = None
    cond: str | None = None
    distinct_key: str | None = None
    # ``order_avg`` of a fractional value: accumulate in fixed point with this
    # many decimals, so the sum is exact and independent of partition order.
    scale: int | None = None
    # reads the as-of delivery date (empty when the delivery is not before dt_ref)
    uses_dlv: bool = False

    def value_col(self) -> Column:
        return F.expr(self.value)

    def cond_col(self) -> Column | None:
        return None if self.cond is None else F.expr(self.cond)


DELIVERED = "order_status = 'delivered' AND dlv IS NOT NULL"
PAID_OTHER = "inst_debit_card + inst_voucher <> 0"

# The 26 families of the feature definitions, in output order.
FAMILIES: tuple[Family, ...] = (
    Family("qtd_pedidos", "orders"),
    Family("qtd_pedidos_entregues", "orders", cond=DELIVERED, uses_dlv=True),
    Family("qtd_pedidos_cancelados", "orders", cond="order_status = 'canceled'"),
    Family("qtd_pedidos_outros_status", "orders", cond="NOT order_status IN ('delivered', 'canceled')"),
    Family("qtd_pedidos_dt_prevista_menor_data_entrega", "orders",
           cond="order_status = 'delivered' AND est < dlv", uses_dlv=True),
    Family("qtd_produtos", "lines"),
    Family("media_dias_entre_dt_compra_dt_estim_entrega", "order_avg", value="datediff(est, pdate)"),
    Family("media_dias_entre_dt_compra_dt_entrega", "order_avg", value="datediff(dlv, pdate)", uses_dlv=True),
    Family("media_dias_entre_dt_estimada_dt_entrega", "order_avg", value="datediff(est, dlv)", uses_dlv=True),
    Family("total_vlr_pedido", "line_sum", value="value_price"),
    Family("total_vlr_frete", "line_sum", value="value_freight"),
    Family("total_vlr_pedidos_entregues", "line_sum", value="value_price", cond=DELIVERED, uses_dlv=True),
    Family("total_vlr_pedidos_cancelados", "line_sum", value="value_price", cond="order_status = 'canceled'"),
    Family("qtd_pedidos_pgto_cc", "orders", cond="inst_credit_card <> 0"),
    Family("qtd_pedidos_pgto_boleto", "orders", cond="inst_boleto <> 0"),
    Family("qtd_pedidos_pgto_outros", "orders", cond=PAID_OTHER),
    Family("media_qtd_parcelas_pedidos_pgto_cc", "distinct_avg", distinct_key="cc"),
    Family("media_qtd_parcelas_pedidos_pgto_voucher", "distinct_avg", distinct_key="voucher"),
    Family("max_qtd_parcelas_pedidos_pgto_cc", "order_max", value="inst_credit_card",
           cond="inst_credit_card <> 0"),
    Family("max_qtd_parcelas_pedidos_pgto_voucher", "order_max", value="inst_voucher", cond="inst_voucher <> 0"),
    Family("total_valor_pedidos_pgto_cc", "order_sum", value="val_credit_card", cond="inst_credit_card <> 0"),
    Family("total_valor_pedidos_pgto_boleto", "order_sum", value="val_boleto", cond="inst_boleto <> 0"),
    Family("total_valor_pedidos_pgto_outros", "order_sum", value="val_voucher + val_debit_card", cond=PAID_OTHER),
    Family("qtd_review", "order_sum", value="qt_reviews"),
    Family("media_notas_review", "order_avg", value="avg_score", scale=9),
    Family("media_dias_entre_criacao_resposta_review", "order_avg", value="avg_days_create_answer", scale=9),
)

DISTINCT_KINDS = {"cc": KIND_CC, "voucher": KIND_VOUCHER}

# The 13 single measures, in output order (seller_id first).
SINGLES = (
    "seller_id", "min_purchase_yearmonth", "min_purchase_date", "qt_total_dias_considerado",
    "qt_dias_venda", "min_purchase_date_considerada", "qt_total_meses_considerado",
    "qt_meses_venda_considerado", "max_purchase_date", "max_delivered_customer_date",
    "dias_desde_ult_venda", "dias_desde_ult_estimativa_entrega", "dias_desde_ult_entrega_pedido",
)


def layer1_columns() -> list[str]:
    return list(SINGLES) + [window_name(f.name, n) for f in FAMILIES for n, _ in WINDOW_SUFFIXES]


def q(name: str) -> str:
    """Quoted identifier (feature names may hold non-ASCII letters)."""
    return f"`{name}`"


def exprs(*sql: str) -> list[Column]:
    return [F.expr(s) for s in sql]


def from_units_sql(x: str) -> str:
    m = MONEY.simpleString()
    return f"CAST(CAST({x} AS {m}) / {10 ** MONEY_SCALE} AS {m})"


# ---------------------------------------------------------------- month grain

def _partials(f: Family) -> list[str]:
    """One additive partial per family over the ``main`` rows of a month group."""
    cond = f"k = {KIND_MAIN}" + ("" if f.cond is None else f" AND ({f.cond})")
    x = q(f"{f.name}__x")

    def when(v):
        return f"CASE WHEN {cond} THEN {v} END"

    if f.kind == "orders":
        return [f"count_if({cond}) AS {x}"]
    if f.kind == "lines":
        return [f"sum({when('n_products')}) AS {x}"]
    if f.kind == "line_sum":
        return [f"sum({when(f.value)}) AS {x}"]
    if f.kind == "order_sum":
        return [f"sum({when(f'({f.value}) * n_lines')}) AS {x}"]
    if f.kind == "order_avg":
        weighted = (f"({f.value}) * n_lines" if f.scale is None else
                    f"CAST(({f.value}) AS DECIMAL(27,{f.scale})) * CAST(n_lines AS DECIMAL(10,0))")
        return [f"sum({when(weighted)}) AS {q(f.name + '__num')}",
                f"sum(CASE WHEN {cond} AND ({f.value}) IS NOT NULL THEN n_lines END) AS {q(f.name + '__den')}"]
    if f.kind == "order_max":
        return [f"max({when(f.value)}) AS {x}"]
    if f.kind == "distinct_avg":
        return []
    raise ValueError(f.kind)


def _partial_names(f: Family) -> list[str]:
    if f.kind == "order_avg":
        return [f"{f.name}__num", f"{f.name}__den"]
    return [] if f.kind == "distinct_avg" else [f"{f.name}__x"]


MONTH_KEYS = ("seller_id", "pm", "ld", "paid", "k", "v", "dm")


def month_groups(rows: DataFrame) -> DataFrame:
    """Date-independent grain: (seller, purchase month, last-day flag, paid, kind, value, delivery month).

    All family partials are additive (counts, sums, fixed-point numerators
    and denominators, maxima), so a reference date only has to combine the
    groups of its window.  Sale days are kept as a day-of-month bitmap.
    """
    main = f"k = {KIND_MAIN}"
    return rows.groupBy(*MONTH_KEYS).agg(*exprs(
        *partials(), f"bit_or(CASE WHEN {main} THEN shiftleft(1L, dayofmonth(pdate)) END) AS day_bits"))


def partials() -> list[str]:
    """The additive partials of a group of rows, but for its bitmaps."""
    main = f"k = {KIND_MAIN}"
    aggs = [
        f"min(CASE WHEN {main} THEN pdate END) AS min_pdate",
        f"max(CASE WHEN {main} THEN pdate END) AS max_pdate",
        f"max(CASE WHEN {main} THEN est END) AS max_est",
        f"max(CASE WHEN {main} THEN dlv END) AS max_dlv",
    ]
    for f in FAMILIES:
        aggs.extend(_partials(f))
    return aggs


# ---------------------------------------------------------------- reference dates

def expand_dates(groups: DataFrame, dates, include_last_day: bool = False, with_label: bool = True) -> DataFrame:
    """Attach the reference dates whose windows hold each month group.

    For a first-of-month date with month number ``r``: a paid group is observed
    when ``r-12 <= pm <= r-1`` (minus last-day purchases of month ``r-1``),
    its bucket is ``min(r - pm, 7)``, its delivery is visible when
    ``dm < r``; a ``main`` group is a next-month sale for ``r == pm`` (minus
    last-day purchases).  The candidates come from ``pm``, so a group makes at
    most 13 rows however many dates are asked for, and none for other dates.
    """
    months = D.observed_months_sql(dates, "pm", "ld", include_last_day, also="paid")
    if with_label:
        asked = ", ".join(str(D.month_number(d)) for d in dates)
        last = "" if include_last_day else " AND NOT ld"
        months.append(f"CASE WHEN k = {KIND_MAIN} AND pm IN ({asked}){last} THEN pm END")
    # a plain array stays inside whole-stage codegen; the empty places go right after
    x = groups.select("*", F.explode(F.expr(f"array({', '.join(months)})")).alias("_r")).where("_r IS NOT NULL")
    return x.selectExpr(
        "*",
        f"{D.month_start_sql('_r')} AS dt_ref",
        f"CASE WHEN _r = pm THEN {KIND_LABEL} ELSE k END AS k2",
        f"CASE WHEN _r > pm THEN least(_r - pm, {D.OUTSIDE_TRAILING}) END AS b",
        "dm < _r AS kept",
        "_r - pm AS month_off",
    )


def _window(n: int | None) -> str:
    return "true" if n is None else f"b <= {n}"


def _window_aggs(f: Family) -> list[str]:
    """Level B: fold the bucket partials of a seller into the seven nested windows."""
    out = []
    for n, _ in WINDOW_SUFFIXES:
        w = _window(n)
        x = f"{f.name}__x"

        def s(col):
            return f"sum(CASE WHEN {w} THEN {q(col)} END)"

        if f.kind in ("orders", "lines"):
            agg = f"coalesce({s(x)}, CAST(0 AS BIGINT))"
        elif f.kind == "line_sum":
            agg = from_units_sql(s(x))
        elif f.kind == "order_sum":
            agg = f"CAST({s(x)} AS BIGINT)" if f.name == "qtd_review" else from_units_sql(s(x))
        elif f.kind == "order_avg":
            agg = safe_div_sql(s(f.name + "__num"), s(f.name + "__den"))
        elif f.kind == "order_max":
            agg = f"CAST(max(CASE WHEN {w} THEN {q(x)} END) AS BIGINT)"
        elif f.kind == "distinct_avg":
            agg = safe_div_sql(s(f.distinct_key + "__num"), s(f.distinct_key + "__den"))
        else:
            raise ValueError(f.kind)
        out.append(f"{agg} AS {q(window_name(f.name, n))}")
    return out


def by_seller(groups: DataFrame) -> DataFrame:
    """Groups dealt by seller, before dates multiply them: levels A and B and the joins by seller need no other exchange.

    A seller's groups are few (months, values), however many rows they were
    made of.  All the session's shuffle partitions, uncoalesced: what a task
    makes of its groups is many times what it reads.
    """
    return groups.repartition(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seller_id")


def seller_month_aggregate(groups: DataFrame, dates, include_last_day: bool = False,
                           with_label: bool = True) -> DataFrame:
    """A6 (+ the label flag), one row per (dt_ref, seller), from the month groups.

    Level A combines the month groups of each (dt_ref, seller, kind, value)
    — for ``main`` the value is the recency bucket, so a bucket of 1..6 is
    exactly one month.  Level B folds those few rows into the windows.
    """
    return fold_windows(expand_dates(by_seller(groups), dates, include_last_day, with_label))


def fold_windows(x: DataFrame, month_bits: str = "shiftleft(1L, month_off)") -> DataFrame:
    """Levels A and B: groups attached to their dates (:func:`expand_dates`) become one row per (dt_ref, seller).

    ``month_bits``: the months of a group's purchases as bits.  ``day_bits``
    must tell the days of one bucket apart.
    """
    main = f"k2 = {KIND_MAIN}"
    level_a = [
        "min(b) AS b",
        f"min(CASE WHEN {main} THEN min_pdate END) AS min_purchase_date",
        f"max(CASE WHEN {main} THEN max_pdate END) AS max_purchase_date",
        f"max(CASE WHEN {main} THEN max_est END) AS max_est",
        f"max(CASE WHEN {main} AND kept THEN max_dlv END) AS max_delivered_customer_date",
        f"bit_or(CASE WHEN {main} THEN {month_bits} END) AS month_bits",
        f"bit_or(CASE WHEN {main} AND b <= {D.ACTIVATION_MONTHS} THEN day_bits END) AS day_bits",
    ]
    for f in FAMILIES:
        keep = f"{main} AND kept" if f.uses_dlv else main
        fn = "max" if f.kind == "order_max" else "sum"
        level_a += [f"{fn}(CASE WHEN {keep} THEN {q(n)} END) AS {q(n)}" for n in _partial_names(f)]
    v = f"CAST(CASE WHEN k2 = {KIND_MAIN} THEN b WHEN k2 = {KIND_LABEL} THEN NULL ELSE v END AS BIGINT)"
    per_key = x.groupBy("dt_ref", "seller_id", c("k2").alias("k"), F.expr(v).alias("v")).agg(*exprs(*level_a))

    # one row a bucket: the wide aggregate below runs over these, not over a row for each installment value
    bucket = [
        "min(min_purchase_date) AS min_purchase_date",
        "max(max_purchase_date) AS max_purchase_date",
        "max(max_delivered_customer_date) AS max_delivered_customer_date",
        "max(max_est) AS max_est",
        f"count_if(k = {KIND_MAIN}) AS n_main",
        "bit_or(day_bits) AS day_bits",
        "bit_or(month_bits) AS month_bits",
        f"max(CASE WHEN k = {KIND_LABEL} THEN 1 END) AS fl_venda",
    ]
    for key, kind in DISTINCT_KINDS.items():
        bucket += [f"sum(CASE WHEN k = {kind} THEN v END) AS {key}__num", f"count(CASE WHEN k = {kind} THEN v END) AS {key}__den"]
    for f in FAMILIES:
        fn = "max" if f.kind == "order_max" else "sum"
        bucket += [f"{fn}({q(n)}) AS {q(n)}" for n in _partial_names(f)]
    per_bucket = per_key.groupBy("dt_ref", "seller_id", "b").agg(*exprs(*bucket))

    level_b = [
        "min(min_purchase_date) AS min_purchase_date",
        "max(max_purchase_date) AS max_purchase_date",
        "max(max_delivered_customer_date) AS max_delivered_customer_date",
        "max(max_est) AS max_est",
        "sum(n_main) AS n_main",
        "CAST(coalesce(sum(bit_count(day_bits)), 0) AS BIGINT) AS qt_dias_venda",
        "coalesce(bit_count(bit_or(month_bits)), 0) AS n_months",
        "max(fl_venda) AS fl_venda",
    ]
    for f in FAMILIES:
        level_b.extend(_window_aggs(f))
    agg = per_bucket.groupBy("dt_ref", "seller_id").agg(*exprs(*level_b))

    # least/greatest skip NULLs where the original scalar min/max propagate them;
    # both arguments are never NULL here (every seller row has a purchase date).
    considered = f"greatest({D.shift_months_sql('dt_ref', -D.ACTIVATION_MONTHS)}, min_purchase_date)"

    singles = {
        "min_purchase_yearmonth": "date_format(min_purchase_date, 'yyyyMM')",
        "qt_total_dias_considerado": f"CAST(datediff(dt_ref, {considered}) AS BIGINT)",
        "min_purchase_date_considerada": considered,
        "qt_total_meses_considerado":
            f"CAST(least({D.month_number_sql('dt_ref')} - {D.month_number_sql('min_purchase_date')}, {D.ACTIVATION_MONTHS})"
            " AS BIGINT)",
        "qt_meses_venda_considerado": f"CAST(least(n_months, {D.ACTIVATION_MONTHS}) AS BIGINT)",
        "dias_desde_ult_venda": "CAST(datediff(dt_ref, max_purchase_date) AS BIGINT)",
        "dias_desde_ult_estimativa_entrega": "CAST(datediff(dt_ref, max_est) AS BIGINT)",
        "dias_desde_ult_entrega_pedido": "CAST(datediff(dt_ref, max_delivered_customer_date) AS BIGINT)",
    }
    out = ["dt_ref"] + [f"{singles[n]} AS {q(n)}" if n in singles else q(n) for n in layer1_columns()] + ["fl_venda"]
    return agg.where("n_main > 0").selectExpr(*out)


def layer1(groups: DataFrame, dates, include_last_day: bool = False) -> DataFrame:
    """``dt_ref`` + the 195 layer-1 columns."""
    return seller_month_aggregate(groups, dates, include_last_day, with_label=False).drop("fl_venda")
