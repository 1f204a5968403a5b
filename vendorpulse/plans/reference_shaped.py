"""The feature table written the way the original definitions read, for comparison.

One plan per reference date at product-line grain, with ``count(distinct …)``
and ``avg(distinct …)`` per window, unioned across dates.  Spark rewrites
the distinct aggregates with an ``Expand`` (one copy of every row per
distinct expression).  It is kept as the baseline of the benchmark and as a
second, Spark-side check of :mod:`vendorpulse.plans.abt`; it is not the
production path.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.arith import money
from ..operators import features as FE
from ..operators.preagg import items_per_order_product, payments_per_order, reviews_per_order
from ..sources.roles import Roles

c = F.col


def _line_value(f: FE.Family) -> Column | None:
    """The family's value at line grain (order-level values repeat per line)."""
    if f.kind in ("line_sum", "order_sum", "order_avg", "order_max"):
        return f.value_col()
    return None


def _agg(f: FE.Family, win: Column) -> Column:
    cond = win if f.cond is None else (win & f.cond_col())
    if f.kind == "orders":
        return F.count_distinct(F.when(cond, c("order_id")))
    if f.kind == "lines":
        return F.count(F.when(cond, c("product_id")))
    if f.kind == "line_sum":
        return money(F.sum(F.when(cond, _line_value(f))))
    if f.kind == "order_sum":
        s = F.sum(F.when(cond, _line_value(f)))
        return s.cast("bigint") if f.name == "qtd_review" else money(s)
    if f.kind == "order_avg":
        v = _line_value(f)
        if f.scale is not None:
            v = v.cast(f"decimal(27,{f.scale})")
        return F.try_divide(F.sum(F.when(cond, v)).cast("double"), F.count(F.when(cond, v)).cast("double"))
    if f.kind == "order_max":
        return F.max(F.when(cond, _line_value(f))).cast("bigint")
    raise ValueError(f.kind)


def _avg_distinct(col: str, win: Column) -> Column:
    """``avg(distinct …)`` as distinct sum over distinct count."""
    x = F.when(win & (c(col) != 0), c(col))
    return F.try_divide(F.sum_distinct(x).cast("double"), F.count_distinct(x).cast("double"))


def layer1_one_date(roles: Roles, ref: _dt.date, include_last_day: bool = False) -> DataFrame:
    r = F.lit(ref)
    ts = c("order_purchase_timestamp")
    orders = roles.orders.where(D.in_observation(ts, r, include_last_day)).select(
        "order_id", "order_status", "order_purchase_timestamp",
        F.to_date(ts).alias("pdate"),
        D.mask_after(c("order_delivered_customer_date"), r).alias("dlv"),
        F.to_date("order_estimated_delivery_date").alias("est"))
    pay = payments_per_order(roles.payments).select(
        "order_id", *[c(f"installments_{t}").alias(f"inst_{t}") for t in ("credit_card", "debit_card", "boleto",
                                                                         "voucher")],
        *[c(f"value_{t}").alias(f"val_{t}") for t in ("credit_card", "debit_card", "boleto", "voucher")])
    rev = reviews_per_order(roles.reviews).select("order_id", "qt_reviews", "avg_score", "avg_days_create_answer")
    lines = (orders.join(items_per_order_product(roles.items), "order_id")
             .withColumn("n_lines", F.lit(1)).withColumn("n_products", F.lit(1))
             .join(pay, "order_id").join(rev, "order_id", "left"))
    hi = D.window_end(r, include_last_day)
    six = F.add_months(r, -D.ACTIVATION_MONTHS)
    aggs = [
        F.min("pdate").alias("min_purchase_date"),
        F.count_distinct(F.when(c("pdate") >= six, c("pdate"))).alias("qt_dias_venda"),
        F.count_distinct(F.date_format("pdate", "yyyyMM")).alias("n_months"),
        F.max("pdate").alias("max_purchase_date"),
        F.max("dlv").alias("max_delivered_customer_date"),
        F.max("est").alias("max_est"),
    ]
    for f in FE.FAMILIES:
        for n, _ in FE.WINDOW_SUFFIXES:
            win = F.lit(True) if n is None else (ts >= F.add_months(r, -n)) & (ts < hi)
            if f.kind == "distinct_avg":
                col = {"cc": "inst_credit_card", "voucher": "inst_voucher"}[f.distinct_key]
                agg = _avg_distinct(col, win)
            else:
                agg = _agg(f, win)
            aggs.append(agg.alias(FE.window_name(f.name, n)))
    g = lines.groupBy("seller_id").agg(*aggs).withColumn("dt_ref", r)
    considered = F.greatest(six, c("min_purchase_date"))
    singles = {
        "min_purchase_yearmonth": F.date_format("min_purchase_date", "yyyyMM"),
        "qt_total_dias_considerado": F.datediff(r, considered).cast("bigint"),
        "min_purchase_date_considerada": considered,
        "qt_total_meses_considerado": F.least(F.year(r) * 12 + F.month(r) - F.expr(D.month_number_sql("min_purchase_date")),
                                              F.lit(D.ACTIVATION_MONTHS)).cast("bigint"),
        "qt_meses_venda_considerado": F.least(c("n_months"), F.lit(D.ACTIVATION_MONTHS)).cast("bigint"),
        "dias_desde_ult_venda": F.datediff(r, c("max_purchase_date")).cast("bigint"),
        "dias_desde_ult_estimativa_entrega": F.datediff(r, c("max_est")).cast("bigint"),
        "dias_desde_ult_entrega_pedido": F.datediff(r, c("max_delivered_customer_date")).cast("bigint"),
    }
    return g.select("dt_ref", *[singles[n].alias(n) if n in singles else c(n) for n in FE.SINGLES],
                    *[c(n) for n in FE.layer1_columns()[len(FE.SINGLES):]])


def layer1(roles: Roles, dates: Iterable[str | _dt.date], include_last_day: bool = False) -> DataFrame:
    """All dates, one sub-plan each, ``UNION ALL``."""
    parts = [layer1_one_date(roles, d, include_last_day) for d in D.validate_ref_dates(dates)]
    return reduce(DataFrame.unionByName, parts)
