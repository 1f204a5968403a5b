"""As-of order view and the month-keyed (order, seller) rows behind every feature.

Plan shape (one plan for any number of reference dates, one pass over items):

1. ``scope``: orders whose purchase falls in the union of every window the
   caller needs (12-month observation windows and, for the label, the month
   that starts at each date).  The bounds are literals, so they reach the
   Parquet scan as pushed filters.
2. ``order_seller_lines``: item lines joined to ``scope`` (on a cluster: one
   shuffle of the item table on ``order_id``), collapsed to (order, product,
   seller) — the pre-aggregate A2 — and then to (order, seller).  Both
   aggregates run on the join's ``order_id`` partitioning, so they add no
   exchange; the order attributes ride along as grouping keys.
3. ``joined_orders``: payments and reviews are pre-aggregated per order
   (map-side first) and left-joined on ``order_id`` (same partitioning again);
   the left join drops the orders out of scope.  Payments are a left join with a ``paid`` marker
   rather than an inner join: the features need a payment, the next-month
   label does not.
4. ``kind_rows``: each joined row is tagged with date-independent month
   keys (see :func:`kind_rows`).  :mod:`.features` aggregates them to a month
   grain *before* any reference date is attached, so the per-row work does
   not grow with the number of dates.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from .preagg import items_per_order_product, payments_per_order, reviews_per_order

ORDER_ATTRS = ("order_status", "order_purchase_timestamp", "order_delivered_customer_date",
               "order_estimated_delivery_date")
PAYMENT_KINDS = ("credit_card", "debit_card", "boleto", "voucher")


def orders_in_range(orders: DataFrame, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """Orders with ``lo <= purchase < hi`` (literal bounds: pushed down to the scan)."""
    ts = F.col("order_purchase_timestamp")
    return orders.where((ts >= F.lit(lo)) & (ts < F.lit(hi)))


def order_scope(orders: DataFrame, dates: Sequence[_dt.date], include_last_day: bool = False,
                with_label_months: bool = False) -> DataFrame:
    """Orders that any requested window can touch."""
    lo, hi = D.union_observation_bounds(dates, include_last_day)
    if with_label_months:
        hi = max(hi, D.union_label_bounds(dates, include_last_day)[1])
    return orders_in_range(orders, lo, hi)


def within_scope(side: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of an aggregate per order whose order is in ``scope``.

    A semi join on the aggregate's own partitioning, for which Spark puts a
    Bloom filter of the scoped ids at the scan below the aggregate if the
    session lets it (``session.BLOOM``): then rows of other orders end there
    instead of in the shuffle.
    """
    return side.join(scope.select("order_id"), "order_id", "left_semi")


def scope_share(orders: DataFrame, scope: DataFrame) -> float:
    """The orders in scope as a share of all: two counts, one of them from file footers."""
    return scope.count() / max(1, orders.count())


def order_seller_lines(items: DataFrame, scope: DataFrame, parts: int | None = None) -> DataFrame:
    """(order, seller) grain of the item table for the orders in ``scope``.

    ``n_lines`` counts (order, product, seller) lines, ``n_products`` those with
    a product id; prices and freight are summed in integer money units.  Order
    attributes ride along as grouping keys (``order_id`` is the key of the
    order table), so both aggregates stay hash-based.  ``parts``: tasks of the
    joins by order (:meth:`..sources.roles.Roles.order_parts`); the other sides
    are dealt as the orders are.
    """
    held = scope.select("order_id", *ORDER_ATTRS)
    lines = items.join(held if parts is None else held.repartition(parts, "order_id"), "order_id")
    a2 = items_per_order_product(lines, carry=ORDER_ATTRS, units=True)
    return a2.groupBy("order_id", "seller_id", *ORDER_ATTRS).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count("product_id").alias("n_products"),
        F.sum("value_price").alias("value_price"),
        F.sum("value_freight").alias("value_freight"),
    )


def joined_orders(lines: DataFrame, payments: DataFrame, reviews: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Left-join the per-order payment and review pre-aggregates (of the orders in ``scope``, if given) to the lines."""
    pay = payments_per_order(payments, units=True).select(
        "order_id", F.lit(True).alias("paid"),
        *[F.col(f"installments_{t}").alias(f"inst_{t}") for t in PAYMENT_KINDS],
        *[F.col(f"value_{t}").alias(f"val_{t}") for t in PAYMENT_KINDS],
    )
    rev = reviews_per_order(reviews).select("order_id", "qt_reviews", "avg_score", "avg_days_create_answer")
    if scope is not None:
        pay, rev = within_scope(pay, scope), within_scope(rev, scope)
    return lines.join(pay, "order_id", "left").join(rev, "order_id", "left")


# Row kinds (``k``), as small integers: cheap to hash and compare.
KIND_MAIN, KIND_CC, KIND_VOUCHER, KIND_LABEL = 0, 1, 2, 3


def kind_rows(joined: DataFrame, include_last_day: bool = False, with_label: bool = True, pm: str | None = None) -> DataFrame:
    """Joined (order, seller) rows with their date-independent month keys.

    Every row yields a ``main`` row; paid rows with credit-card or voucher
    installments also yield one row per such value (the inputs of the
    distinct-installment means).  Keys: purchase month ``pm`` (year*12+month),
    ``ld`` (purchase on the last day of its month — outside every window that
    ends with that month), ``paid``, and the delivery month ``dm``.  Because
    reference dates are first-of-month, these keys decide window membership,
    recency bucket and the as-of delivery mask for every reference date.
    ``pm``: a column of the rows that holds the purchase month already (rows
    dealt by it stay so).
    """
    return tagged_rows(joined, [
        f"{D.month_number_sql(PDATE)} AS pm" if pm is None else pm,
        ("false" if include_last_day else f"{PDATE} = last_day({PDATE})") + " AS ld",
        f"CASE WHEN k = {KIND_MAIN} THEN {D.month_number_sql(DLV)} END AS dm"], with_label)


PDATE, DLV = "to_date(order_purchase_timestamp)", "to_date(order_delivered_customer_date)"


def tagged_rows(joined: DataFrame, keys: Sequence[str], with_label: bool = True) -> DataFrame:
    """Joined rows by kind, with the values that the partials are taken of; ``keys``: the time keys, as SQL."""
    src = joined if with_label else joined.where("paid IS NOT NULL")
    kinds = (f"array({KIND_MAIN}, "
             f"CASE WHEN paid IS NOT NULL AND inst_credit_card <> 0 THEN {KIND_CC} END, "
             f"CASE WHEN paid IS NOT NULL AND inst_voucher <> 0 THEN {KIND_VOUCHER} END)")
    x = src.select("*", F.explode(F.expr(kinds)).alias("k")).where("k IS NOT NULL")
    return x.selectExpr(
        "seller_id", "k",
        f"CAST(CASE WHEN k = {KIND_CC} THEN inst_credit_card WHEN k = {KIND_VOUCHER} THEN inst_voucher END"
        " AS BIGINT) AS v",
        *keys,
        "paid IS NOT NULL AS paid",
        f"{PDATE} AS pdate", f"{DLV} AS dlv", "to_date(order_estimated_delivery_date) AS est",
        "order_status", "n_lines", "n_products", "value_price", "value_freight",
        *[f"inst_{t}" for t in PAYMENT_KINDS], *[f"val_{t}" for t in PAYMENT_KINDS],
        "qt_reviews", "avg_score", "avg_days_create_answer",
    )


def seller_kind_rows(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
                     dates: Sequence[_dt.date], include_last_day: bool = False, with_label: bool = True,
                     cut: bool = False, parts: int | None = None) -> DataFrame:
    scope = order_scope(orders, dates, include_last_day, with_label_months=with_label)
    joined = joined_orders(order_seller_lines(items, scope, parts), payments, reviews, scope if cut else None)
    return kind_rows(joined, include_last_day, with_label)


# ---------------------------------------------------------------- as-of order view

def asof_columns(ref: Column, ts: Column) -> list[Column]:
    """Date parts of the reference and of the purchase, and the as-of masks."""
    return [
        F.date_format(ref, "yyyyMM").alias("refdate_yearmonth"),
        F.year(ref).cast("bigint").alias("refdate_year"),
        F.month(ref).cast("bigint").alias("refdate_month"),
        F.to_date(ts).alias("order_purchase_date"),
        F.date_format(ts, "yyyyMM").alias("order_purchase_yearmonth"),
        D.mask_after(F.col("order_approved_at"), ref).alias("order_approved_date"),
        D.mask_after(F.col("order_delivered_carrier_date"), ref).alias("order_delivered_carrier_day"),
        D.mask_after(F.col("order_delivered_customer_date"), ref).alias("order_delivered_customer_day"),
        F.to_date("order_estimated_delivery_date").alias("order_estimated_delivery_day"),
    ]


def orders_asof(orders: DataFrame, dates: Sequence[_dt.date], include_last_day: bool = False) -> DataFrame:
    """The order view of each reference date: 12-month filter, future events masked."""
    scope = order_scope(orders, dates, include_last_day)
    ts = F.col("order_purchase_timestamp")
    pm = D.month_number_sql("order_purchase_timestamp")
    ld = "to_date(order_purchase_timestamp) = last_day(order_purchase_timestamp)"
    months = D.observed_months_sql(dates, pm, ld, include_last_day)
    x = (scope.select("*", F.explode(F.expr(f"array({', '.join(months)})")).alias("_r")).where("_r IS NOT NULL")
         .withColumn("dt_ref", F.expr(D.month_start_sql("_r"))))
    return x.select("dt_ref", "order_id", "order_status", "order_purchase_timestamp",
                    *asof_columns(F.col("dt_ref"), ts))
