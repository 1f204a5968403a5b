"""Pre-aggregates that set the join grain of the feature table (A1-A5).

Each is one hash aggregate on its key; Spark runs it as a partial aggregate
before the shuffle and a final one after it, so hot keys collapse map-side.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.arith import from_units, money, safe_div, to_units

# Payment types with their own installment/value columns.
PAYMENT_TYPES = ("credit_card", "debit_card", "boleto", "voucher")


def payments_per_order(payments: DataFrame, units: bool = False, rows: str | None = None) -> DataFrame:
    """A1: one row per order with per-type installment and value totals.

    ``qt_payment_types`` is the only distinct aggregate; Catalyst drops it
    (and its extra shuffle) from plans that do not select it.  With
    ``units`` the values stay integer money units (see ``arith.to_units``).
    ``rows`` names a further column, the number of an order's rows.
    """
    cols = [] if rows is None else [F.count(F.lit(1)).alias(rows)]
    cols += [
        F.count("payment_sequential").alias("qt_payments"),
        F.count_distinct("payment_type").alias("qt_payment_types"),
    ]
    value = to_units(F.col("payment_value"))
    for t in PAYMENT_TYPES:
        hit = F.col("payment_type") == t
        cols.append(F.sum(F.when(hit, F.col("payment_installments")).otherwise(0)).alias(f"installments_{t}"))
        total = F.sum(F.when(hit, value).otherwise(0))
        cols.append((total if units else from_units(total)).alias(f"value_{t}"))
    return payments.groupBy("order_id").agg(*cols)


def items_per_order_product(items: DataFrame, carry: Sequence[str] = (), units: bool = False) -> DataFrame:
    """A2: item lines collapsed per (order, product, seller).

    ``carry`` names order-level columns (constant per order) that ride along
    as extra grouping keys — the groups are unchanged, and no string has to
    sit in an aggregation buffer (which would force a sort-based aggregate);
    with ``units`` the sums stay integer money units.
    """
    conv = (lambda x: x) if units else from_units
    return items.groupBy("seller_id", "order_id", "product_id", *carry).agg(
        F.count("order_item_id").alias("qt_itens"),
        conv(F.sum(to_units(F.col("price")))).alias("value_price"),
        conv(F.sum(to_units(F.col("freight_value")))).alias("value_freight"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """A3: review count, mean score, latest score and mean answer delay per order.

    ``last_score`` is the score of the most recently created review of the
    order (ties broken by review id, then score) — the intended meaning of
    the original, whose unpartitioned window gave every order one constant.
    """
    latest = F.struct("review_creation_date", "review_id", "review_score")
    return reviews.groupBy("order_id").agg(
        F.count("review_id").alias("qt_reviews"),
        F.avg("review_score").alias("avg_score"),
        F.max_by("review_score", latest).alias("last_score"),
        F.avg(F.datediff(F.to_date("review_answer_timestamp"), F.to_date("review_creation_date")))
         .alias("avg_days_create_answer"),
    )


def products_per_seller(items: DataFrame, products: DataFrame) -> DataFrame:
    """A4: catalogue profile of every seller over all history.

    The definition's distinct (seller, product row) set is the join of the
    distinct item pairs with the distinct product rows; both sides are
    de-duplicated map-side first.  A partial aggregate follows the join, so it
    needs no partitioning of it and AQE may split a hot product.  The distinct
    category count is taken by grouping on the category first, so no
    ``count(distinct)`` (and no ``Expand``) is planned.
    """
    sold = items.select("seller_id", "product_id").distinct().join(products.distinct(), "product_id")
    per_cat = sold.groupBy("seller_id", F.coalesce("product_category_name", F.lit("")).alias("cat")).agg(
        F.count("product_id").alias("n"),
        F.sum("product_photos_qty").alias("photos"),
        F.sum("product_description_lenght").alias("desc_len"),
        F.count(F.lit(1)).alias("rows"),
    )
    per_seller = per_cat.groupBy("seller_id").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_cat"),
        F.sum("photos").alias("photos"),
        F.sum("desc_len").alias("desc_len"),
        F.sum("rows").alias("rows"),
    )
    return per_seller.select(
        "seller_id",
        safe_div(F.col("n"), F.col("n_cat")).alias("quantidade_de_produtos_por_categoria"),
        safe_div(F.col("photos"), F.col("n")).alias("media_num_fotos_por_produto"),
        safe_div(F.col("photos"), F.col("rows")).alias("media_fotos_por_produto_categoria"),
        safe_div(F.col("desc_len"), F.col("n")).alias("media_tamanho_descriçao_por_produto"),
        F.col("n").alias("qtd_produtos_vendendo"),
        F.col("n_cat").alias("qtd_categorias_vendendo"),
    )


def orders_in_label_months(orders: DataFrame, dates: Sequence[_dt.date],
                           include_last_day: bool = False) -> DataFrame:
    """(order_id, dt_ref) for purchases inside the month that starts at each date (F2).

    The union of the months is a literal range, pushed to the scan.  An order
    has one month, so its date is that month's first day, if it is asked for.
    """
    lo, hi = D.union_label_bounds(dates, include_last_day)
    ts = F.col("order_purchase_timestamp")
    pre = orders.where((ts >= F.lit(lo)) & (ts < F.lit(hi)))
    if not include_last_day:
        pre = pre.where(F.to_date(ts) != F.last_day(ts))
    return pre.select("order_id", F.trunc(ts, "MM").alias("dt_ref")).where(F.col("dt_ref").isin(list(dates)))


def sale_label(items: DataFrame, orders: DataFrame, dates: Sequence[_dt.date],
               include_last_day: bool = False) -> DataFrame:
    """A5/J5 on its own: sellers with a sale in the month starting at ``dt_ref`` → ``fl_venda = 1``.

    The inner join followed by a distinct equals the ``IN (subquery)`` semi
    join.  (The feature table computes the same flag inside its single
    aggregation pass instead.)
    """
    months = orders_in_label_months(orders, dates, include_last_day)
    return (items.select("order_id", "seller_id").join(months, "order_id")
            .select("dt_ref", "seller_id").distinct()
            .withColumn("fl_venda", F.lit(1)))
