"""Month state: what the feature table needs of each month, kept and refreshed from new source rows alone.

The sources are logs: every row carries a stamp (an ingestion time or number).
A refresh reads the rows stamped after the last one's watermark, reduces them
to partials, and merges those with what is stored:

* ``orders``: one row per order: its attributes (the row of greatest stamp
  counts, so a later row corrects an earlier one) and the additive partials of
  its payments and reviews;
* ``lines``: one row per (order, product, seller) with additive sums;
* ``groups``: the month-grain partials of :func:`..operators.features.month_groups`;
* ``pairs``: the distinct (seller, product) pairs of all history.

``orders`` and ``lines`` are stored in buckets of the order, ``pairs`` of the
product: a refresh deals its new rows so, and the stored ones are merged and
joined where they lie.  Each new row is exchanged once by order (its order's
partials twice), each (order, seller) row of a changed month once more, by month
and seller, for its groups.  When the rows have outgrown their buckets
(``ROWS_PER_BUCKET``, twice) a refresh deals the whole state into more.

The first three are partitioned by the order's purchase month.  Only months
that a new row's order is or was in are read, merged and written again; rows
whose order is not known yet wait in a partition of their own (``WAITING``).
The old sources are not read again: a late payment of an old order meets that
order's stored partials.  All tables change in one published version
(:mod:`.versions`), so a refresh that fails, or is repeated, changes nothing.

Reference dates read the ``groups`` of their own thirteen months.  The result
is that of a full build over the same rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import asof, derived, features, preagg
from ..sources.roles import Roles
from .versions import Deal, Versions

WAITING = -1
#: rows of all logs that a bucket is to hold
ROWS_PER_BUCKET = 3_000_000
#: tasks that make groups, a bucket
RANGES = 4
_MONTH = ("orders", "lines", "groups")
_PAYMENT_SUMS = [f"{p}_{t}" for p in ("inst", "val") for t in asof.PAYMENT_KINDS]
_REVIEW_SUMS = ["n_reviews", "qt_reviews", "score_sum", "score_n", "delay_sum", "delay_n"]
_SUMS = ["n_payments", *_PAYMENT_SUMS, *_REVIEW_SUMS]
_LINE_SUMS = ["qt_itens", "value_price", "value_freight"]


def _payments(payments: DataFrame) -> DataFrame:
    per_order = preagg.payments_per_order(payments, units=True, rows="n_payments")
    names = {f"inst_{t}": f"installments_{t}" for t in asof.PAYMENT_KINDS} | {f"val_{t}": f"value_{t}" for t in asof.PAYMENT_KINDS}
    return per_order.select("order_id", "n_payments", *(F.col(b).alias(a) for a, b in names.items()))


def _reviews(reviews: DataFrame) -> DataFrame:
    delay = F.datediff(F.to_date("review_answer_timestamp"), F.to_date("review_creation_date")).cast("long")
    score = F.col("review_score").cast("long")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.count("review_id").alias("qt_reviews"), F.sum(score).alias("score_sum"),
        F.count(score).alias("score_n"), F.sum(delay).alias("delay_sum"), F.count(delay).alias("delay_n"))


class MonthState:
    def __init__(self, spark: SparkSession, path: str, stamp: str = "ingested_at"):
        self.spark, self.stamp = spark, stamp
        self.store = Versions(spark, path)

    # --- refresh
    def _since(self, df: DataFrame, info: dict) -> Column:
        """Rows after the watermark; a literal comparison, so it reaches the scan."""
        kind = df.schema[self.stamp].dataType
        mark = info.get("watermark")
        return F.lit(True) if mark is None else F.col(self.stamp) > F.lit(mark).cast(kind)

    def changes(self, roles: Roles, version: int | None = None) -> dict[str, DataFrame]:
        """The logs' rows stamped after the version's watermark (a row without a stamp is none of any refresh)."""
        info = self.store.manifest(version)["info"]
        return {name: getattr(roles, name).where(self._since(getattr(roles, name), info))
                for name in ("orders", "items", "payments", "reviews")}

    def _arrived(self, new: dict[str, DataFrame]) -> tuple[str | None, int]:
        """The greatest stamp among new rows, as text (comparable types agree across the logs), and their number."""
        found = [df.agg(F.max(self.stamp), F.count(self.stamp)).first() for df in new.values()]
        top = max((t for t, _ in found if t is not None), default=None)
        return None if top is None else str(top), sum(n for _, n in found)

    def _delta(self, new: dict[str, DataFrame], kind: str, deal: Deal) -> tuple[DataFrame, DataFrame]:
        """New rows as partials, dealt: per order, and per line."""
        orders = new["orders"].groupBy("order_id").agg(
            F.max_by(F.struct(*asof.ORDER_ATTRS), F.col(self.stamp)).alias("attributes"), F.max(self.stamp).alias("stamp"))
        nothing = [F.lit(None).cast(orders.schema["attributes"].dataType).alias("attributes"), F.lit(None).cast(kind).alias("stamp")]

        def sums(df: DataFrame) -> DataFrame:
            return df.select("order_id", *(nothing if "attributes" not in df.columns else ["attributes", "stamp"]),
                             *((F.col(c) if c in df.columns else F.lit(None)).cast("long").alias(c) for c in _SUMS))
        per_order = (sums(orders).unionByName(sums(_payments(new["payments"]))).unionByName(sums(_reviews(new["reviews"])))
                     .unionByName(sums(new["items"].select("order_id").distinct())))
        lines = preagg.items_per_order_product(self._dealt(new["items"].where("order_id IS NOT NULL"), deal), units=True)
        return self._dealt(self._merged(per_order).where("order_id IS NOT NULL"), deal), lines

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("order_id").agg(F.max_by("attributes", "stamp").alias("attributes"), F.max("stamp").alias("stamp"),
                                            *(F.sum(c).alias(c) for c in _SUMS))

    def refresh(self, roles: Roles) -> int:
        """Take in the logs' new rows; returns the version that holds them (the newest, if there are none)."""
        on = self.store.latest()
        new = self.changes(roles, on)
        mark, arrived = self._arrived(new)
        if mark is None:
            if on:
                return on
            raise ValueError("the logs hold no stamped row")
        # what arrives while this runs belongs to the next refresh
        new = {n: df.where(F.col(self.stamp) <= F.lit(mark).cast(df.schema[self.stamp].dataType)) for n, df in new.items()}
        month = F.coalesce(F.expr(D.month_number_sql("attributes.order_purchase_timestamp")), F.lit(WAITING))

        total = arrived + (self._rows(on) if on else 0)
        deal = self._deal(total, on)
        by_product = Deal("product_id", deal.buckets)
        per_order, lines = self._delta(new, roles.orders.schema[self.stamp].dataType.simpleString(), deal)
        scope = self._scope(new, on, deal)
        if on:
            known = {t: self.store.read(t, scope, on) for t in ("orders", "lines")}
            if self.store.deal("orders", on) != deal:
                known = {t: self._dealt(df, deal) for t, df in known.items()}
            # the union of sides that are dealt alike is dealt so (Spark sees it with the scan as the second side)
            per_order = self._merged(per_order.unionByName(known["orders"].select(*per_order.columns)))
            lines = (lines.unionByName(known["lines"].select(*lines.columns))
                     .groupBy("order_id", "seller_id", "product_id").agg(*(F.sum(c).alias(c) for c in _LINE_SUMS)))
        orders = self.store.stage("orders", per_order.withColumn("pm", month), "pm", deal)
        orders_now = self.store.staged(orders)
        lines = self.store.stage("lines", lines.join(orders_now.select("order_id", "pm"), "order_id"), "pm", deal)
        # a task holds a stretch of (month, seller): it makes whole groups and few files
        rows = self._joined(orders_now, self.store.staged(lines)).repartitionByRange(RANGES * deal.buckets, "pm", "seller_id")
        groups = features.month_groups(asof.kind_rows(self._means(rows), pm="pm"))
        groups = self.store.stage("groups", groups, "pm", placed=True)
        pairs = self._dealt(new["items"].where("order_id IS NOT NULL").select("seller_id", "product_id"), by_product).distinct()
        pairs, since = pairs.withColumn("since", F.lit(on + 1)), [on + 1]
        if on:
            stored = self.store.read("pairs", version=on).select(*pairs.columns)
            if self.store.deal("pairs", on) != by_product:
                stored, since = self._dealt(stored, by_product), None  # the whole table
            pairs = (pairs.unionByName(stored).groupBy("seller_id", "product_id").agg(F.min("since").alias("since"))
                     .where(F.lit(since is None) | (F.col("since") > on)))
        pairs = self.store.stage("pairs", pairs, "since", by_product)
        return self.store.publish([orders, lines, groups, pairs], {**dict.fromkeys(_MONTH, scope), "pairs": since}, on,
                                  {"watermark": mark, "rows": total})

    def _rows(self, on: int) -> int:
        """The log rows that a version was made of (of one that doesn't say: its own)."""
        known = self.store.manifest(on)["info"].get("rows")
        return sum(self.store.read(t, version=on).count() for t in ("orders", "lines")) if known is None else known

    def _deal(self, total: int, on: int) -> Deal:
        """The stored deal, until its buckets hold twice the rows they are to; then one of as many as ``total`` needs."""
        stored = self.store.deal("orders", on) if on else None
        if stored and stored == self.store.deal("lines", on) and total <= 2 * ROWS_PER_BUCKET * stored.buckets:
            return stored
        return Deal("order_id", -(-total // ROWS_PER_BUCKET))

    @staticmethod
    def _dealt(df: DataFrame, deal: Deal) -> DataFrame:
        return df.repartition(deal.buckets, deal.key)

    def _scope(self, new: dict[str, DataFrame], on: int, deal: Deal) -> list[int]:
        """The months that a new row's order is, or was, in; all that are stored, if they are to be dealt anew."""
        month = F.expr(D.month_number_sql("order_purchase_timestamp"))
        months = {r.pm for r in new["orders"].where("order_id IS NOT NULL").select(month.alias("pm")).distinct().collect()} - {None}
        if on and self.store.deal("orders", on) != deal:
            months |= {int(k) for t in _MONTH for k in self.store.manifest(on)["tables"][t]["folders"]}
        elif on:  # two narrow columns of the stored orders
            ids = [df.select("order_id") for df in new.values()]
            named = ids[0].unionByName(ids[1]).unionByName(ids[2]).unionByName(ids[3]).distinct()
            held = self.store.read("orders", version=on).select("order_id", "pm").join(named, "order_id", "left_semi")
            months |= {r.pm for r in held.select("pm").distinct().collect()}
        return sorted(months | {WAITING})

    @staticmethod
    def _joined(orders: DataFrame, lines: DataFrame) -> DataFrame:
        """(order, seller) rows with their month and the orders' sums; :meth:`_means` makes the columns of the groups of them."""
        days = [F.to_date(f"attributes.{a}").alias(a) for a in asof.ORDER_ATTRS[1:]]  # all that the groups read of the times
        known = orders.where("attributes IS NOT NULL").select(
            "order_id", "pm", "attributes.order_status", *days, F.when(F.col("n_payments") > 0, F.lit(True)).alias("paid"),
            *_PAYMENT_SUMS, *_REVIEW_SUMS)
        per_seller = lines.groupBy("order_id", "seller_id").agg(
            F.count(F.lit(1)).alias("n_lines"), F.count("product_id").alias("n_products"),
            F.sum("value_price").alias("value_price"), F.sum("value_freight").alias("value_freight"))
        return per_seller.join(known, "order_id").drop("order_id")

    @staticmethod
    def _means(joined: DataFrame) -> DataFrame:
        """The columns that :func:`..operators.asof.joined_orders` gives."""
        mean = lambda a, n: F.try_divide(F.col(a).cast("double"), F.col(n).cast("double"))
        return joined.withColumns({
            "qt_reviews": F.when(F.col("n_reviews") > 0, F.col("qt_reviews")),
            "avg_score": mean("score_sum", "score_n"), "avg_days_create_answer": mean("delay_sum", "delay_n")})

    # --- use
    def month_groups(self, dates: Iterable[str | _dt.date], version: int | None = None) -> DataFrame:
        """The stored groups of the months that the dates can see."""
        own = D.validate_ref_dates(dates)
        first, last = D.month_number(own[0]) - D.OBSERVATION_MONTHS, D.month_number(own[-1])
        return self.store.read("groups", range(first, last + 1), version)

    def layer2(self, dates: Iterable[str | _dt.date], products: DataFrame, sellers: DataFrame,
               version: int | None = None) -> DataFrame:
        """``dt_ref`` + the 201 columns for first-of-month dates, from the state."""
        version = self.store.latest() if version is None else version
        own = D.validate_ref_dates(dates)
        months = features.seller_month_aggregate(self.month_groups(own, version), own)
        return derived.layer2(months, sellers, preagg.products_per_seller(self.store.read("pairs", version=version), products))
