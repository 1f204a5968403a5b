"""The feature table for any list of monthly reference dates, as one Spark plan.

Date-independent work (payment, review and product pre-aggregates, the
item-table shuffle) happens once for all dates; only the explode after the
last shuffle and the seller-grain aggregate see ``dt_ref``.  The features
and the next-month label come out of one aggregation pass, so the
windowed item lines are read and shuffled once; the product profile (all
history by definition) is the only other read of the item table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import asof, derived, features, preagg, segments
from ..session import bloom_filters
from ..sources.roles import Roles
from .versions import Versions


@dataclass(frozen=True)
class FeaturePlan:
    """Shared pieces of one multi-date build."""
    roles: Roles
    dates: tuple[_dt.date, ...]
    include_last_day: bool = False
    cut: bool = False  # payments and reviews of the orders in scope alone (see reduced)

    @classmethod
    def of(cls, roles: Roles, dates: Iterable[str | _dt.date], include_last_day: bool = False) -> "FeaturePlan":
        return cls(roles, tuple(D.validate_ref_dates(dates)), include_last_day)

    def month_groups(self, with_label: bool = True) -> DataFrame:
        """Date-independent month-grain partials of every (order, seller) row in scope."""
        r = self.roles
        rows = asof.seller_kind_rows(r.orders, r.items, r.payments, r.reviews, self.dates,
                                     self.include_last_day, with_label, self.cut, r.order_parts())
        return features.month_groups(rows)

    def layer1(self) -> DataFrame:
        """``dt_ref`` + the 195 layer-1 columns."""
        return features.layer1(self.month_groups(with_label=False), self.dates, self.include_last_day)

    def label(self) -> DataFrame:
        """A5 on its own (the feature table computes it inside its aggregate)."""
        return preagg.sale_label(self.roles.items, self.roles.orders, self.dates, self.include_last_day)

    def scope(self) -> DataFrame:
        """Orders that any window of the dates, or the month of a label, can touch."""
        return asof.order_scope(self.roles.orders, self.dates, self.include_last_day, with_label_months=True)

    def reduced(self, share: float = 0.25) -> "FeaturePlan":
        """The same plan with payments and reviews of the scoped orders alone.

        They carry no date, so a build of a few months otherwise shuffles what
        it aggregates of all their history.  Worth it if the scope is small:
        where it is measured to hold more than ``share`` of all orders the plan
        stays as it is.  The rows are the same either way.
        """
        return replace(self, cut=True) if asof.scope_share(self.roles.orders, self.scope()) <= share else self

    def seller_products(self) -> DataFrame:
        return preagg.products_per_seller(self.roles.items, self.roles.products)

    def layer2(self) -> DataFrame:
        """``dt_ref`` + the 201 feature-table columns."""
        month_agg = features.seller_month_aggregate(self.month_groups(with_label=True), self.dates,
                                                    self.include_last_day, with_label=True)
        return derived.layer2(month_agg, self.roles.sellers, self.seller_products())


@dataclass(frozen=True)
class DayPlan(FeaturePlan):
    """The same for reference dates of any day (:mod:`..operators.segments`)."""

    @classmethod
    def of(cls, roles: Roles, dates: Iterable[str | _dt.date], include_last_day: bool = False) -> "DayPlan":
        return cls(roles, tuple(D.ref_dates(dates)), include_last_day)

    def line(self, with_label: bool = True) -> segments.Timeline:
        return segments.Timeline.of(self.dates, self.include_last_day, with_label)

    def scope(self) -> DataFrame:
        return segments.scope(self.roles.orders, self.line())

    def _aggregate(self, with_label: bool) -> DataFrame:
        r, line = self.roles, self.line(with_label)
        return segments.aggregate(segments.segment_groups(r.orders, r.items, r.payments, r.reviews, line, self.cut, r.order_parts()), line)

    def layer1(self) -> DataFrame:
        return self._aggregate(with_label=False).drop("fl_venda")

    def label(self) -> DataFrame:
        return segments.sale_label(self.roles.items, self.roles.orders, self.line())

    def layer2(self) -> DataFrame:
        return derived.layer2(self._aggregate(with_label=True), self.roles.sellers, self.seller_products())


def plan_for(roles: Roles, dates: Iterable[str | _dt.date], include_last_day: bool = False) -> FeaturePlan:
    """The month-grain plan for first-of-month dates, else the one for any days."""
    days = D.ref_dates(dates)
    return (FeaturePlan if all(d.day == 1 for d in days) else DayPlan).of(roles, days, include_last_day)


def register_views(plan: FeaturePlan, prefix: str = "vw_abt") -> None:
    """Expose both layers to SQL as temp views ``<prefix>_p1`` and ``<prefix>_p2``."""
    plan.layer1().createOrReplaceTempView(f"{prefix}_p1")
    plan.layer2().createOrReplaceTempView(f"{prefix}_p2")


def build_abt(roles: Roles, dates: Iterable[str | _dt.date], include_last_day: bool = False, reduced: bool = False) -> DataFrame:
    """``dt_ref`` + the 201 feature columns, one row per (dt_ref, seller); ``reduced``: by :meth:`FeaturePlan.reduced`."""
    plan = plan_for(roles, dates, include_last_day)
    return (plan.reduced() if reduced else plan).layer2()


def build_abt_range(roles: Roles, first: str | _dt.date, last: str | _dt.date,
                    include_last_day: bool = False) -> DataFrame:
    """Every month from ``first`` to ``last`` inclusive (:func:`..functions.dates.monthly_range`), in one plan."""
    return build_abt(roles, D.monthly_range(first, last), include_last_day)


def write_abt(abt: DataFrame, path: str, fmt: str = "parquet",
              dates: Iterable[str | _dt.date] | None = None) -> None:
    """Partitioned by ``dt_ref``; rewriting a date replaces only that date's partition.

    Re-running the same dates is idempotent, and other dates already in the
    table are kept (dynamic partition overwrite).  ``dates`` are the dates
    that were built: one that has no rows any more loses its old partition.
    Rows are dealt by date before the write, so a date makes a few files of
    Spark's advisory size, not one a task.
    """
    spark = abt.sparkSession
    rebuilt = D.ref_dates(dates) if dates is not None else []
    before = {d: _files(spark, path, d) for d in rebuilt}
    (abt.hint("rebalance", "dt_ref")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt_ref")
        .format(fmt)
        .save(path))
    for d, files in before.items():
        if files and _files(spark, path, d) == files:  # a partition that was written has new files
            fs, old = _partition(spark, path, d)
            fs.delete(old, True)


def _partition(spark: SparkSession, path: str, date: _dt.date):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/dt_ref={date.isoformat()}")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, path: str, date: _dt.date) -> set[str]:
    fs, p = _partition(spark, path, date)
    return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()


def publish_abt(abt: DataFrame, path: str, dates: Iterable[str | _dt.date] | None = None, on: int | None = None) -> int:
    """S5 in one step: the months ``dates`` (None: the whole table) change together, or not at all.

    The table lies in a versioned folder (:mod:`.versions`) and is read by
    :func:`read_published`.  ``on``: the version built on; if it isn't the
    newest any more the write is refused.  Returns the new version.  The write
    asks for Bloom filters: of a reduced plan, payments and reviews of orders
    out of scope end at their scans.
    """
    store = Versions(abt.sparkSession, path)
    on = store.latest() if on is None else on
    replaced = None if dates is None else {"abt": D.ref_dates(dates)}
    with bloom_filters(abt.sparkSession):
        staged = store.stage("abt", abt, "dt_ref")
    return store.publish([staged], replaced, on)


def read_published(spark: SparkSession, path: str, dates: Iterable[str | _dt.date] | None = None,
                   version: int | None = None) -> DataFrame:
    """S2 of a published version (the newest): its files don't change any more.  Only the dates' folders are listed."""
    df = Versions(spark, path).read("abt", None if dates is None else D.ref_dates(dates), version)
    return df.select("dt_ref", *derived.layer2_columns())


def read_abt(spark: SparkSession, path: str, dates: Iterable[str | _dt.date] | None = None,
             fmt: str = "parquet") -> DataFrame:
    """The feature table; a date list becomes a partition filter (pruned at listing)."""
    df = spark.read.format(fmt).load(path)
    if dates is not None:
        df = df.where(F.col("dt_ref").isin(D.ref_dates(dates)))
    cols = ["dt_ref"] + derived.layer2_columns()
    return df.select(*cols)
