"""Reference dates of any day: the time line cut into segments that no window divides.

The month grain of :mod:`.features` rests on first-of-month dates.  For other
days all bounds of all asked windows (the trailing windows of 1 to 6 and 12
months, with overflowing month shifts, and the label's month) cut the time line
into segments: the days of a segment lie in the same windows of every date.  So
a (seller, segment) group plays the part of a (seller, month) group: it is
aggregated once whatever the number of dates, and then attached to the dates
that see it, with its bucket.  Dates a month apart cut two to four segments a
month, about as many groups as at the month grain.

The segment of a day is one look-up in a literal array over the days of the
asked range; segments meet their dates in a join with a small table made from
the dates alone (at most dates x segments rows).  Deliveries are masked by the
number of asked dates up to the delivery.  Sale days and months are bitmaps by
day and month number modulo 64: a bucket of 1 to 6 spans 34 days at most, a
year's window 13 months.
"""

from __future__ import annotations

import datetime as _dt
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from . import asof, features
from .asof import DLV, KIND_LABEL, KIND_MAIN, PDATE

KEYS = ("seller_id", "seg", "paid", "k", "v", "ds")
_ATTACHED = "seg int, r int, dt_ref date, b int, label boolean"


@dataclass(frozen=True)
class Timeline:
    """The asked dates with the bounds of their windows, and the segments between all bounds."""

    dates: tuple[_dt.date, ...]
    include_last_day: bool = False
    with_label: bool = True

    @classmethod
    def of(cls, dates, include_last_day: bool = False, with_label: bool = True) -> "Timeline":
        return cls(tuple(D.ref_dates(dates)), include_last_day, with_label)

    def _end(self, d: _dt.date) -> _dt.date:
        return d if self.include_last_day else d - _dt.timedelta(days=1)

    def observed(self, ref: _dt.date) -> list[tuple[_dt.date, int]]:
        """Where the buckets of a date begin, newest first; the last (outside the trailing windows) a year back."""
        return [*((D.shift_months_py(ref, -n), n) for n in D.TRAILING_WINDOWS),
                (D.shift_months_py(ref, -D.OBSERVATION_MONTHS), D.OUTSIDE_TRAILING)]

    def intervals(self) -> list[tuple[_dt.date, _dt.date, int, int | None, bool]]:
        """(first day, end, number of the date, bucket, is label), by bucket."""
        out = []
        for r, ref in enumerate(self.dates):
            end = self._end(ref)
            for low, n in self.observed(ref):
                if low < end:
                    out.append((low, end, r, n, False))
                    end = low
            if self.with_label:
                out.append((ref, self._end(D.shift_months_py(ref, 1)), r, None, True))
        return [x for x in out if x[0] < x[1]]

    def bounds(self) -> list[_dt.date]:
        return sorted({d for x in self.intervals() for d in x[:2]})

    def attached(self) -> list[tuple[int, int, _dt.date, int | None, bool]]:
        """(segment, number of the date, the date, bucket, is label)."""
        at = self.bounds()
        return [(i, r, self.dates[r], n, label) for low, end, r, n, label in self.intervals()
                for i in range(bisect_left(at, low), bisect_left(at, end))]

    def segment_sql(self, day: str) -> str:
        """The segment of a date column, null for days that no window holds."""
        at, held = self.bounds(), {x[0] for x in self.attached()}
        ids = []
        for i, (a, b) in enumerate(zip(at, at[1:])):
            ids += [str(i) if i in held else "NULL"] * (b - a).days
        first = f"DATE '{at[0].isoformat()}'"
        return (f"CASE WHEN {day} >= {first} AND {day} < DATE '{at[-1].isoformat()}' "
                f"THEN element_at(array({', '.join(ids)}), datediff({day}, {first}) + 1) END")

    def seen_sql(self, day: str) -> str:
        """How many asked dates are not after a date column."""
        return " + ".join(f"CAST({day} >= DATE '{d.isoformat()}' AS INT)" for d in self.dates)


def scope(orders: DataFrame, line: Timeline) -> DataFrame:
    """Orders that some window holds, with their segment; the outer bounds are literals and reach the scan."""
    at = line.bounds()
    return (asof.orders_in_range(orders, at[0], at[-1]).withColumn("seg", F.expr(line.segment_sql(PDATE)))
            .where("seg IS NOT NULL"))


def segment_groups(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
                   line: Timeline, cut: bool = False, parts: int | None = None) -> DataFrame:
    """The partials of :func:`.features.partials` by (seller, segment, paid, kind, value, dates seen before delivery)."""
    held = scope(orders, line).drop("seg")
    joined = asof.joined_orders(asof.order_seller_lines(items, held, parts), payments, reviews, held if cut else None)
    rows = asof.tagged_rows(joined, [
        f"{line.segment_sql(PDATE)} AS seg",
        f"CASE WHEN k = {KIND_MAIN} AND {DLV} IS NOT NULL THEN {line.seen_sql(DLV)} END AS ds"], line.with_label)
    main = f"k = {KIND_MAIN}"
    day, month = "datediff(pdate, DATE '1970-01-01')", D.month_number_sql("pdate")
    return rows.groupBy(*KEYS).agg(*features.exprs(
        *features.partials(),
        f"bit_or(CASE WHEN {main} THEN shiftleft(1L, pmod({day}, 64)) END) AS day_bits",
        f"bit_or(CASE WHEN {main} THEN shiftleft(1L, pmod({month}, 64)) END) AS months"))


def attach(rows: DataFrame, line: Timeline) -> DataFrame:
    """Rows with a column ``seg``, once for each date and window part that holds them: r, dt_ref, b, label."""
    table = rows.sparkSession.createDataFrame(line.attached(), _ATTACHED)  # follows the dates, not the data
    return rows.join(F.broadcast(table), "seg")


def aggregate(groups: DataFrame, line: Timeline) -> DataFrame:
    """A6 (and the label flag), one row per (dt_ref, seller)."""
    x = attach(features.by_seller(groups), line).where(f"(label AND k = {KIND_MAIN}) OR (NOT label AND paid)").selectExpr(
        "*", f"CASE WHEN label THEN {KIND_LABEL} ELSE k END AS k2", "ds <= r AS kept")
    return features.fold_windows(x, month_bits="months")


def orders_asof(orders: DataFrame, line: Timeline) -> DataFrame:
    """The order view of each date: 12-month filter, future events masked."""
    x = attach(scope(orders, line), line).where("NOT label")
    return x.select("dt_ref", "order_id", "order_status", "order_purchase_timestamp",
                    *asof.asof_columns(F.col("dt_ref"), F.col("order_purchase_timestamp")))


def sale_label(items: DataFrame, orders: DataFrame, line: Timeline) -> DataFrame:
    """Sellers with a sale in the month that starts at each date."""
    sold = attach(scope(orders, line), line).where("label").select("order_id", "dt_ref")
    return (items.select("order_id", "seller_id").join(sold, "order_id").select("dt_ref", "seller_id").distinct()
            .withColumn("fl_venda", F.lit(1)))

