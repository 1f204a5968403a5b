"""Hand-written marketplace rows for the tests, and where the driver's small tables lie."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

from vendorpulse.sources.roles import Roles

SF001 = "/root/testdata/sf0.001"

TS = T.TimestampNTZType()
SCHEMAS = {
    "orders": T.StructType([T.StructField("order_id", T.StringType()), T.StructField("order_status", T.StringType()),
                            T.StructField("order_purchase_timestamp", TS), T.StructField("order_approved_at", TS),
                            T.StructField("order_delivered_carrier_date", TS),
                            T.StructField("order_delivered_customer_date", TS),
                            T.StructField("order_estimated_delivery_date", TS)]),
    "items": T.StructType([T.StructField("order_id", T.StringType()), T.StructField("order_item_id", T.IntegerType()),
                           T.StructField("product_id", T.StringType()), T.StructField("seller_id", T.StringType()),
                           T.StructField("price", T.DecimalType(12, 2)),
                           T.StructField("freight_value", T.DecimalType(12, 2))]),
    "payments": T.StructType([T.StructField("order_id", T.StringType()),
                              T.StructField("payment_sequential", T.IntegerType()),
                              T.StructField("payment_type", T.StringType()),
                              T.StructField("payment_installments", T.IntegerType()),
                              T.StructField("payment_value", T.DecimalType(12, 2))]),
    "reviews": T.StructType([T.StructField("review_id", T.StringType()), T.StructField("order_id", T.StringType()),
                             T.StructField("review_score", T.IntegerType()),
                             T.StructField("review_creation_date", TS), T.StructField("review_answer_timestamp", TS)]),
    "products": T.StructType([T.StructField("product_id", T.StringType()),
                              T.StructField("product_category_name", T.StringType()),
                              T.StructField("product_photos_qty", T.IntegerType()),
                              T.StructField("product_description_lenght", T.IntegerType())]),
    "sellers": T.StructType([T.StructField("seller_id", T.StringType()),
                             T.StructField("seller_zip_code_prefix", T.StringType()),
                             T.StructField("seller_city", T.StringType()), T.StructField("seller_state", T.StringType())]),
}


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@dataclass
class Shop:
    """Hand-written marketplace rows for one test."""
    orders: list = field(default_factory=list)
    items: list = field(default_factory=list)
    payments: list = field(default_factory=list)
    reviews: list = field(default_factory=list)
    products: dict = field(default_factory=dict)
    sellers: set = field(default_factory=set)
    _n: int = 0

    def sale(self, seller: str | list[str], when: str, status: str = "delivered", delivered: str | None = None,
             estimated: str | None = None, price: str = "10.00", products: list[str] | None = None,
             pay: list[tuple[str, int, str]] | None = (("credit_card", 1, "10.00"),), order_id: str | None = None):
        self._n += 1
        oid = order_id or f"o{self._n}"
        t = ts(when)
        est = ts(estimated) if estimated else t + dt.timedelta(days=20)
        dlv = ts(delivered) if delivered else (t + dt.timedelta(days=5) if status == "delivered" else None)
        self.orders.append((oid, status, t, t + dt.timedelta(days=1), t + dt.timedelta(days=2), dlv, est))
        sellers = [seller] if isinstance(seller, str) else seller
        prods = products or ["p1"]
        i = 0
        for s in sellers:
            self.sellers.add(s)
            for p in prods:
                i += 1
                self.items.append((oid, i, p, s, Decimal(price), Decimal("1.00")))
                self.products.setdefault(p, (p, "cat", 1, 100))
        for k, (ptype, inst, value) in enumerate(pay or []):
            self.payments.append((oid, k + 1, ptype, inst, Decimal(value)))
        return oid

    def review(self, order_id: str, score: int, created: str, answered: str | None = None, rid: str | None = None):
        self.reviews.append((rid or f"r{len(self.reviews) + 1}", order_id, score, ts(created),
                             ts(answered) if answered else ts(created) + dt.timedelta(days=1)))

    def roles(self, spark) -> Roles:
        def df(name, rows):
            return spark.createDataFrame(rows, SCHEMAS[name])
        sellers = [(s, "00000", "city", "ST") for s in sorted(self.sellers)]
        return Roles(orders=df("orders", self.orders), items=df("items", self.items),
                     payments=df("payments", self.payments), reviews=df("reviews", self.reviews),
                     products=df("products", list(self.products.values())), sellers=df("sellers", sellers))
