"""Declared schemas of the six input roles and of the outputs.

Keys are left to the caller's type (strings in the original marketplace
export, BIGINT in the driver mapping); the engine never depends on the key
type.  Every other column has a type: text is cast to it, a column that
already has an accepted type stays as it is.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = None
DAY = T.TimestampNTZType()    # dates and timestamps are accepted as they are
MONEY = T.DecimalType(18, 4)  # any decimal of at most 4 places
INT, TEXT = T.IntegerType(), T.StringType()

# Role columns used by the feature definitions.
ROLE_COLUMNS: dict[str, dict[str, T.DataType | None]] = {
    "orders": {
        "order_id": KEY,
        "order_status": TEXT,
        "order_purchase_timestamp": DAY,
        "order_approved_at": DAY,
        "order_delivered_carrier_date": DAY,
        "order_delivered_customer_date": DAY,
        "order_estimated_delivery_date": DAY,
    },
    "items": {
        "order_id": KEY,
        "order_item_id": INT,
        "product_id": KEY,
        "seller_id": KEY,
        "price": MONEY,
        "freight_value": MONEY,
    },
    "payments": {
        "order_id": KEY,
        "payment_sequential": INT,
        "payment_type": TEXT,
        "payment_installments": INT,
        "payment_value": MONEY,
    },
    "reviews": {
        "review_id": KEY,
        "order_id": KEY,
        "review_score": INT,
        "review_creation_date": DAY,
        "review_answer_timestamp": DAY,
    },
    "products": {
        "product_id": KEY,
        "product_category_name": TEXT,
        "product_photos_qty": INT,
        "product_description_lenght": INT,
    },
    "sellers": {
        "seller_id": KEY,
        "seller_zip_code_prefix": TEXT,
        "seller_city": TEXT,
        "seller_state": TEXT,
    },
}

ROLES = tuple(ROLE_COLUMNS)

# Declared schemas of the driver tables the role mapping reads (no footer-based inference per read).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}
