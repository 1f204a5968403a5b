"""The six input roles as one bundle, read from files or mapped from the driver tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import DRIVER_SCHEMAS, ROLE_COLUMNS


@dataclass(frozen=True)
class Roles:
    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    sellers: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def order_parts(self) -> int | None:
        """Into how many parts the joins by order are dealt: all the session's shuffle partitions, uncoalesced.

        AQE coalesces these small exchanges by their compressed size, but the
        stage behind them holds sorts and hash maps of every side at once, at
        over 20 times that.  None where AQE is to split skewed joins whatever
        it costs (``forceOptimizeSkewedJoin``): it leaves given numbers alone.
        """
        conf = self.orders.sparkSession.conf
        if conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin", "false") == "true":
            return None
        return int(conf.get("spark.sql.shuffle.partitions"))


class BucketedRoles(Roles):
    """Roles whose tables come dealt by order from their files."""

    def order_parts(self) -> None:
        return None


def _unreadable(column: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"column {column}: unreadable value "), value.cast("string")))


def _typed(column: str, have: T.DataType, want: T.DataType | None) -> Column:
    """The column in its declared type; empty text is missing, and a value that doesn't fit raises."""
    x = F.col(f"`{column}`")
    if want is None:
        return x
    if isinstance(want, T.StringType):
        return x if have == want else x.cast(want).alias(column)
    if isinstance(want, T.TimestampNTZType):
        if isinstance(have, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return x
        text = F.nullif(F.trim(x.cast("string")), F.lit(""))
        return F.coalesce(text.try_cast(want), F.when(text.isNotNull(), _unreadable(column, text).cast(want))).alias(column)
    # numbers, through a wide decimal: nothing is rounded unseen
    places = want.scale if isinstance(want, T.DecimalType) else 0
    if isinstance(have, T.DecimalType) and have.scale <= places and isinstance(want, T.DecimalType):
        return x
    if isinstance(have, (T.IntegerType, T.ShortType, T.ByteType)) and not places:
        return x.cast(want).alias(column)
    text = F.nullif(F.trim(x.cast("string")), F.lit(""))
    wide = text.try_cast(T.DecimalType(38, 12))
    fits = F.when(wide == F.round(wide, places), wide).try_cast(want)
    return F.coalesce(fits, F.when(text.isNotNull(), _unreadable(column, text).cast(want))).alias(column)


def conform(name: str, df: DataFrame) -> DataFrame:
    """Select the role's columns in declared order and cast them to their types.

    Text sources may hold empty strings for missing values, which become NULL.
    Any other value that isn't of the column's type (a date that can't be
    read, money of more than 4 decimals, a fraction for a count) raises.
    """
    spec = ROLE_COLUMNS[name]
    missing = [c for c in spec if c not in df.columns]
    if missing:
        raise ValueError(f"role {name!r} lacks columns {missing}")
    return df.select(*(_typed(c, df.schema[c].dataType, t) for c, t in spec.items()))


def read_roles(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet",
               options: dict[str, str] | None = None) -> Roles:
    """Scan the six role tables (parquet, orc, csv, json … any DataFrameReader format).

    ``options`` go to the reader; CSV files are read with a header unless they say otherwise.
    """
    options = {**({"header": "true"} if fmt == "csv" else {}), **(options or {})}
    reader = spark.read.format(fmt).options(**options)
    return Roles(**{name: conform(name, reader.load(paths[name])) for name in ROLE_COLUMNS})


def driver_roles(spark: SparkSession, sf_dir: str) -> Roles:
    """Deterministic role mapping of the TPC-H-like driver tables (FIXTURES §B).

    Every branch of the feature definitions occurs: cancelled and open orders,
    deliveries after the reference date, unpaid orders (every 50th), orders
    without reviews, NULL categories and photo counts.
    """
    t = lambda n: spark.read.schema(DRIVER_SCHEMAS[n]).parquet(f"{sf_dir}/{n}.parquet")
    o, li, p = t("orders"), t("lineitem"), t("part")
    s, n = t("supplier"), t("nation")

    odate = F.to_date("o_orderdate")
    orders = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
         .when(F.col("o_orderstatus") == "P", "canceled")
         .otherwise("shipped").alias("order_status"),
        F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate")).alias("order_purchase_timestamp"),
        F.date_add(odate, 1).alias("order_approved_at"),
        F.date_add(odate, 2).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F",
               F.date_add(odate, (3 + F.col("o_orderkey") % 45).cast("int"))).alias("order_delivered_customer_date"),
        F.date_add(odate, (20 + F.col("o_orderkey") % 7).cast("int")).alias("order_estimated_delivery_date"),
    )

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    items = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(16,4)").alias("freight_value"),
    )

    ln4 = F.col("l_linenumber") % 4
    payments = li.where(F.col("l_orderkey") % 50 != 0).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(ln4 == 0, "credit_card").when(ln4 == 1, "boleto")
         .when(ln4 == 2, "voucher").otherwise("debit_card").alias("payment_type"),
        (F.col("l_quantity").cast("int") % 12).alias("payment_installments"),
        price.alias("payment_value"),
    )

    ship = F.to_date("l_shipdate")
    reviews = li.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"),
                 F.lit("-"), F.col("l_linenumber").cast("string")).alias("review_id"),
        (1 + F.col("l_quantity").cast("int") % 5).alias("review_score"),
        ship.alias("review_creation_date"),
        F.date_add(ship, F.col("l_linenumber")).alias("review_answer_timestamp"),
    )

    products = p.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("product_category_name"),
        F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_size") % 6).alias("product_photos_qty"),
        F.length("p_name").cast("int").alias("product_description_lenght"),
    )

    sellers = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.concat(F.lit("CITY_"), F.col("s_nationkey").cast("string")).alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )
    return Roles(orders=conform("orders", orders), items=conform("items", items),
                 payments=conform("payments", payments), reviews=conform("reviews", reviews),
                 products=conform("products", products), sellers=conform("sellers", sellers))
