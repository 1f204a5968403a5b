"""Role tables stored in buckets of orders, so that the large joins need no exchange.

Orders, items, payments and reviews are written once, each dealt by the hash of
``order_id`` into the same number of buckets.  A scan of such a table comes
dealt as a shuffle by ``order_id`` would deal it: the joins between the four
and the aggregates per order run without an exchange, for every build that
reads them.  Products and sellers are stored as plain files.

A bucket is read by one task, which AQE can't split.  The writer therefore
counts the rows of every bucket; where a table's largest holds more than
``UNEVEN`` times its mean (an order with a great share of the rows), the reader
takes the same files without their buckets, and the joins shuffle and split
skewed partitions as ever.  The rows are the same either way.

``layout`` is written last: without it there is nothing to read, so a write
that ended midway isn't read.  A path is written once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .roles import BucketedRoles, Roles

KEY = "order_id"
BUCKETED = ("orders", "items", "payments", "reviews")
#: the largest bucket may hold this many times the mean before buckets are left unused
UNEVEN = 4.0
#: ``schema``: a table without rows has no file to read it from; no buckets: plain files
_LAYOUT = "role STRING, schema STRING, buckets INT, total BIGINT, largest BIGINT"


def _table(spark: SparkSession, role: str, schema: T.StructType, path: str, buckets: int) -> str:
    """Register the bucketed files of a role under a name of its own in the session's catalog."""
    name = f"{role}_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = f"{path}/{role}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
              f"INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def write_bucketed(roles: Roles, path: str, buckets: int | None = None) -> None:
    """Store the six roles at ``path``, a folder not written before.

    ``buckets``: as many as the joins are to have tasks (by default the
    session's shuffle partitions); a few hundred MB of items a bucket.  An
    order without an id meets no other row; it stays in its table.
    """
    spark = roles.orders.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    if n < 1:
        raise ValueError("at least one bucket")
    path, counted = path.rstrip("/"), []
    for role, df in roles.as_dict().items():
        if role not in BUCKETED:
            df.write.parquet(f"{path}/{role}")
            counted.append((role, df.schema.json(), None, None, None))
            continue
        # dealt as the buckets are: one file a bucket
        name = f"{role}_{uuid.uuid4().hex}"
        (df.repartition(n, KEY).write.bucketBy(n, KEY).sortBy(KEY).format("parquet")
           .option("path", f"{path}/{role}").saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")  # the files stay
        per = (spark.read.schema(df.schema).parquet(f"{path}/{role}")
               .groupBy(F.pmod(F.hash(KEY), F.lit(n)).alias("bucket")).count())
        total, largest = per.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
        counted.append((role, df.schema.json(), n, total, largest))
    spark.createDataFrame(counted, _LAYOUT).coalesce(1).write.json(f"{path}/layout")


def read_bucketed(spark: SparkSession, path: str, uneven: float = UNEVEN) -> Roles:
    """The roles stored at ``path``: by their buckets if these are even, else as plain files."""
    path = path.rstrip("/")
    layout = spark.read.schema(_LAYOUT).json(f"{path}/layout").collect()  # a row a role
    even = all(r.largest <= uneven * max(1.0, r.total / r.buckets) for r in layout if r.buckets)
    found = {}
    for r in layout:
        schema = T.StructType.fromJson(json.loads(r.schema))
        found[r.role] = (spark.table(_table(spark, r.role, schema, path, r.buckets)) if even and r.buckets
                         else spark.read.schema(schema).parquet(f"{path}/{r.role}"))
    return (BucketedRoles if even else Roles)(**found)
