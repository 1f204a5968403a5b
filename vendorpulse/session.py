"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Bloom filters of a join's filtered side at the scan of the other.  By Spark's own limit only sides of 10 MB make
#: one, measured before their filter; here the filter's size is the bound (8 MB), and it is left to the plans to ask.
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100t",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
}


def get_spark(master: str | None = None, app: str = "vendorpulse", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE on and no UI.  On a cluster, ``master`` stays None (spark-submit decides)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot order_id / product_id in its join even though the aggregate
        # above then needs its own exchange (on its wider key, which spreads the key)
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        **BLOOM,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def bloom_filters(spark: SparkSession) -> Iterator[None]:
    """Plans made meanwhile get the filters of ``BLOOM`` whatever the session says, of 8 MB and at tables of any size."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    own = {**BLOOM, f"{prefix}.expectedNumItems": "9000000", f"{prefix}.maxNumItems": "9000000", f"{prefix}.numBits": "67108864",
           f"{prefix}.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a scratch one for local masters when unset."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="vendorpulse-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")
