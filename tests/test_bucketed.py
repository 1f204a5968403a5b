"""Roles stored in buckets of orders: plans without exchanges by order, uneven buckets, odd rows, unfinished writes."""

from __future__ import annotations

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from shop import SF001, Shop

from vendorpulse import FeaturePlan, driver_roles
from vendorpulse.sources.bucketed import BUCKETED, read_bucketed, write_bucketed

DATES = ("1998-07-01", "1998-08-01", "1998-09-01")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bucketed") / "roles")
    write_bucketed(driver_roles(spark, SF001), path, buckets=6)
    return path


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _by_order(df) -> int:
    """Exchanges on the order alone in the physical plan."""
    return len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, \d+\)", df._jdf.queryExecution().executedPlan().toString()))


def _same(a, b) -> bool:
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_joins_of_buckets_need_no_exchange(spark, stored, no_broadcast):
    """The shuffles of items, orders, payments and reviews are gone; what is left is keyed on sellers and products."""
    plain, bucketed = driver_roles(spark, SF001), read_bucketed(spark, stored)
    assert _by_order(FeaturePlan.of(plain, DATES).layer2()) >= 4
    assert _by_order(FeaturePlan.of(bucketed, DATES).layer2()) == 0
    plan = FeaturePlan.of(bucketed, DATES).layer2()._jdf.queryExecution().executedPlan().toString()
    assert "order_purchase_timestamp" in plan.split("PushedFilters: [IsNotNull(order_purchase_timestamp)")[1]  # still pushed


def test_rows_are_those_of_the_plain_tables(spark, stored):
    assert _same(FeaturePlan.of(read_bucketed(spark, stored), DATES).layer2(),
                 FeaturePlan.of(driver_roles(spark, SF001), DATES).layer2())


def test_stored_roles_keep_their_rows_and_types(spark, stored):
    plain, bucketed = driver_roles(spark, SF001).as_dict(), read_bucketed(spark, stored).as_dict()
    for role, df in plain.items():
        assert [(f.name, f.dataType) for f in bucketed[role].schema] == [(f.name, f.dataType) for f in df.schema], role
        assert _same(bucketed[role], df), role


def test_an_order_with_most_rows_is_read_without_buckets(spark, tmp_path, no_broadcast):
    """A bucket can't be split: then the plan shuffles as ever, and the rows are the same."""
    plain = driver_roles(spark, SF001)
    hot = plain.payments.crossJoin(spark.range(40)).drop("id").withColumn("order_id", F.lit(1).cast(plain.payments.schema["order_id"].dataType))
    roles = plain.__class__(**{**plain.as_dict(), "payments": plain.payments.unionByName(hot)})
    write_bucketed(roles, str(tmp_path / "hot"), buckets=16)
    read = read_bucketed(spark, str(tmp_path / "hot"))
    assert _by_order(FeaturePlan.of(read, DATES[:1]).layer1()) >= 4
    assert _by_order(FeaturePlan.of(read_bucketed(spark, str(tmp_path / "hot"), uneven=100), DATES[:1]).layer1()) == 0
    assert _same(read.payments, roles.payments)


def test_missing_orders_repeats_and_empty_tables(spark, tmp_path):
    shop = Shop()
    a = shop.sale("s1", "2018-05-03")
    shop.sale("s2", "2018-05-04", pay=None)
    shop.sale("s2", "2018-05-31", order_id=a + "x")
    shop.payments.append((None, 1, "boleto", 1, shop.payments[0][4]))
    shop.payments.append(shop.payments[0])  # a repeated row counts
    roles = shop.roles(spark)               # no reviews
    write_bucketed(roles, str(tmp_path / "odd"), buckets=3)
    read = read_bucketed(spark, str(tmp_path / "odd"), uneven=100)
    assert _same(read.payments, roles.payments) and read.reviews.count() == 0
    assert _same(FeaturePlan.of(read, ["2018-06-01"]).layer2(), FeaturePlan.of(roles, ["2018-06-01"]).layer2())


def test_unfinished_and_repeated_writes(spark, stored, tmp_path):
    roles = driver_roles(spark, SF001)
    roles.orders.write.parquet(str(tmp_path / "half" / "orders"))  # as a write that ended before its layout
    with pytest.raises(AnalysisException):
        read_bucketed(spark, str(tmp_path / "half"))
    with pytest.raises(AnalysisException):
        write_bucketed(roles, stored, buckets=6)
    with pytest.raises(ValueError):
        write_bucketed(roles, str(tmp_path / "none"), buckets=0)
    assert len(BUCKETED) == 4
