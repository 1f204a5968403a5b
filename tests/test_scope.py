"""Payments and reviews of the orders in scope alone."""

from __future__ import annotations

import pytest
from shop import Shop

from vendorpulse import FeaturePlan, driver_roles
from vendorpulse.plans.abt import DayPlan
from vendorpulse.session import BLOOM

SF01 = "/root/testdata/sf0.01"
DATE = ("1998-09-01",)


@pytest.fixture
def bloom(spark):
    """As on large tables: no side small enough to broadcast, none too small for a filter."""
    conf = {**BLOOM, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def _nodes(plan):
    yield plan
    name = plan.getClass().getSimpleName()
    inner = (plan.finalPhysicalPlan() if name == "AdaptiveSparkPlanExec" else
             plan.plan() if name.endswith("QueryStageExec") else None)
    children = plan.children()
    for child in ([inner] if inner is not None else [children.apply(i) for i in range(children.size())]):
        yield from _nodes(child)


def _by_order_rows(df) -> int:
    """Rows that the run plan shuffled by order alone."""
    df._jdf.collectToPython()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    for p in _nodes(plan):
        if p.getClass().getSimpleName() == "ShuffleExchangeExec" and "hashpartitioning(order_id" in p.toString().split("\n")[0]:
            total += p.metrics().apply("shuffleRecordsWritten").value()
    return total


def test_filter_stands_below_the_aggregates_and_rows_shuffled_fall(spark, bloom):
    whole = FeaturePlan.of(driver_roles(spark, SF01), DATE)
    cut = whole.reduced(share=0.5)
    text = cut.layer1()._jdf.queryExecution().optimizedPlan().toString()
    for total in ("avg(review_score", "THEN payment_installments"):
        at = next(i for i, line in enumerate(text.split("\n")) if "Aggregate [order_id" in line and total in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        rest = text.split("\n")[at:]
        below = rest[1:1 + next((i for i, line in enumerate(rest[1:]) if depth(line) <= depth(rest[0])), len(rest))]
        assert any("might_contain" in line for line in below), total
    all_rows, scoped = _by_order_rows(whole.layer1()), _by_order_rows(cut.layer1())
    assert 0 < scoped < 0.6 * all_rows, (scoped, all_rows)


@pytest.mark.parametrize("dates", [DATE, ("1998-03-31", "2001-07-31")])
def test_rows_stay_the_same(spark, dates):
    plan = (FeaturePlan if dates == DATE else DayPlan).of(driver_roles(spark, "/root/testdata/sf0.001"), dates)
    cut = plan.reduced(share=1.0)
    assert cut is not plan
    a, b = plan.layer2(), cut.layer2()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_wide_scope_keeps_the_plan(spark):
    plan = FeaturePlan.of(driver_roles(spark, SF01), DATE)
    assert plan.reduced(share=0.01) is plan


def test_orders_of_the_labels_month_no_payments_and_no_orders(spark):
    """An order of the month that starts at the date counts for the label alone; rows of unknown orders end at the join."""
    shop = Shop()
    shop.sale("s1", "2018-05-03")
    shop.sale("s1", "2018-06-03")
    shop.sale("s2", "2018-05-05", pay=None)
    shop.sale("s3", "2010-05-05")
    shop.review("o1", 5, "2018-05-20")
    shop.review("unknown", 1, "2018-05-20")
    shop.payments.append((None, 1, "boleto", 1, shop.payments[0][4]))
    plan = FeaturePlan.of(shop.roles(spark), ["2018-06-01"])
    got = plan.reduced(share=1.0).layer2()
    assert got.collect() == plan.layer2().collect()
    assert [(r.seller_id, r.fl_venda) for r in got.collect()] == [("s1", 1)]
    none = FeaturePlan.of(Shop().roles(spark), ["2018-06-01"])
    assert none.reduced().layer2().count() == 0


@pytest.fixture
def large(spark):
    """As on large tables: no side small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_published_writes_ask_for_filters_themselves(spark, large, monkeypatch, tmp_path):
    """The session asks for none: the write's plan has them for payments and reviews, and only it."""
    from vendorpulse.plans.abt import build_abt, publish_abt, read_published
    from vendorpulse.plans.versions import Versions
    plans, stage = [], Versions.stage

    def seen(self, table, df, *a, **k):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(self, table, df, *a, **k)
    monkeypatch.setattr(Versions, "stage", seen)
    roles = driver_roles(spark, SF01)
    publish_abt(build_abt(roles, DATE, reduced=True), str(tmp_path / "abt"), DATE)
    assert plans[0].count("might_contain") >= 2
    assert "might_contain" not in build_abt(roles, DATE, reduced=True)._jdf.queryExecution().optimizedPlan().toString()
    got, want = read_published(spark, str(tmp_path / "abt")), build_abt(roles, DATE)
    assert sorted(got.collect(), key=str) == sorted(want.select(*got.columns).collect(), key=str)
