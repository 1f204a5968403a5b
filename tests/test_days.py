"""Reference dates of any day: segments against the month grain, the SQL oracle and hand-written rows."""

from __future__ import annotations

import datetime as dt

import pytest
from oracle_compare import _rows, duck
from shop import SF001, Shop

from vendorpulse import FeaturePlan, driver_roles
from vendorpulse import oracle as O
from vendorpulse.functions import dates as D
from vendorpulse.operators import features, segments
from vendorpulse.plans.abt import DayPlan, build_abt, build_abt_range, plan_for


@pytest.fixture(scope="module")
def roles(spark):
    return driver_roles(spark, SF001)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_month_shifts_run_over(spark):
    for d, n, want in [("2018-03-31", -1, "2018-03-03"), ("2016-03-31", -1, "2016-03-02"), ("2018-05-31", -1, "2018-05-01"),
                       ("2018-03-31", -12, "2017-03-31"), ("2018-01-31", 1, "2018-03-03"), ("2018-03-15", -6, "2017-09-15"),
                       ("2018-02-28", 12, "2019-02-28"), ("2018-12-01", 1, "2019-01-01")]:
        assert D.shift_months_py(dt.date.fromisoformat(d), n).isoformat() == want
        assert spark.sql(f"select cast({D.shift_months_sql(f'DATE {d!r}', n)} as string)").first()[0] == want


def test_monthly_range_steps_from_the_date_before():
    step = lambda a, b: [d.isoformat() for d in D.monthly_range(a, b)]
    assert step("2018-01-31", "2018-04-30") == ["2018-01-31", "2018-02-28", "2018-03-28", "2018-04-28"]
    assert step("2018-07-15", "2018-09-14") == ["2018-07-15", "2018-08-15"]
    with pytest.raises(ValueError):
        D.monthly_range("2018-07-15", "2018-07-14")


@pytest.mark.parametrize("dates", [("2018-03-31", "2018-03-30"), ("2018-01-01", "2018-02-01"), ("2016-02-29",),
                                   tuple(f"2018-05-{d:02}" for d in range(1, 29))])
@pytest.mark.parametrize("last_day", [False, True])
def test_segments_hold_every_window(dates, last_day):
    """Day by day: the segment of a day is attached to just the windows that hold the day."""
    line = segments.Timeline.of(dates, last_day)
    at, attached = line.bounds(), line.attached()
    day = at[0] - dt.timedelta(days=3)
    while day < at[-1] + dt.timedelta(days=3):
        seg = sum(b <= day for b in at) - 1
        got = {(r, b) if not label else (r, "label") for s, r, _, b, label in attached if s == seg}
        want = set()
        for r, ref in enumerate(line.dates):
            end = ref if last_day else ref - dt.timedelta(days=1)
            if D.shift_months_py(ref, -12) <= day < end:
                want.add((r, next((n for n in range(1, 7) if day >= D.shift_months_py(ref, -n)), 7)))
            label_end = D.shift_months_py(ref, 1) - dt.timedelta(days=0 if last_day else 1)
            if ref <= day < label_end:
                want.add((r, "label"))
        assert got == want, day
        day += dt.timedelta(days=1)


def test_segments_equal_the_month_grain(spark, roles):
    dates = ["1998-07-01", "1998-08-01", "1998-09-01", "2001-08-01"]
    for last_day in (False, True):
        assert same(DayPlan.of(roles, dates, last_day).layer2(), FeaturePlan.of(roles, dates, last_day).layer2())
    assert same(DayPlan.of(roles, dates).layer1(), FeaturePlan.of(roles, dates).layer1())
    assert same(DayPlan.of(roles, dates).label(), FeaturePlan.of(roles, dates).label())


@pytest.mark.parametrize("dates", [("1996-02-29", "1997-12-31"), tuple(f"1998-03-{d}" for d in range(24, 32)), ("1999-05-30",)])
def test_any_days_match_the_oracle(spark, roles, dates):
    from __spark_entry__ import DV, _rounded
    cur = duck(SF001).execute(O.sql_layer2(dates, DV.layer2_columns()))
    names = [d[0] for d in cur.description]
    got = _rounded(build_abt(roles, dates))
    want = cur.fetchall()
    assert want and _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(names, want)


def test_range_of_months_from_any_day(spark, roles):
    got = build_abt_range(roles, "1998-01-31", "1998-03-28")
    assert sorted({r.dt_ref.isoformat() for r in got.select("dt_ref").distinct().collect()}) == \
        ["1998-01-31", "1998-02-28", "1998-03-28"]
    assert isinstance(plan_for(roles, ["1998-01-01"]), FeaturePlan) and not isinstance(plan_for(roles, ["1998-01-01"]), DayPlan)


def test_hand_written_rows_of_a_day_31(spark):
    """2018-03-31: the last month begins on 03-03, two months on 01-31, three on 2017-12-31; 03-30 is outside."""
    shop = Shop()
    for seller, t in [("a", "2018-03-02 23:00:00"), ("b", "2018-03-03 00:00:00"), ("c", "2018-03-29 23:59:59"),
                      ("d", "2018-03-30 00:00:00"), ("e", "2018-01-30 12:00:00"), ("f", "2018-01-31 12:00:00")]:
        shop.sale(seller, t, delivered="2018-03-31 00:00:00" if seller == "b" else "2018-03-30 23:00:00")
        shop.sale(seller, "2017-11-10 10:00:00")
    shop.sale("a", "2018-04-30 10:00:00")     # the label's month: 03-31 to 04-30, day 31 of April less a day; exclusive
    shop.sale("b", "2018-04-29 10:00:00")
    shop.sale("c", "2018-03-31 00:00:00")
    got = {r.seller_id: r for r in build_abt(shop.roles(spark), ["2018-03-31"]).collect()}
    last = {s: r.qtd_pedidos_ultimo_mes for s, r in got.items()}
    assert last == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0, "f": 0}
    assert {s: r.qtd_pedidos_ultimos_2_meses for s, r in got.items()} == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 0, "f": 1}
    assert {s: r.qtd_pedidos_ultimos_3_meses for s, r in got.items()} == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 1, "f": 1}
    assert got["b"].qtd_pedidos_entregues_ultimo_mes == 0 and got["c"].qtd_pedidos_entregues_ultimo_mes == 1
    assert {s: r.fl_venda for s, r in got.items()} == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0, "f": 0}


def test_groups_dont_follow_the_dates(spark, roles):
    """Monthly dates cut few segments, and the date table holds at most dates x segments rows."""
    dates = D.monthly_range("1996-01-15", "1998-12-15")
    line = segments.Timeline.of(dates)
    assert len(line.bounds()) <= 3 * (len(dates) + 13) and len(line.attached()) <= 40 * len(dates)
    r = roles
    days = segments.segment_groups(r.orders, r.items, r.payments, r.reviews, line).count()
    months = FeaturePlan.of(roles, D.monthly_range("1996-01-01", "1998-12-01")).month_groups().count()
    assert days < 2 * months
    plan = DayPlan.of(roles, dates).layer2()._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan
    assert len(features.layer1_columns()) == 195
