"""One test per semantic quirk of the feature definitions (hand-written rows)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from shop import Shop

from vendorpulse import FeaturePlan
from vendorpulse.functions import dates as D
from vendorpulse.operators import preagg

REF = "2018-09-01"


def rows_by_seller(df):
    return {r["seller_id"]: r for r in df.collect()}


def test_last_day_of_window_is_excluded(spark):
    shop = Shop()
    for t in ("2018-08-30 23:59:59", "2018-08-31 00:00:00", "2018-08-31 14:00:00", "2018-08-01 00:00:00"):
        shop.sale("s1", t)
    r = shop.roles(spark)
    got = rows_by_seller(FeaturePlan.of(r, [REF]).layer1())["s1"]
    assert got["qtd_pedidos_ultimo_mes"] == 2
    assert got["qtd_pedidos_ate_hoje"] == 2
    got = rows_by_seller(FeaturePlan.of(r, [REF], include_last_day=True).layer1())["s1"]
    assert got["qtd_pedidos_ultimo_mes"] == 4


def test_label_month_drops_its_last_day(spark):
    shop = Shop()
    for s, t in (("a", "2018-07-01 00:00:00"), ("b", "2018-07-30 10:00:00"), ("c", "2018-07-31 10:00:00")):
        shop.sale(s, "2018-05-10 10:00:00")          # history, so the seller has a feature row
        shop.sale(s, t)
    r = shop.roles(spark)
    standalone = {x["seller_id"] for x in FeaturePlan.of(r, ["2018-07-01"]).label().collect()}
    assert standalone == {"a", "b"}
    abt = rows_by_seller(FeaturePlan.of(r, ["2018-07-01"]).layer2())
    assert {s: abt[s]["fl_venda"] for s in "abc"} == {"a": 1, "b": 1, "c": 0}


def test_twelve_month_observation_window(spark):
    shop = Shop()
    shop.sale("s1", "2017-09-01 00:00:00")
    shop.sale("s1", "2017-08-31 23:00:00")
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())["s1"]
    assert got["qtd_pedidos_ate_hoje"] == 1


def test_future_delivery_is_masked(spark):
    shop = Shop()
    shop.sale("s1", "2018-08-10 10:00:00", delivered="2018-08-31 23:00:00")
    shop.sale("s1", "2018-08-11 10:00:00", delivered="2018-09-01 00:00:00")
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())["s1"]
    assert got["qtd_pedidos_ate_hoje"] == 2
    assert got["qtd_pedidos_entregues_ate_hoje"] == 1
    assert got["qtd_pedidos_cancelados_ate_hoje"] == 0
    assert got["qtd_pedidos_outros_status_ate_hoje"] == 0
    assert got["max_delivered_customer_date"] == dt.date(2018, 8, 31)


def test_zero_divisors_give_null_not_error(spark):
    shop = Shop()
    shop.sale("s1", "2018-04-10 10:00:00")           # bucket 5
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer2())["s1"]
    assert got["tend_pedidos_m1_m3"] is None
    assert got["tend_pedidos_m1_m6"] == 0.0
    assert got["media_vlr_pedido_ultimo_mes"] is None


def test_reference_date_must_be_first_of_month():
    with pytest.raises(ValueError):
        D.validate_ref_dates(["2018-08-31"])
    assert D.monthly_range("2018-07-01", "2018-09-01") == [dt.date(2018, 7, 1), dt.date(2018, 8, 1),
                                                           dt.date(2018, 9, 1)]


def test_order_values_repeat_per_product_line(spark):
    shop = Shop()
    oid = shop.sale(["s1"], "2018-08-10 10:00:00", products=["p1", "p2"], pay=[("credit_card", 2, "100.00")])
    shop.items.append((oid, 9, "p3", "s2", Decimal("5.00"), Decimal("1.00")))
    shop.sellers.add("s2")
    shop.products["p3"] = ("p3", "cat", 1, 10)
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())
    assert got["s1"]["total_valor_pedidos_pgto_cc_ate_hoje"] == Decimal("200")
    assert got["s2"]["total_valor_pedidos_pgto_cc_ate_hoje"] == Decimal("100")
    assert got["s1"]["qtd_pedidos_ate_hoje"] == 1 and got["s2"]["qtd_pedidos_ate_hoje"] == 1
    assert got["s1"]["qtd_produtos_ate_hoje"] == 2


def test_activation_months_count_twelve_but_cap_at_six(spark):
    shop = Shop()
    for m in ("2017-09", "2017-10", "2017-11", "2017-12", "2018-01", "2018-02"):
        shop.sale("s1", f"{m}-15 10:00:00")
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer2())["s1"]
    assert got["proporcao_ativacao_meses"] == 1.0
    assert got["proporcao_ativacao_dias"] == 0.0


def test_product_profile_counts_null_photos_in_denominator(spark):
    shop = Shop()
    shop.sale("s1", "2018-08-10 10:00:00", products=["p1", "p2"])
    shop.products["p1"] = ("p1", None, 2, 10)
    shop.products["p2"] = ("p2", "a", None, 30)
    r = shop.roles(spark)
    got = rows_by_seller(preagg.products_per_seller(r.items, r.products))["s1"]
    assert got["media_num_fotos_por_produto"] == 1.0
    assert got["media_fotos_por_produto_categoria"] == 1.0
    assert got["qtd_categorias_vendendo"] == 2
    assert got["quantidade_de_produtos_por_categoria"] == 1.0
    assert got["media_tamanho_descriçao_por_produto"] == 20.0


def test_zero_installments_do_not_count_as_paid(spark):
    shop = Shop()
    shop.sale("s1", "2018-08-10 10:00:00", pay=[("voucher", 0, "5.00"), ("boleto", 1, "5.00")])
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer2())["s1"]
    assert got["qtd_pedidos_pgto_outros_ultimo_mes"] == 0
    assert got["qtd_pedidos_pgto_boleto_ultimo_mes"] == 1


def test_installment_mean_is_over_distinct_values(spark):
    shop = Shop()
    for day, inst in (("10", 1), ("11", 1), ("12", 4)):
        shop.sale("s1", f"2018-08-{day} 10:00:00", pay=[("credit_card", inst, "10.00")])
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())["s1"]
    assert got["media_qtd_parcelas_pedidos_pgto_cc_ultimo_mes"] == 2.5
    assert got["max_qtd_parcelas_pedidos_pgto_cc_ultimo_mes"] == 4


def test_last_review_score_per_order(spark):
    shop = Shop()
    a = shop.sale("s1", "2018-08-10 10:00:00")
    b = shop.sale("s1", "2018-08-11 10:00:00")
    shop.review(a, 1, "2018-01-05 00:00:00")
    shop.review(a, 5, "2018-03-05 00:00:00")
    shop.review(b, 2, "2018-02-05 00:00:00")
    got = {r["order_id"]: r for r in preagg.reviews_per_order(shop.roles(spark).reviews).collect()}
    assert got[a]["last_score"] == 5 and got[b]["last_score"] == 2
    assert got[a]["avg_score"] == 3.0 and got[a]["qt_reviews"] == 2


def test_order_without_payment_is_dropped(spark):
    shop = Shop()
    shop.sale("s1", "2018-08-10 10:00:00", pay=[])
    shop.sale("s2", "2018-08-10 10:00:00")
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())
    assert set(got) == {"s2"}


def test_order_without_review_still_counts(spark):
    shop = Shop()
    shop.sale("s1", "2018-08-10 10:00:00")
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())["s1"]
    assert got["qtd_pedidos_ate_hoje"] == 1
    assert got["qtd_review_ate_hoje"] is None
    assert got["media_notas_review_ate_hoje"] is None


def test_active_seller_without_next_month_sale_has_label_zero(spark):
    shop = Shop()
    shop.sale("s1", "2018-08-10 10:00:00")
    shop.sale("s2", "2018-08-10 10:00:00")
    shop.sale("s2", "2018-09-03 10:00:00")
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer2())
    assert got["s1"]["fl_venda"] == 0 and got["s2"]["fl_venda"] == 1


def test_sale_days_and_months_bitmaps_match_distinct_counts(spark):
    shop = Shop()
    # ref 2018-09-01: six months back is 2018-03-01 (184 days); oldest allowed day offset 184
    for t in ("2018-03-01 00:00:00", "2018-03-01 05:00:00", "2018-05-20 10:00:00", "2018-08-30 10:00:00",
              "2017-09-01 00:00:00", "2017-12-31 23:00:00"):
        shop.sale("s1", t)
    got = rows_by_seller(FeaturePlan.of(shop.roles(spark), [REF]).layer1())["s1"]
    assert got["qt_dias_venda"] == 3
    assert got["qt_meses_venda_considerado"] == 5   # 2017-09, 2017-12, 2018-03, 2018-05, 2018-08


def test_include_last_day_also_widens_the_label_month(spark):
    shop = Shop()
    for s, t in (("a", "2018-07-01 00:00:00"), ("c", "2018-07-31 10:00:00"), ("d", "2018-08-01 00:00:00")):
        shop.sale(s, "2018-05-10 10:00:00")
        shop.sale(s, t)
    r = shop.roles(spark)
    abt = rows_by_seller(FeaturePlan.of(r, ["2018-07-01"], include_last_day=True).layer2())
    assert {s: abt[s]["fl_venda"] for s in "acd"} == {"a": 1, "c": 1, "d": 0}
    standalone = {x["seller_id"] for x in FeaturePlan.of(r, ["2018-07-01"], include_last_day=True).label().collect()}
    assert standalone == {"a", "c"}

