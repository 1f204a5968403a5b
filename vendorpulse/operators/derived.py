"""Layer 2 of the feature table: ratios, trends, joins to seller and product profiles.

The output order is the published column order of the feature table; the
scoring model selects its inputs by these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.arith import safe_div_sql
from .features import WINDOW_SUFFIXES, q, window_name

F_ALL = [n for n, _ in WINDOW_SUFFIXES]          # _ate_hoje + 1..6
F_RECENT = [n for n, _ in WINDOW_SUFFIXES if n]  # 1..6


def _fam(name: str, windows=F_ALL) -> list[str]:
    return [window_name(name, n) for n in windows]


def _w(fam: str, n: int) -> str:
    return q(window_name(fam, n))


def _ratio_family(out: str, num: str, den: str) -> list[tuple[str, str]]:
    return [(window_name(out, n), safe_div_sql(_w(num, n), _w(den, n))) for n in F_RECENT]


def _trends(prefix: str, value_of) -> list[tuple[str, str]]:
    """``m1_m3``, ``m1_m6``, ``m3_m6`` ratios of a per-window value."""
    return [(f"{prefix}_m{a}_m{b}", safe_div_sql(value_of(a), value_of(b))) for a, b in ((1, 3), (1, 6), (3, 6))]


def _pass(names) -> list[tuple[str, str]]:
    return [(n, q(n)) for n in names]


def layer2_spec() -> list[tuple[str, str]]:
    """(name, Spark SQL expression) of the 201 layer-2 columns, in output order.

    Fixed values: the column names and their order are those of the published
    feature table (the scoring model selects its inputs by name).
    """
    avg_ticket = lambda n: safe_div_sql(_w("total_vlr_pedido", n), _w("qtd_pedidos", n))
    spec: list[tuple[str, str]] = []
    add = spec.extend
    add(_pass(["seller_id"]))
    add([("fl_venda", "CASE WHEN fl_venda IS NULL THEN 0 ELSE 1 END")])
    add(_pass(["seller_zip_code_prefix", "seller_city", "seller_state"]))
    add([("proporcao_ativacao_meses", safe_div_sql("qt_meses_venda_considerado", "qt_total_meses_considerado")),
         ("proporcao_ativacao_dias", safe_div_sql("qt_dias_venda", "qt_total_dias_considerado"))])
    add(_pass(["dias_desde_ult_venda", "dias_desde_ult_estimativa_entrega", "dias_desde_ult_entrega_pedido"]))
    add(_pass(_fam("qtd_pedidos")))
    add(_trends("tend_pedidos", lambda n: _w("qtd_pedidos", n)))
    for fam in ("qtd_produtos", "media_dias_entre_dt_compra_dt_estim_entrega",
                "media_dias_entre_dt_compra_dt_entrega", "media_dias_entre_dt_estimada_dt_entrega"):
        add(_pass(_fam(fam)))
    add(_ratio_family("media_vlr_pedido", "total_vlr_pedido", "qtd_pedidos"))
    add(_trends("tend_media_vlr_pedido", avg_ticket))
    add(_ratio_family("media_vlr_frete", "total_vlr_frete", "qtd_pedidos"))
    add(_ratio_family("media_do_perc_valor_frete_contra_produto", "total_vlr_frete", "total_vlr_pedido"))
    for fam in ("qtd_pedidos_entregues", "qtd_pedidos_cancelados", "qtd_pedidos_outros_status"):
        add(_pass(_fam(fam)))
    add(_ratio_family("media_valores_pedidos_entregues", "total_vlr_pedidos_entregues", "qtd_pedidos_entregues"))
    add(_ratio_family("media_valores_pedidos_cancelados", "total_vlr_pedidos_cancelados", "qtd_pedidos_cancelados"))
    add(_pass(_fam("qtd_pedidos_dt_prevista_menor_data_entrega")))
    for fam in ("qtd_pedidos_pgto_cc", "qtd_pedidos_pgto_boleto", "qtd_pedidos_pgto_outros",
                "media_qtd_parcelas_pedidos_pgto_cc", "media_qtd_parcelas_pedidos_pgto_voucher",
                "max_qtd_parcelas_pedidos_pgto_cc", "max_qtd_parcelas_pedidos_pgto_voucher"):
        add(_pass(_fam(fam, F_RECENT)))
    for kind in ("cc", "boleto", "outros"):
        add(_ratio_family(f"media_valor_pedidos_pgto_{kind}", f"total_valor_pedidos_pgto_{kind}",
                          f"qtd_pedidos_pgto_{kind}"))
    add(_pass(["quantidade_de_produtos_por_categoria", "media_num_fotos_por_produto",
               "media_fotos_por_produto_categoria", "media_tamanho_descriçao_por_produto",
               "qtd_categorias_vendendo"]))
    add(_pass(["qtd_review_ate_hoje", "media_notas_review_ate_hoje",
               "media_dias_entre_criacao_resposta_review_ate_hoje"]))
    add(_pass(_fam("qtd_review", F_RECENT)))
    add(_trends("tend_qtd_notas_review", lambda n: _w("qtd_review", n)))
    add(_pass(_fam("media_notas_review", F_RECENT)))
    add(_trends("tend_notas_review", lambda n: _w("media_notas_review", n)))
    add(_pass(_fam("media_dias_entre_criacao_resposta_review", F_RECENT)))
    return spec


def layer2_columns() -> list[str]:
    return [n for n, _ in layer2_spec()]


def layer2(month_agg: DataFrame, sellers: DataFrame, seller_products: DataFrame) -> DataFrame:
    """D1-D17 over J6 (sellers, inner) and J7 (product profile, inner).

    ``month_agg`` is the seller-month aggregate with its ``fl_venda`` label
    column (J8's left join happened inside that aggregate).  All inputs are
    seller-grain; AQE picks broadcast or sort-merge per join from the sizes
    measured at run time.  The 201 columns are one ``selectExpr``.
    """
    j = month_agg.join(sellers, "seller_id").join(seller_products, "seller_id")
    return j.selectExpr("dt_ref", *[f"{e} AS {q(n)}" for n, e in layer2_spec()])
