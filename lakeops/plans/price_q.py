"""Registered price / margin queries (A-PRC-1..6)."""

from __future__ import annotations

from lakeops import params as P
from lakeops.operators import price as PR
from lakeops.plans import sqlfrag as S
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import SALES_REF, DriverTables

REF = SALES_REF
VIEWS = ("order_item", "sales_order", "nature", "item")


def _billed_items_sql(with_state=False) -> str:
    ch = S.lookup("upper(trim(o.channel_code))", P.PRICE_CHANNEL, P.PRICE_CHANNEL_DEFAULT)
    return f"""
SELECT it.item_code, it.order_number, o.partner_code, it.quantity, it.unit_price, it.icms_amount, it.ipi_amount,
       CAST(date_trunc('month', o.invoice_date) AS DATE) AS month, {ch} AS channel
FROM order_item it
JOIN ({S.billed(statuses=None)} AND o.invoice_date >= {S.lookback_start(REF, 12)} AND o.invoice_date <= DATE '{REF}') o
  ON o.order_number = it.order_number"""


_AGGS = """COUNT(DISTINCT order_number) AS n_orders, CAST(SUM(quantity) AS DECIMAL(18,4)) AS quantity,
       CAST(SUM(unit_price * quantity) AS DECIMAL(18,2)) AS revenue,
       CAST(SUM(icms_amount) AS DECIMAL(18,2)) AS icms, CAST(SUM(ipi_amount) AS DECIMAL(18,2)) AS ipi"""


def _finish(agg_sql: str) -> str:
    return f"""SELECT a.*, COALESCE(i.item_name, a.item_code) AS item_name,
       CAST(a.revenue AS DOUBLE) / NULLIF(CAST(a.quantity AS DOUBLE), 0) AS mean_price,
       NULLIF(i.linked_items_cost, 0) AS cost_erp
FROM ({agg_sql}) a LEFT JOIN item i ON i.item_code = a.item_code"""


FACTS_SQL = _finish(f"SELECT item_code, channel, month, {_AGGS} FROM ({_billed_items_sql()}) b GROUP BY item_code, channel, month")
_STATE = f"CASE WHEN trim(COALESCE(p.state, '')) = '' THEN {S._lit(P.BLANK_STATE_LABEL)} ELSE p.state END"
FACTS_STATE_SQL = _finish(f"""SELECT item_code, channel, month, {_STATE} AS state, {_AGGS}
FROM ({_billed_items_sql()}) b LEFT JOIN partner p ON p.partner_code = b.partner_code GROUP BY item_code, channel, month, 4""")


def _margin_sql_cols() -> str:
    fat, qty, icms, ipi = "CAST(revenue AS DOUBLE)", "CAST(quantity AS DOUBLE)", "CAST(icms AS DOUBLE)", "CAST(ipi AS DOUBLE)"

    def pc(n):
        return f"COALESCE({n}, 0.0)"

    unit = "COALESCE(CAST(cost_erp AS DOUBLE), custo_peca, 0.0)"
    parts = f"({unit} * {qty})"
    cred_icms = f"({fat} * COALESCE(pct_credito_icms, pct_credito_icms_ipi, 0.0) / 100.0)"
    cred_ipi = f"({fat} * {pc('pct_credito_ipi')} / 100.0)"
    inv_tax = f"greatest({icms} + {ipi} - ({cred_icms} + {cred_ipi}), 0.0)"
    ads, com = f"({fat} * {pc('pct_ads')} / 100.0)", f"({fat} * {pc('pct_comissao')} / 100.0)"
    oth, fix = f"({fat} * {pc('pct_outras')} / 100.0)", f"({fat} * {pc('pct_custo_fixo')} / 100.0)"
    labour = f"({pc('mao_obra_unit')} * {qty})"
    irpj = "COALESCE(pct_irpj, pct_irpj_csll, 0.0)"
    ptax = (f"({fat} * {pc('pct_pis')} / 100.0 + {fat} * {pc('pct_cofins')} / 100.0 + {fat} * {irpj} / 100.0"
            f" + {fat} * {pc('pct_csll')} / 100.0)")
    total = f"({parts} + {labour} + {inv_tax} + {ads} + {com} + {oth} + {fix} + {ptax})"
    margin = f"({fat} - {total})"
    return f"""{unit} AS unit_cost, {parts} AS parts_cost, {labour} AS labour, {inv_tax} AS invoice_tax,
       ({ads} + {com} + {oth} + {fix}) AS expenses, {ptax} AS profit_taxes, {total} AS total_cost,
       {margin} AS margin, CASE WHEN {fat} <> 0 THEN {margin} / {fat} * 100.0 END AS margin_pct,
       (custo_peca IS NOT NULL) AS manual_cost, (cost_erp IS NOT NULL) AS erp_cost_locked"""


_PCOLS = ", ".join(PR.PARAM_COLS)


def margin_sql(facts_sql: str, params_sql: str = "price_params") -> str:
    return f"""SELECT f.*, {_margin_sql_cols()} FROM ({facts_sql}) f
LEFT JOIN (SELECT item_code, canal AS channel, mes AS month, {_PCOLS} FROM {params_sql}) pp USING (item_code, channel, month)"""


def _facts(T):
    return PR.price_facts(T.order_item, T.sales_order, T.nature, T.item, REF)


@register("price_facts", with_views(FACTS_SQL, *VIEWS))
def q_price_facts(spark, sf):
    return _facts(DriverTables(spark, sf))


@register("price_facts_by_state", with_views(FACTS_STATE_SQL, *VIEWS, "partner"))
def q_price_facts_state(spark, sf):
    T = DriverTables(spark, sf)
    return PR.price_facts_by_state(T.order_item, T.sales_order, T.nature, T.item, T.partner, REF)


@register("price_margin", with_views(margin_sql(FACTS_SQL), *VIEWS, "price_params"))
def q_price_margin(spark, sf):
    T = DriverTables(spark, sf)
    return PR.price_margin(_facts(T), T.price_params)


@register("price_totals", with_views(f"""
SELECT month, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue, ROUND(SUM(margin), 4) AS margin,
       ROUND(SUM(margin) * 100.0 / NULLIF(SUM(CAST(revenue AS DOUBLE)), 0), 4) AS margin_pct, COUNT(*) AS n_items
FROM ({margin_sql(FACTS_SQL)}) m GROUP BY month""", *VIEWS, "price_params"))
def q_price_totals(spark, sf):
    T = DriverTables(spark, sf)
    return PR.price_totals(PR.price_margin(_facts(T), T.price_params))


@register("price_margin_state", with_views(margin_sql(FACTS_STATE_SQL), *VIEWS, "partner", "price_params"))
def q_price_margin_state(spark, sf):
    T = DriverTables(spark, sf)
    f = PR.price_facts_by_state(T.order_item, T.sales_order, T.nature, T.item, T.partner, REF)
    return PR.price_margin(f, T.price_params)


def _overrides(params):
    from pyspark.sql import functions as F

    ov = params.where(F.col("item_code").cast("bigint") % 3 == 0).select("item_code", "canal", "mes")
    return ov.select("*", *[(F.lit(8.0) if c == "pct_comissao" else F.lit(None).cast("double")).alias(c)
                            for c in PR.PARAM_COLS])


_OV_SQL = f"""SELECT item_code, canal, mes, {', '.join('CAST(8.0 AS DOUBLE) AS pct_comissao' if c == 'pct_comissao'
                                               else f'CAST(NULL AS DOUBLE) AS {c}' for c in PR.PARAM_COLS)}
FROM price_params WHERE CAST(item_code AS BIGINT) % 3 = 0"""
_MERGED_SQL = f"""SELECT COALESCE(pp.item_code, ov.item_code) AS item_code, COALESCE(pp.canal, ov.canal) AS canal,
       COALESCE(pp.mes, ov.mes) AS mes, {', '.join(f'COALESCE(ov.{c}, pp.{c}) AS {c}' for c in PR.PARAM_COLS)}
FROM price_params pp FULL OUTER JOIN ({_OV_SQL}) ov ON pp.item_code = ov.item_code AND pp.canal = ov.canal AND pp.mes = ov.mes"""


@register("margin_with_overrides", with_views(f"""
SELECT s.*, c.margin AS margin_current, s.margin - c.margin AS margin_delta
FROM ({margin_sql(FACTS_SQL, f'({_MERGED_SQL})')}) s
JOIN ({margin_sql(FACTS_SQL)}) c USING (item_code, channel, month)""", *VIEWS, "price_params"))
def q_margin_overrides(spark, sf):
    T = DriverTables(spark, sf)
    return PR.margin_with_overrides(_facts(T), T.price_params, _overrides(T.price_params))


@register("price_months", with_views(f"SELECT DISTINCT month FROM ({FACTS_SQL}) f", *VIEWS))
def q_price_months(spark, sf):
    return PR.price_months(_facts(DriverTables(spark, sf)))
