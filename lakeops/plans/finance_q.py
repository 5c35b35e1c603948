"""Registered finance queries (A-FIN-1..12)."""

from __future__ import annotations

from lakeops import params as P
from lakeops.operators import finance as FI
from lakeops.plans import sqlfrag as S
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import SALES_REF, DriverTables

REF = SALES_REF
KPI_RANGE = ("2000-01-01", "2001-12-01")


def _share(x, by):
    return f"CAST({x} AS DOUBLE) / NULLIF(CAST(SUM({x}) OVER (PARTITION BY {by}) AS DOUBLE), 0)"


ALLOC_SQL = f"""
WITH o AS (SELECT o.* FROM sales_order o
           JOIN (SELECT DISTINCT nature_code FROM nature WHERE direction = 'S' AND financial_flag = 'F'
                 AND (is_return IS NULL OR is_return IN ('N', ''))) n ON n.nature_code = o.nature_code
           WHERE o.invoice_number IS NOT NULL AND o.excluded_at IS NULL),
it AS (SELECT order_number, item_code, quantity, CAST(unit_price * quantity AS DECIMAL(18,2)) AS line_value
       FROM order_item WHERE operation_type = 'S' AND excluded_at IS NULL),
it2 AS (SELECT *, SUM(line_value) OVER (PARTITION BY order_number) AS tot, {_share('line_value', 'order_number')} AS item_pct FROM it)
SELECT o.order_number, o.invoice_number, o.partner_code, o.company_code, o.nature_code, o.salesperson_code,
       o.order_date, o.invoice_date, it2.item_code, it2.quantity, it2.line_value,
       CAST(it2.tot AS DECIMAL(18,2)) AS order_items_total, it2.item_pct,
       ROUND(CAST(o.freight_amount AS DOUBLE) * it2.item_pct, 4) AS freight_allocated,
       ROUND(CAST(o.ipi_amount AS DOUBLE) * it2.item_pct, 4) AS ipi_allocated,
       ROUND(CAST(o.icms_amount AS DOUBLE) * it2.item_pct, 4) AS icms_allocated,
       ROUND(CAST(it2.line_value AS DOUBLE) + CAST(o.freight_amount AS DOUBLE) * it2.item_pct
         + CAST(o.ipi_amount AS DOUBLE) * it2.item_pct, 4) AS total_item_allocated,
       i.item_name, i.group_code, i.family_code, p.partner_name
FROM o JOIN it2 ON it2.order_number = o.order_number
LEFT JOIN item i ON i.item_code = it2.item_code
LEFT JOIN partner p ON p.partner_code = o.partner_code"""
ALLOC_VIEWS = ("sales_order", "nature", "order_item", "item", "partner")

_ENRICH = """LEFT JOIN accounts a ON a.financial_item_code = t.financial_item_code
LEFT JOIN partner p ON p.partner_code = t.partner_code"""
_TCOLS = ("t.title_number, t.order_number, t.settlement_type, t.partner_code, t.company_code, t.bank_code, t.issue_date, "
          "t.due_date, t.payment_date, t.document_amount, t.paid_amount, t.net_amount, t.financial_item_code, t.installment_pct, "
          "a.subgroup, a.group_name, a.account_sign, p.partner_name")

SETTLED_SQL = f"""SELECT {_TCOLS} FROM (
  SELECT *, CAST(NULL AS DECIMAL(18,2)) AS net_amount, {_share('document_amount', 'order_number')} AS installment_pct
  FROM settled_title WHERE payment_date IS NOT NULL AND excluded_at IS NULL) t {_ENRICH}"""

OPEN_SQL = f"""SELECT {_TCOLS} FROM (
  SELECT title_number, order_number, 'E' AS settlement_type, partner_code, company_code, bank_code, issue_date, due_date,
         CAST(NULL AS DATE) AS payment_date, document_amount, CAST(NULL AS DECIMAL(18,2)) AS paid_amount, net_amount,
         financial_item_code, {_share('document_amount', 'order_number')} AS installment_pct FROM payable WHERE excluded_at IS NULL
  UNION ALL
  SELECT title_number, order_number, 'D', partner_code, company_code, CAST(NULL AS BIGINT), issue_date, due_date,
         CAST(NULL AS DATE), document_amount, CAST(NULL AS DECIMAL(18,2)), net_amount,
         financial_item_code, {_share('document_amount', 'order_number')} FROM receivable WHERE excluded_at IS NULL) t {_ENRICH}"""
TITLE_VIEWS = ("settled_title", "payable", "receivable", "accounts", "partner")

_PCOLS = ("title_number, order_number, settlement_type, partner_code, partner_name, company_code, financial_item_code, "
          "subgroup, group_name, account_sign, installment_pct, document_amount")


def _pnl_sql(regime, r_date, r_amount, o_date):
    return f"""SELECT 'REALIZADO' AS status, '{regime}' AS regime, {r_date} AS dre_date, {_PCOLS},
       {r_amount} AS effective_amount, CAST(NULL AS DECIMAL(18,2)) AS net_amount FROM ({SETTLED_SQL}) s
UNION ALL
SELECT 'REALIZAR', '{regime}', {o_date}, {_PCOLS}, CAST(NULL AS DECIMAL(18,2)), net_amount FROM ({OPEN_SQL}) o"""


CASH_SQL = _pnl_sql("CAIXA", "payment_date", "paid_amount", "due_date")
ACCRUAL_SQL = _pnl_sql("COMPETENCIA", "issue_date", "document_amount", "issue_date")
MONTHLY_SQL = f"""SELECT regime, strftime(dre_date, '%Y-%m') AS year_month, status, company_code, settlement_type,
       group_name, subgroup, account_sign,
       CAST(SUM(COALESCE(effective_amount, document_amount)) AS DECIMAL(18,2)) AS amount, COUNT(*) AS title_count
FROM ({CASH_SQL} UNION ALL {ACCRUAL_SQL}) l WHERE dre_date IS NOT NULL GROUP BY ALL"""
_MES = "TRY_CAST(year_month || '-01' AS DATE)"
GOLD_SQL = f"""SELECT {_MES} AS month, regime, group_name AS pnl_group, COALESCE(subgroup, group_name) AS description,
       company_code, CAST(CASE WHEN account_sign = 'DEBIT' THEN -amount ELSE amount END AS DECIMAL(18,2)) AS value,
       CAST({S.lookup('group_name', P.PNL_ORDER, P.PNL_ORDER_DEFAULT)} AS INTEGER) AS display_order, title_count
FROM ({MONTHLY_SQL}) m
WHERE status = 'REALIZADO' AND {_MES} IS NOT NULL AND {_MES} <= CAST(date_trunc('month', DATE '{REF}') AS DATE)"""
_KAGGS = ",\n  ".join(f"CAST(COALESCE(SUM(CASE WHEN pnl_group = {S._lit(g)} THEN value END), 0) AS DECIMAL(18,2)) AS {n}"
                      for n, g in FI.KPI_GROUPS)
KPIS_SQL = f"""SELECT *, CAST(faturamento + impostos_vendas + custos_variaveis AS DECIMAL(18,2)) AS margem_bruta,
  CAST(faturamento + impostos_vendas + custos_variaveis + despesas_fixas + despesas_comerciais + marketing AS DECIMAL(18,2)) AS ebitda,
  CAST(faturamento + impostos_vendas + custos_variaveis + despesas_fixas + despesas_comerciais + marketing
       + investimentos + atividades_financeiras AS DECIMAL(18,2)) AS lucro_liquido
FROM (SELECT month, regime, {_KAGGS} FROM ({GOLD_SQL}) g GROUP BY month, regime) k"""


def _T(spark, sf):
    return DriverTables(spark, sf)


def _settled(T):
    return FI.titles_settled(T.settled_title, T.accounts, T.partner)


def _open(T):
    return FI.titles_open(T.payable, T.receivable, T.accounts, T.partner)


def _monthly(T):
    # the monthly summary only sums amounts: no installment share needed
    s = FI.titles_settled(T.settled_title, T.accounts, T.partner, with_share=False)
    o = FI.titles_open(T.payable, T.receivable, T.accounts, T.partner, with_share=False)
    return FI.pnl_monthly(FI.pnl_lines(s, o))


def _gold(T):
    return FI.gold_pnl(_monthly(T), REF)


@register("allocate_billing", with_views(ALLOC_SQL, *ALLOC_VIEWS))
def q_alloc(spark, sf):
    T = _T(spark, sf)
    return FI.allocate_billing(T.sales_order, T.order_item, T.nature, T.item, T.partner)


@register("titles_settled", with_views(SETTLED_SQL, *TITLE_VIEWS))
def q_titles_settled(spark, sf):
    return _settled(_T(spark, sf))


@register("titles_open", with_views(OPEN_SQL, *TITLE_VIEWS))
def q_titles_open(spark, sf):
    return _open(_T(spark, sf))


@register("pnl_cash", with_views(CASH_SQL, *TITLE_VIEWS))
def q_pnl_cash(spark, sf):
    T = _T(spark, sf)
    return FI.pnl_cash(_settled(T), _open(T))


@register("pnl_accrual", with_views(ACCRUAL_SQL, *TITLE_VIEWS))
def q_pnl_accrual(spark, sf):
    T = _T(spark, sf)
    return FI.pnl_accrual(_settled(T), _open(T))


@register("pnl_monthly", with_views(MONTHLY_SQL, *TITLE_VIEWS))
def q_pnl_monthly(spark, sf):
    return _monthly(_T(spark, sf))


@register("product_margin", with_views(f"""
SELECT item_code, item_name, group_code, family_code, company_code, strftime(order_date, '%Y-%m') AS year_month,
       CAST(SUM(quantity) AS DECIMAL(18,4)) AS quantity, CAST(SUM(line_value) AS DECIMAL(18,2)) AS revenue,
       ROUND(SUM(total_item_allocated), 4) AS revenue_with_charges, COUNT(DISTINCT order_number) AS n_orders,
       CAST(NULL AS DECIMAL(18,2)) AS cost, CAST(NULL AS DECIMAL(18,2)) AS margin
FROM ({ALLOC_SQL}) a GROUP BY ALL""", *ALLOC_VIEWS))
def q_product_margin(spark, sf):
    T = _T(spark, sf)
    return FI.product_margin(FI.allocate_billing(T.sales_order, T.order_item, T.nature, T.item, T.partner))


@register("gold_pnl", with_views(GOLD_SQL, *TITLE_VIEWS))
def q_gold_pnl(spark, sf):
    return _gold(_T(spark, sf))


@register("gold_kpis", with_views(KPIS_SQL, *TITLE_VIEWS))
def q_gold_kpis(spark, sf):
    return FI.gold_kpis(_gold(_T(spark, sf)))


_CARD_UNION = " UNION ALL ".join(f"SELECT month, '{k}' AS kpi, {k} AS value FROM k" for k in FI.KPI_CARDS)


@register("kpi_cards", with_views(f"""
WITH k AS (SELECT * FROM ({KPIS_SQL}) x WHERE regime = 'CAIXA' AND month BETWEEN DATE '{KPI_RANGE[0]}' AND DATE '{KPI_RANGE[1]}'),
l AS ({_CARD_UNION}),
c AS (SELECT *, LAG(value) OVER (PARTITION BY kpi ORDER BY month) AS previous FROM l),
d AS (SELECT *, (CAST(value AS DOUBLE) - CAST(previous AS DOUBLE)) / NULLIF(abs(CAST(previous AS DOUBLE)), 0) * 100.0 AS change_pct FROM c)
SELECT *, CASE WHEN change_pct > 0 THEN 'up' WHEN change_pct < 0 THEN 'down' ELSE 'flat' END AS direction FROM d""",
                                  *TITLE_VIEWS))
def q_kpi_cards(spark, sf):
    return FI.kpi_cards(FI.gold_kpis(_gold(_T(spark, sf))), "CAIXA", *KPI_RANGE)


@register("pnl_by_group", with_views(f"""
WITH g AS (SELECT pnl_group, display_order, CAST(SUM(value) AS DECIMAL(18,2)) AS value FROM ({GOLD_SQL}) x
           WHERE regime = 'COMPETENCIA' AND month BETWEEN DATE '{KPI_RANGE[0]}' AND DATE '{KPI_RANGE[1]}' GROUP BY 1, 2)
SELECT pnl_group, display_order, value,
       CAST(abs(value) AS DOUBLE) * 100.0 / NULLIF(CAST((SELECT SUM(abs(value)) FROM g) AS DOUBLE), 0) AS share_pct FROM g""",
                                     *TITLE_VIEWS))
def q_pnl_by_group(spark, sf):
    return FI.pnl_by_group(_gold(_T(spark, sf)), "COMPETENCIA", *KPI_RANGE)


def _ledger_sql(kind):
    amt = "COALESCE(net_amount, document_amount)"
    od = f"due_date < DATE '{REF}'"
    return f"""SELECT *, CAST(overdue AS DOUBLE) * 100.0 / NULLIF(CAST(total AS DOUBLE), 0) AS overdue_pct,
  CASE WHEN CAST(overdue AS DOUBLE) * 100.0 / NULLIF(CAST(total AS DOUBLE), 0) > {P.OVERDUE_DANGER_PCT} THEN 'danger'
       WHEN CAST(overdue AS DOUBLE) * 100.0 / NULLIF(CAST(total AS DOUBLE), 0) > {P.OVERDUE_WARNING_PCT} THEN 'warning'
       ELSE 'ok' END AS band
FROM (SELECT CAST(COALESCE(SUM({amt}), 0) AS DECIMAL(18,2)) AS total, COUNT(*) AS n_titles,
             CAST(COALESCE(SUM(CASE WHEN {od} THEN {amt} END), 0) AS DECIMAL(18,2)) AS overdue,
             COUNT(CASE WHEN {od} THEN 1 END) AS n_overdue
      FROM ({OPEN_SQL}) t WHERE settlement_type = '{kind}') x"""


@register("receivables_ledger", with_views(_ledger_sql("D"), *TITLE_VIEWS))
def q_receivables(spark, sf):
    return FI.open_ledger(_open(_T(spark, sf)), "D", REF)


@register("payables_ledger", with_views(_ledger_sql("E"), *TITLE_VIEWS))
def q_payables(spark, sf):
    return FI.open_ledger(_open(_T(spark, sf)), "E", REF)


def _list_sql(kind: str) -> str:
    return f"""SELECT title_number, COALESCE(partner_name, '—') AS partner_name, due_date, CAST(COALESCE(net_amount, document_amount) AS DECIMAL(18,2)) AS value,
       COALESCE(group_name, '—') AS group_name, COALESCE(subgroup, '—') AS subgroup FROM ({OPEN_SQL}) t WHERE settlement_type = '{kind}'
ORDER BY due_date NULLS LAST, title_number, 2, 4, 5, 6 LIMIT 200"""


@register("receivables_first_due", with_views(_list_sql("D"), *TITLE_VIEWS))
def q_receivables_first_due(spark, sf):
    return FI.open_title_list(_open(_T(spark, sf)), "D")


@register("payables_first_due", with_views(_list_sql("E"), *TITLE_VIEWS))
def q_payables_first_due(spark, sf):
    return FI.open_title_list(_open(_T(spark, sf)), "E")


@register("receivables_by_due_month", with_views(f"""
SELECT CAST(date_trunc('month', due_date) AS DATE) AS due_month,
       CAST(SUM(COALESCE(net_amount, document_amount)) AS DECIMAL(18,2)) AS value, COUNT(*) AS n_titles
FROM ({OPEN_SQL}) t WHERE settlement_type = 'D' GROUP BY 1""", *TITLE_VIEWS))
def q_recv_due(spark, sf):
    return FI.open_by_due_month(_open(_T(spark, sf)), "D")


@register("settlements_monthly", with_views(f"""
SELECT CAST(date_trunc('month', payment_date) AS DATE) AS month, settlement_type,
       CAST(SUM(paid_amount) AS DECIMAL(18,2)) AS paid, COUNT(*) AS n_titles
FROM ({SETTLED_SQL}) s GROUP BY 1, 2""", *TITLE_VIEWS))
def q_settlements(spark, sf):
    return FI.settlements_monthly(_settled(_T(spark, sf)))


@register("cash_flow", with_views(f"""
WITH m AS (SELECT CAST(date_trunc('month', payment_date) AS DATE) AS month,
                  CAST(COALESCE(SUM(CASE WHEN settlement_type = 'D' THEN paid_amount END), 0) AS DECIMAL(18,2)) AS inflow,
                  CAST(COALESCE(SUM(CASE WHEN settlement_type = 'E' THEN paid_amount END), 0) AS DECIMAL(18,2)) AS outflow
           FROM ({SETTLED_SQL}) s GROUP BY 1),
b AS (SELECT *, CAST(inflow - outflow AS DECIMAL(18,2)) AS balance FROM m)
SELECT *, CAST(SUM(balance) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS cumulative
FROM b""", *TITLE_VIEWS))
def q_cash_flow(spark, sf):
    return FI.cash_flow(_settled(_T(spark, sf)))
