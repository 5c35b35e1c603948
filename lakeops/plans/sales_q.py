"""Registered sales / purchases / quotes queries (A-COM-17..24)."""

from __future__ import annotations

from lakeops import params as P
from lakeops.operators import sales as SA
from lakeops.plans import sqlfrag as S
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import SALES_REF, DriverTables

REF = SALES_REF
REF_MONTH = "2001-07-01"
NOW = "2001-08-01 00:00:00"
PERIOD = ("2001-03-01", "2001-05-31")

CHANNEL_SQL = ("CASE WHEN o.salesperson_group_code IS NULL THEN " + S._lit(P.CHANNEL_NULL_GROUP) + " ELSE "
               + S.lookup("o.salesperson_group_code", P.CHANNEL_BY_GROUP, P.CHANNEL_OTHER) + " END")
DS = f"""ds AS (SELECT o.*, {CHANNEL_SQL} AS channel, CAST(date_trunc('month', o.invoice_date) AS DATE) AS month
FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N'
WHERE o.invoice_date IS NOT NULL)"""


def _ds(T):
    return SA.dashboard_sales(T.sales_order, T.nature)


def _pct_change(cur, prev):
    return f"(CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / NULLIF(CAST({prev} AS DOUBLE), 0) * 100.0"


def _pct(a, b):
    return f"CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0)"


M0, M1, M12 = f"DATE '{REF_MONTH}'", f"CAST(DATE '{REF_MONTH}' - INTERVAL 1 MONTH AS DATE)", \
    f"CAST(DATE '{REF_MONTH}' - INTERVAL 12 MONTH AS DATE)"
PERIOD_AGGS = f"""
  CAST(COALESCE(SUM(CASE WHEN month = {M0} THEN product_amount END), 0) AS DECIMAL(18,2)) AS revenue,
  CAST(COALESCE(SUM(CASE WHEN month = {M1} THEN product_amount END), 0) AS DECIMAL(18,2)) AS revenue_prev,
  CAST(COALESCE(SUM(CASE WHEN month = {M12} THEN product_amount END), 0) AS DECIMAL(18,2)) AS revenue_ly,
  COUNT(CASE WHEN month = {M0} THEN 1 END) AS transactions"""
DERIVED = f"""COALESCE(CAST(revenue AS DOUBLE) / NULLIF(CAST(transactions AS DOUBLE), 0), 0.0) AS ticket,
  {_pct_change('revenue', 'revenue_prev')} AS mom_pct, {_pct_change('revenue', 'revenue_ly')} AS yoy_pct"""


@register("sales_month_kpis", with_views(f"""WITH {DS}
SELECT *, {DERIVED} FROM (SELECT {PERIOD_AGGS} FROM ds WHERE month IN ({M0}, {M1}, {M12})) t""", "sales_order", "nature"))
def q_sales_month_kpis(spark, sf):
    return SA.sales_month_kpis(_ds(DriverTables(spark, sf)), REF_MONTH)


@register("sales_month_kpis_b2b", with_views(f"""WITH {DS}
SELECT *, {DERIVED} FROM (SELECT {PERIOD_AGGS} FROM ds WHERE month IN ({M0}, {M1}, {M12}) AND channel <> 'Marketplace') t""",
                                             "sales_order", "nature"))
def q_sales_month_kpis_b2b(spark, sf):
    return SA.sales_month_kpis(_ds(DriverTables(spark, sf)), REF_MONTH, include_marketplace=False)


@register("sales_by_channel", with_views(f"""WITH {DS}
SELECT *, {DERIVED}, CAST({S.lookup('channel', [(c, i) for i, c in enumerate(P.CHANNEL_ORDER)], 99)} AS INTEGER) AS channel_order
FROM (SELECT channel, {PERIOD_AGGS} FROM ds WHERE month IN ({M0}, {M1}, {M12}) GROUP BY channel) t WHERE transactions > 0""",
                                         "sales_order", "nature"))
def q_sales_by_channel(spark, sf):
    return SA.sales_by_channel(_ds(DriverTables(spark, sf)), REF_MONTH)


_EVO_COLS = ",\n  ".join(
    f"CAST(COALESCE(SUM(CASE WHEN channel = {S._lit(c)} THEN product_amount END), 0) AS DECIMAL(18,2)) AS {SA._slug(c)}"
    for c in P.CHANNEL_ORDER)
_EVO_TOTAL = " + ".join(SA._slug(c) for c in P.CHANNEL_ORDER)


@register("sales_evolution", with_views(f"""WITH {DS},
piv AS (SELECT month, {_EVO_COLS} FROM ds
        WHERE invoice_date >= CAST(DATE '{REF_MONTH}' - INTERVAL 11 MONTH AS DATE) AND invoice_date <= last_day(DATE '{REF_MONTH}')
        GROUP BY month),
tot AS (SELECT *, CAST({_EVO_TOTAL} AS DECIMAL(18,2)) AS total FROM piv)
SELECT *, {_pct_change('total', 'LAG(total) OVER (ORDER BY month)')} AS mom_pct FROM tot""", "sales_order", "nature"))
def q_sales_evolution(spark, sf):
    return SA.sales_evolution(_ds(DriverTables(spark, sf)), REF_MONTH)


@register("sales_weeks", with_views(f"""WITH {DS}
SELECT CAST(floor((day(invoice_date) - 1) / 7) + 1 AS INTEGER) AS week,
       printf('%02d-%02d', CAST((floor((day(invoice_date) - 1) / 7)) * 7 + 1 AS INTEGER),
              CAST(least((floor((day(invoice_date) - 1) / 7)) * 7 + 7, day(last_day(invoice_date))) AS INTEGER)) AS week_label,
       channel, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS revenue, COUNT(*) AS transactions
FROM ds WHERE month = {M0} GROUP BY ALL""", "sales_order", "nature"))
def q_sales_weeks(spark, sf):
    return SA.sales_weeks(_ds(DriverTables(spark, sf)), REF_MONTH)


@register("marketplace_detail", with_views(f"""WITH {DS},
a AS (SELECT {S.lookup('upper(trim(channel_code))', P.PRICE_CHANNEL, 'Outros Marketplaces')} AS sub_channel,
             CAST(SUM(product_amount) AS DECIMAL(18,2)) AS revenue, COUNT(*) AS transactions
      FROM ds WHERE month = {M0} AND channel = 'Marketplace' GROUP BY 1)
SELECT sub_channel, revenue, transactions, {_pct('revenue', '(SELECT SUM(revenue) FROM a)')} AS share_pct FROM a""",
                                           "sales_order", "nature"))
def q_marketplace_detail(spark, sf):
    return SA.marketplace_detail(_ds(DriverTables(spark, sf)), REF_MONTH)


_IN_O = f"o.order_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'"
_IN_I = f"o.invoice_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'"


@register("sales_period", with_views(f"""
SELECT {CHANNEL_SQL} AS channel,
  COUNT(CASE WHEN {_IN_O} THEN 1 END) AS orders_placed,
  CAST(COALESCE(SUM(CASE WHEN {_IN_O} THEN o.product_amount END), 0) AS DECIMAL(18,2)) AS value_placed,
  COUNT(CASE WHEN {_IN_I} THEN 1 END) AS orders_invoiced,
  CAST(COALESCE(SUM(CASE WHEN {_IN_I} THEN o.product_amount END), 0) AS DECIMAL(18,2)) AS value_invoiced
FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N'
WHERE {_IN_O} OR {_IN_I} GROUP BY 1""", "sales_order", "nature"))
def q_sales_period(spark, sf):
    T = DriverTables(spark, sf)
    return SA.sales_period(T.sales_order, T.nature, *PERIOD)


@register("available_months", with_views("""
SELECT DISTINCT CAST(date_trunc('month', invoice_date) AS DATE) AS month FROM sales_order WHERE invoice_date IS NOT NULL""",
                                         "sales_order"))
def q_available_months(spark, sf):
    return SA.available_months(DriverTables(spark, sf).sales_order)


_ABC_SQL = f"""
WITH b AS ({S.billed()} AND o.invoice_date >= {S.lookback_start(REF, 12)} AND o.invoice_date <= DATE '{REF}'),
j AS (SELECT b.*, p.partner_name, p.city, p.state, upper(trim(p.partner_name)) AS name_norm
      FROM b JOIN partner p ON p.partner_code = b.partner_code),
a AS (SELECT name_norm, MIN(partner_name) AS client,
             (list(city ORDER BY product_amount DESC, city DESC) FILTER (WHERE city IS NOT NULL))[1] AS city,
             (list(state ORDER BY product_amount DESC, state DESC) FILTER (WHERE state IS NOT NULL))[1] AS state,
             COUNT(DISTINCT order_number) AS n_orders, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS revenue
      FROM j GROUP BY name_norm ORDER BY revenue DESC, name_norm LIMIT 100),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC, name_norm) AS INTEGER) AS position,
             CAST(SUM(revenue) OVER (ORDER BY revenue DESC, name_norm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
               * 100.0 / CAST(SUM(revenue) OVER () AS DOUBLE) AS cum_pct FROM a)
SELECT client, city, state, n_orders, revenue, position, cum_pct,
       {S.bands('cum_pct', P.ABC_BOUNDS, P.ABC_FALLBACK, '<=')} AS abc_class FROM r"""


def _abc(T):
    return SA.abc_ranking(T.sales_order, T.nature, T.partner, REF)


@register("abc_ranking", with_views(_ABC_SQL, "sales_order", "nature", "partner"))
def q_abc_ranking(spark, sf):
    return _abc(DriverTables(spark, sf))


@register("abc_curve", with_views(f"""
WITH b AS ({S.billed()} AND o.invoice_date >= {S.lookback_start(REF, 12)} AND o.invoice_date <= DATE '{REF}'),
a AS (SELECT upper(trim(p.partner_name)) AS name_norm, MIN(p.partner_name) AS client, COUNT(DISTINCT b.order_number) AS n_orders,
             CAST(SUM(b.product_amount) AS DECIMAL(18,2)) AS revenue
      FROM b JOIN partner p ON p.partner_code = b.partner_code GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, name_norm) AS position,
             SUM(revenue) OVER (ORDER BY revenue DESC, name_norm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             SUM(revenue) OVER () AS whole FROM a),
c AS (SELECT *, CAST(cum AS DOUBLE) * 100.0 / CAST(whole AS DOUBLE) AS cum_pct FROM r)
SELECT client, n_orders, revenue, position, CAST(cum AS DECIMAL(18,2)) AS cum_revenue, cum_pct,
       {S.bands('cum_pct', P.ABC_BOUNDS, P.ABC_FALLBACK, '<=')} AS abc_class FROM c""", "sales_order", "nature", "partner"))
def q_abc_curve(spark, sf):
    T = DriverTables(spark, sf)
    return SA.abc_curve(T.sales_order, T.nature, T.partner, REF)


@register("abc_kpis", with_views(f"""WITH rk AS ({_ABC_SQL}),
n AS (SELECT greatest(1, floor(COUNT(*) * 0.2)) AS k FROM rk)
SELECT CAST(SUM(revenue) AS DECIMAL(18,2)) AS top_revenue, COUNT(CASE WHEN abc_class = 'A' THEN 1 END) AS class_a,
       {_pct('SUM(CASE WHEN position <= (SELECT k FROM n) THEN revenue END)', 'SUM(revenue)')} AS top_share_pct FROM rk""",
                                 "sales_order", "nature", "partner"))
def q_abc_kpis(spark, sf):
    return SA.abc_kpis(_abc(DriverTables(spark, sf)))


_FIN_JOIN = "JOIN nature n ON n.nature_code = x.nature_code AND n.financial_flag <> 'N'"
_SINCE12 = f"x.invoice_date >= CAST(DATE '{REF}' - INTERVAL 12 MONTH AS DATE)"


@register("purchases_kpis", with_views(f"""
WITH dom AS (SELECT COUNT(*) AS dom_orders, CAST(COALESCE(SUM(product_amount), 0) AS DECIMAL(18,2)) AS dom_value
             FROM purchase_order x {_FIN_JOIN} WHERE {_SINCE12} AND x.excluded_at IS NULL),
imp AS (SELECT * FROM import_order WHERE excluded_at IS NULL),
sup AS (SELECT supplier_name, SUM(total_brl) AS v FROM imp GROUP BY 1),
top AS (SELECT supplier_name, v FROM sup ORDER BY v DESC, supplier_name DESC LIMIT 1),
tot AS (SELECT CAST(COALESCE(SUM(total_brl), 0) AS DECIMAL(18,2)) AS import_brl,
               CAST(COALESCE(SUM(total_usd), 0) AS DECIMAL(18,2)) AS import_usd FROM imp),
ven AS (SELECT CAST(COALESCE(SUM(product_amount), 0) AS DECIMAL(18,2)) AS sales_value
        FROM sales_order x {_FIN_JOIN} WHERE {_SINCE12})
SELECT dom_orders, dom_value, import_brl, import_usd, sales_value, top.supplier_name AS top_import_supplier,
       CAST(top.v AS DECIMAL(18,2)) AS top_import_value,
       COALESCE({_pct('dom_value', 'sales_value')}, 0.0) AS purchase_sales_pct,
       COALESCE({_pct('top.v', 'import_brl')}, 0.0) AS import_concentration_pct
FROM dom, tot, top, ven""", "purchase_order", "import_order", "sales_order", "nature"))
def q_purchases_kpis(spark, sf):
    T = DriverTables(spark, sf)
    return SA.purchases_kpis(T.purchase_order, T.import_order, T.sales_order, T.nature, REF)


_M0 = f"DATE '{REF[:8]}01'"
_WIN = f"x.invoice_date >= CAST({_M0} - INTERVAL 12 MONTH AS DATE) AND x.invoice_date < {_M0}"


@register("purchases_series", with_views(f"""
WITH v AS (SELECT CAST(date_trunc('month', x.invoice_date) AS DATE) AS month, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS sales
           FROM sales_order x {_FIN_JOIN} WHERE {_WIN} GROUP BY 1),
c AS (SELECT CAST(date_trunc('month', x.invoice_date) AS DATE) AS month, SUM(product_amount) AS p
      FROM purchase_order x {_FIN_JOIN} WHERE {_WIN} AND x.excluded_at IS NULL GROUP BY 1)
SELECT v.month, v.sales, CAST(COALESCE(c.p, 0) AS DECIMAL(18,2)) AS purchases FROM v LEFT JOIN c ON c.month = v.month""",
                                         "sales_order", "purchase_order", "nature"))
def q_purchases_series(spark, sf):
    T = DriverTables(spark, sf)
    return SA.purchases_series(T.sales_order, T.purchase_order, T.nature, REF)


@register("top_suppliers", with_views(f"""
SELECT supplier_name AS supplier, COUNT(*) AS orders, CAST(ROUND(SUM(product_amount), 2) AS DECIMAL(18,2)) AS value
FROM purchase_order x {_FIN_JOIN} WHERE {_SINCE12} AND x.excluded_at IS NULL
GROUP BY 1 ORDER BY value DESC, supplier LIMIT 10""", "purchase_order", "nature"))
def q_top_suppliers(spark, sf):
    T = DriverTables(spark, sf)
    return SA.top_suppliers(T.purchase_order, T.nature, REF)


@register("import_suppliers", with_views("""
SELECT supplier_name, CAST(ROUND(SUM(total_brl), 0) AS DECIMAL(18,0)) AS value FROM import_order
WHERE excluded_at IS NULL GROUP BY 1 ORDER BY value DESC, supplier_name LIMIT 8""", "import_order"))
def q_import_suppliers(spark, sf):
    return SA.import_suppliers(DriverTables(spark, sf).import_order)


def _ago(d):
    return f"(TIMESTAMP '{NOW}' - INTERVAL {d} DAY)"


_QW = f"created_at >= {_ago(P.QUOTE_WINDOW_DAYS)}"


@register("quote_kpis", with_views(f"""
SELECT CAST(COALESCE(SUM(CASE WHEN detailed_status = 1 AND created_at >= {_ago(90)} THEN total_amount END), 0) AS DECIMAL(18,2)) AS pipeline_value,
       COUNT(CASE WHEN detailed_status = 1 AND created_at >= {_ago(90)} THEN 1 END) AS pipeline_n,
       CAST(COALESCE(SUM(CASE WHEN detailed_status = 1 AND created_at < {_ago(180)} THEN total_amount END), 0) AS DECIMAL(18,2)) AS stalled_value,
       COUNT(CASE WHEN detailed_status = 1 AND created_at < {_ago(180)} THEN 1 END) AS stalled_n,
       {_pct(f'COUNT(CASE WHEN created_at <= {_ago(90)} AND detailed_status = 2 THEN 1 END)',
             f'COUNT(CASE WHEN created_at <= {_ago(90)} THEN 1 END)')} AS conversion_pct
FROM quotes WHERE excluded_at IS NULL AND {_QW}""", "quotes"))
def q_quote_kpis(spark, sf):
    return SA.quote_kpis(DriverTables(spark, sf).quotes, NOW)


@register("quote_cycle", with_views(f"""
SELECT CAST(quantile_disc(date_diff('day', CAST(q.created_at AS DATE), o.invoice_date), 0.5) AS BIGINT) AS median_cycle_days
FROM quotes q JOIN sales_order o ON o.quote_number = q.quote_number
WHERE q.{_QW} AND o.invoice_date IS NOT NULL AND o.invoice_date >= CAST(q.created_at AS DATE)""", "quotes", "sales_order"))
def q_quote_cycle(spark, sf):
    T = DriverTables(spark, sf)
    return SA.quote_cycle(T.quotes, T.sales_order, NOW)


@register("quote_cohorts", with_views(f"""
SELECT CAST(date_trunc('month', CAST(created_at AS DATE)) AS DATE) AS month, COUNT(*) AS quotes,
       COUNT(CASE WHEN detailed_status = 2 THEN 1 END) AS won,
       {_pct('COUNT(CASE WHEN detailed_status = 2 THEN 1 END)', 'COUNT(*)')} AS conversion_pct
FROM quotes WHERE excluded_at IS NULL AND {_QW} GROUP BY 1""", "quotes"))
def q_quote_cohorts(spark, sf):
    return SA.quote_cohorts(DriverTables(spark, sf).quotes, NOW)


@register("quote_ageing", with_views(f"""
SELECT CASE WHEN created_at >= {_ago(30)} THEN '1. ate 30d' WHEN created_at >= {_ago(90)} THEN '2. 31-90d'
            WHEN created_at >= {_ago(180)} THEN '3. 91-180d' ELSE '4. +180d' END AS age_band,
       CAST(SUM(total_amount) AS DECIMAL(18,2)) AS value, COUNT(*) AS quotes
FROM quotes WHERE excluded_at IS NULL AND {_QW} AND detailed_status = 1 GROUP BY 1""", "quotes"))
def q_quote_ageing(spark, sf):
    return SA.quote_ageing(DriverTables(spark, sf).quotes, NOW)


@register("quote_stalled", with_views(f"""
SELECT q.quote_number, COALESCE(p.partner_name, CAST(q.partner_code AS VARCHAR)) AS client,
       CAST(date_diff('day', CAST(q.created_at AS DATE), DATE '{REF}') AS INTEGER) AS days_stalled, q.total_amount AS value
FROM quotes q LEFT JOIN partner p ON p.partner_code = q.partner_code
WHERE q.excluded_at IS NULL AND q.detailed_status = 1 AND q.created_at < {_ago(180)} AND q.{_QW}
ORDER BY value DESC, q.quote_number LIMIT 20""", "quotes", "partner"))
def q_quote_stalled(spark, sf):
    T = DriverTables(spark, sf)
    return SA.quote_stalled(T.quotes, T.partner, NOW)
