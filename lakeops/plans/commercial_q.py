"""Registered commercial queries (RFV chain) over the driver tables."""

from __future__ import annotations

from lakeops.operators import commercial as com
from lakeops.plans import sqlfrag as S
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import SALES_REF, DriverTables

REF = SALES_REF
HIST_REFS = com.month_end_refs("2000-08-31", 12)
SALES_VIEWS = ("sales_order", "nature", "group_family", "portfolio")


def _sales(T: DriverTables, ref=REF, months=12):
    return com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, ref, lookback_months=months)


@register("billed_orders", with_views(S.billed(), "sales_order", "nature"))
def q_billed(spark, sf):
    T = DriverTables(spark, sf)
    return com.billed_orders(T.sales_order, T.nature).select(*T.sales_order.columns)


@register("silver_sales", with_views(S.silver_sales(REF), *SALES_VIEWS))
def q_silver_sales(spark, sf):
    return _sales(DriverTables(spark, sf))


@register("rfv_base", with_views(S.rfv_base_from(S.silver_sales(REF), S.ref_date(REF)), *SALES_VIEWS))
def q_rfv_base(spark, sf):
    return com.rfv_base(_sales(DriverTables(spark, sf)), REF)


@register("rfv_score", with_views(S.rfv_score(REF), *SALES_VIEWS))
def q_rfv_score(spark, sf):
    return com.rfv_score(com.rfv_base(_sales(DriverTables(spark, sf)), REF))


def _summary_sql(score_sql: str) -> str:
    return f"""
SELECT ref_date, rfv_familia, rfv_salesperson, segment, segment_num,
       COUNT(DISTINCT partner_name) AS clients,
       CAST(SUM(total_value) AS DECIMAL(18,2)) AS revenue,
       CAST(SUM(total_value) AS DOUBLE) / CAST(COUNT(total_value) AS DOUBLE) AS mean_ticket,
       AVG(frequency) AS mean_frequency,
       AVG(recency_days) AS mean_recency_days
FROM ({score_sql}) s
GROUP BY ref_date, rfv_familia, rfv_salesperson, segment, segment_num"""


@register("rfv_summary", with_views(_summary_sql(S.rfv_score(REF)), *SALES_VIEWS))
def q_rfv_summary(spark, sf):
    return com.rfv_summary(com.rfv_score(com.rfv_base(_sales(DriverTables(spark, sf)), REF)))


@register("rfv_summary_36m", with_views(_summary_sql(S.rfv_score(REF, 36)), *SALES_VIEWS))
def q_rfv_summary_36m(spark, sf):
    return com.rfv_summary(com.rfv_score(com.rfv_base(_sales(DriverTables(spark, sf), REF, 36), REF)))


def _history_sql() -> str:
    refs = ", ".join(f"(DATE '{r}')" for r in HIST_REFS)
    sales = f"""
SELECT s.*, r.ref_date FROM ({S.silver_sales(None)}) s
JOIN (SELECT * FROM (VALUES {refs}) t(ref_date)) r
  ON s.invoice_date >= CAST(date_trunc('month', r.ref_date - INTERVAL 12 MONTH) AS DATE) AND s.invoice_date <= r.ref_date"""
    return S.rfv_score_from(S.rfv_base_from(sales, "ref_date", group_ref=True))


@register("rfv_history", with_views(_history_sql(), *SALES_VIEWS))
def q_rfv_history(spark, sf):
    T = DriverTables(spark, sf)
    sales_all = com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, None)
    return com.rfv_history(sales_all, HIST_REFS)
