"""Reusable DuckDB SQL fragments for the oracle side, generated from the same
parameter lists the Spark operators use."""

from __future__ import annotations

from lakeops import params as P
from lakeops.plans.oracle_views import _lit


def bands(expr: str, bounds, fallback, op: str = "<=") -> str:
    whens = " ".join(f"WHEN {expr} {op} {_lit(b)} THEN {_lit(lbl)}" for b, lbl in bounds)
    return f"CASE {whens} ELSE {_lit(fallback)} END"


def lookup(expr: str, pairs, default=None) -> str:
    whens = " ".join(f"WHEN {expr} = {_lit(k)} THEN {_lit(v)}" for k, v in pairs)
    return f"CASE {whens} ELSE {_lit(default)} END"


def ref_date(ref: str) -> str:
    return f"DATE '{ref}'"


def lookback_start(ref: str, months: int) -> str:
    return f"CAST(date_trunc('month', DATE '{ref}' - INTERVAL {months} MONTH) AS DATE)"


def billed(statuses=tuple(P.BILLED_STATUSES), exclude=tuple(P.EXCLUDED_CHANNELS), date_col="invoice_date",
           include_cancelled=True) -> str:
    cond = [f"o.{date_col} IS NOT NULL"]
    cond += [f"o.channel_code <> {_lit(c)}" for c in exclude]
    if statuses:
        cond.append(f"o.order_status IN ({', '.join(str(s) for s in statuses)})")
    if not include_cancelled:
        cond.append("o.excluded_at IS NULL")
    return (f"SELECT o.* FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N' "
            f"WHERE {' AND '.join(cond)}")


def silver_sales(ref: str | None, months: int = 12, date_col: str = "invoice_date") -> str:
    win = ""
    if ref is not None:
        win = f"WHERE b.{date_col} >= {lookback_start(ref, months)} AND b.{date_col} <= {ref_date(ref)}"
    return f"""
SELECT b.order_number, b.order_date, b.invoice_date, b.partner_code,
       COALESCE(p.partner_name, CAST(b.partner_code AS VARCHAR)) AS partner_name, gf.rfv_familia,
       COALESCE(p.salesperson_name, b.salesperson_name) AS rfv_salesperson,
       b.salesperson_code, b.salesperson_name AS sale_salesperson_name, b.salesperson_group_code,
       b.nature_code, b.company_code, b.product_amount, b.total_amount, b.order_status,
       CAST(year(b.{date_col}) AS INTEGER) AS year, CAST(month(b.{date_col}) AS INTEGER) AS month
FROM ({billed(date_col=date_col)}) b
JOIN group_family gf ON gf.salesperson_group_code = b.salesperson_group_code
LEFT JOIN portfolio p ON p.partner_code = b.partner_code AND p.rfv_familia = gf.rfv_familia AND p.is_active
{win}"""


def rfv_base_from(sales: str, ref_expr: str, date_col: str = "invoice_date", group_ref: bool = False) -> str:
    keys = "partner_name, rfv_familia, rfv_salesperson" + (", ref_date" if group_ref else "")
    rec = f"CAST(date_diff('day', MAX({date_col}), {ref_expr}) AS INTEGER)"
    return f"""
SELECT partner_name, rfv_familia, rfv_salesperson,
       string_agg(DISTINCT CAST(partner_code AS VARCHAR), ',' ORDER BY CAST(partner_code AS VARCHAR)) AS partner_codes,
       MAX({date_col}) AS last_purchase,
       {rec} AS recency_days,
       CAST(ROUND({rec} / 30.0, 6) AS DECIMAL(12,6)) AS recency_months,
       COUNT(DISTINCT order_number) AS frequency,
       CAST(ROUND(SUM(product_amount), 2) AS DECIMAL(18,2)) AS total_value,
       {ref_expr if not group_ref else 'ref_date'} AS ref_date
FROM ({sales}) s
GROUP BY {keys}"""


def rfv_score_from(base: str) -> str:
    fb_d = bands("b.frequency", P.FREQ_BANDS_DEFAULT, P.FREQ_FALLBACK, ">=")
    fb_p = bands("b.frequency", P.FREQ_BANDS_PHARMACY, P.FREQ_FALLBACK, ">=")
    rb = bands("b.recency_days", P.REC_BANDS, P.REC_FALLBACK, "<=")
    rows = P.rfv_matrix_rows()
    num = lookup("x.cell", [(r[0], r[3]) for r in rows], P.SEGMENT_UNKNOWN)
    lbl = lookup("x.cell", [(r[0], r[4]) for r in rows], P.SEGMENT_UNKNOWN_LABEL)
    return f"""
SELECT x.*, {lbl} AS segment, CAST({num} AS INTEGER) AS segment_num FROM (
  SELECT y.*, y.freq_bucket || y.rec_bucket AS cell FROM (
    SELECT b.*,
      CASE WHEN COALESCE(b.rfv_familia, '') LIKE '%{P.PHARMACY_MARKER}%' THEN {fb_p} ELSE {fb_d} END AS freq_bucket,
      {rb} AS rec_bucket
    FROM ({base}) b) y) x"""


def rfv_score(ref: str, months: int = 12) -> str:
    return rfv_score_from(rfv_base_from(silver_sales(ref, months), ref_date(ref)))
