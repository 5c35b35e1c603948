"""Registered targets / calendar / ranking / performance queries (A-COM-28..36)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.operators import commercial as com
from lakeops.operators import sales as SA
from lakeops.operators import targets as TG
from lakeops.plans import sqlfrag as S
from lakeops.plans.oracle_views import values, with_views
from lakeops.plans.registry import register
from lakeops.plans.sales_q import CHANNEL_SQL, DS
from lakeops.sources.driver import SALES_REF, DriverTables, dec, money

MONTH = "2001-07-01"
REF_DAY = "2001-07-20"
CRM_MONTH, CRM_DAY = "2024-01-01", "2024-01-15"


def _T(spark, sf):
    return DriverTables(spark, sf)


def _holidays(spark):
    return spark.createDataFrame([(h,) for h in TG.HOLIDAYS_2001], "holiday string")


HOL_SQL = values([(h,) for h in TG.HOLIDAYS_2001], ["holiday"])


def _ds(T):
    return SA.dashboard_sales(T.sales_order, T.nature)


def _targets(T):
    """Monthly targets of 2001 per view: last year's same-month revenue + 10 %."""
    ds = _ds(T).where(F.year("invoice_date") == 2000)
    r = ds.rollup("month", F.col("channel").alias("view_key")).agg(F.sum("product_amount").alias("r"),
                                                                    F.grouping_id().alias("_g"))
    u = r.where(F.col("_g") != 3).select(
        "month", F.when(F.col("_g") == 1, F.lit("GERAL")).otherwise(F.col("view_key")).alias("view_key"), "r")
    return u.select(F.add_months("month", 12).alias("month"), "view_key", money(F.col("r") * dec("1.10")).alias("target"))


TARGETS_SQL = f"""SELECT CAST(month + INTERVAL 12 MONTH AS DATE) AS month, view_key, CAST(r * 1.10 AS DECIMAL(18,2)) AS target FROM (
  SELECT month, channel AS view_key, SUM(product_amount) AS r FROM ds WHERE year(invoice_date) = 2000 GROUP BY 1, 2
  UNION ALL SELECT month, 'GERAL', SUM(product_amount) FROM ds WHERE year(invoice_date) = 2000 GROUP BY 1)"""


def _bd_sql(months_sql: str, ref: str | None) -> str:
    el = (f", COUNT(CASE WHEN bd AND day <= DATE '{ref}' THEN 1 END) AS elapsed,"
          f" greatest(COUNT(CASE WHEN bd THEN 1 END) - COUNT(CASE WHEN bd AND day <= DATE '{ref}' THEN 1 END), 1) AS remaining") if ref else ""
    return f"""SELECT month, COUNT(CASE WHEN bd THEN 1 END) AS total{el} FROM (
  SELECT d.month, d.day, (dayofweek(d.day) BETWEEN 1 AND 5 AND h.holiday IS NULL) AS bd FROM (
    SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM ({months_sql}) m) d
  LEFT JOIN (SELECT CAST(holiday AS DATE) AS holiday FROM ({HOL_SQL})) h ON h.holiday = d.day) x GROUP BY month"""


@register("business_days", with_views(f"WITH {DS}\n" + _bd_sql("SELECT DISTINCT month FROM ds WHERE year(month) = 2001", REF_DAY),
                                      "sales_order", "nature"))
def q_bdays(spark, sf):
    T = _T(spark, sf)
    months = _ds(T).where(F.year("month") == 2001).select("month").distinct()
    return TG.business_days(months, _holidays(spark), REF_DAY)


TVA_SQL = f"""WITH {DS}, tg AS ({TARGETS_SQL}),
real AS (SELECT channel AS view_key, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS realised FROM ds WHERE month = DATE '{MONTH}' GROUP BY 1
         UNION ALL SELECT 'GERAL', CAST(SUM(product_amount) AS DECIMAL(18,2)) FROM ds WHERE month = DATE '{MONTH}'),
t AS (SELECT view_key, target FROM tg WHERE month = DATE '{MONTH}'),
j AS (SELECT COALESCE(t.view_key, real.view_key) AS view_key, CAST(COALESCE(real.realised, 0) AS DECIMAL(18,2)) AS realised, t.target
      FROM t FULL OUTER JOIN real ON real.view_key = t.view_key)
SELECT view_key, realised, target, CAST(realised AS DOUBLE) * 100.0 / NULLIF(CAST(target AS DOUBLE), 0) AS pct,
       CAST(target - realised AS DECIMAL(18,2)) AS gap FROM j"""


def _tva(T):
    return TG.target_vs_actual(_ds(T), _targets(T), MONTH)


@register("target_vs_actual", with_views(TVA_SQL, "sales_order", "nature"))
def q_tva(spark, sf):
    return _tva(_T(spark, sf))


@register("rank_month", with_views(f"""SELECT *, CAST(row_number() OVER (ORDER BY pct DESC NULLS LAST, realised DESC, view_key) AS INTEGER) AS position
FROM ({TVA_SQL}) x""", "sales_order", "nature"))
def q_rank_month(spark, sf):
    return TG.rank_month(_tva(_T(spark, sf)))


@register("needed_per_day", with_views(f"""WITH {DS}, b AS ({_bd_sql(f"SELECT DATE '{MONTH}' AS month", REF_DAY)})
SELECT v.view_key, v.target, v.realised,
       CAST(v.target AS DOUBLE) / NULLIF(CAST(b.total AS DOUBLE), 0) * CAST(b.elapsed AS DOUBLE) AS expected,
       CAST(greatest(v.target - v.realised, 0) AS DOUBLE) / CAST(greatest(b.total - b.elapsed + 1, 1) AS DOUBLE) AS needed_per_day
FROM ({TVA_SQL.replace(f"WITH {DS}, ", "WITH ")}) v, b""", "sales_order", "nature"))
def q_needed(spark, sf):
    T = _T(spark, sf)
    months = _ds(T).where(F.col("month") == F.lit(MONTH).cast("date")).select("month").distinct()
    return TG.needed_per_day(_tva(T), TG.business_days(months, _holidays(spark), REF_DAY), MONTH)


@register("won_by_owner", with_views(f"""
SELECT d.owner_id AS user_id,
       CAST(COALESCE(SUM(CASE WHEN date_trunc('month', CAST(won_time AS DATE)) = DATE '{CRM_MONTH}' THEN value END), 0) AS DECIMAL(18,2)) AS won_month,
       CAST(COALESCE(SUM(CASE WHEN CAST(won_time AS DATE) = DATE '{CRM_DAY}' THEN value END), 0) AS DECIMAL(18,2)) AS won_day,
       u.user_name
FROM deals d LEFT JOIN crm_users u ON u.user_id = d.owner_id
WHERE NOT COALESCE(is_deleted, FALSE) AND status = 'won' GROUP BY d.owner_id, u.user_name""", "deals", "crm_users"))
def q_won_owner(spark, sf):
    T = _T(spark, sf)
    return TG.won_by_owner(T.deals, T.crm_users, CRM_MONTH, CRM_DAY)


def _sdiv(a, b):
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


RATES_SQL = f"""SELECT owner_id AS user_id,
  {_sdiv("SUM(CASE WHEN status = 'won' THEN value END)", "COUNT(CASE WHEN status = 'won' THEN 1 END)")} AS ticket,
  {_sdiv("COUNT(CASE WHEN status = 'won' THEN 1 END)", "COUNT(CASE WHEN status IN ('won', 'lost') THEN 1 END)")} AS close_rate,
  {_sdiv("COUNT(CASE WHEN stage_id >= 4 THEN 1 END)", "COUNT(*)")} AS negotiation_rate,
  {_sdiv("COUNT(CASE WHEN stage_id >= 3 THEN 1 END)", "COUNT(*)")} AS quote_rate,
  {_sdiv("COUNT(CASE WHEN stage_id >= 2 THEN 1 END)", "COUNT(*)")} AS connection_rate,
  {_sdiv("COUNT(CASE WHEN stage_id >= 1 THEN 1 END)", "COUNT(*)")} AS contact_rate,
  CAST(COALESCE(SUM(CASE WHEN status = 'won' THEN value END), 0) AS DECIMAL(18,2)) AS won
FROM deals WHERE NOT COALESCE(is_deleted, FALSE) GROUP BY owner_id"""


def _rf_sql():
    cols = ["ticket"] + TG.RATE_CHAIN
    co = ", ".join(f"COALESCE(r0.{c}, m.m_{c}) AS {c}" for c in cols)
    ms = ", ".join(f"AVG({c}) AS m_{c}" for c in cols)
    steps, prev = [], "sales"
    for rate, step in zip(TG.RATE_CHAIN, TG.FUNNEL_STEPS):
        steps.append((step, f"COALESCE({prev} / NULLIF({rate}, 0), 0.0)"))
        prev = step
    sql = f"""WITH r0 AS ({RATES_SQL}), m AS (SELECT {ms} FROM r0),
t AS (SELECT user_id, CAST(won * 1.5 AS DECIMAL(18,2)) AS target FROM r0),
r AS (SELECT r0.user_id, t.target, r0.won, {co} FROM r0 JOIN t ON t.user_id = r0.user_id CROSS JOIN m),
s0 AS (SELECT *, CAST(greatest(target - won, 0) AS DOUBLE) AS remaining FROM r),
s1 AS (SELECT *, COALESCE(remaining / NULLIF(ticket, 0), 0.0) AS sales FROM s0)"""
    prevname = "s1"
    for i, (step, expr) in enumerate(steps):
        sql += f",\ns{i + 2} AS (SELECT *, {expr} AS {step} FROM {prevname})"
        prevname = f"s{i + 2}"
    sel = ", ".join(["user_id", "target", "won", "remaining", "ticket", *TG.RATE_CHAIN, "sales", *TG.FUNNEL_STEPS, "contacts / 22.0 AS contacts_per_day"])
    return sql + f"\nSELECT {sel} FROM {prevname}"


@register("reverse_funnel", with_views(_rf_sql(), "deals"))
def q_reverse_funnel(spark, sf):
    T = _T(spark, sf)
    r = TG.owner_rates(T.deals)
    t = r.select("user_id", money(F.col("won") * dec("1.5")).alias("target"))
    return TG.reverse_funnel(r, t)


@register("reverse_funnel_families", with_views(f"""
WITH g AS (SELECT CASE user_id % 3 WHEN 0 THEN 'HOSPITALAR' WHEN 1 THEN 'FARMACIAS' ELSE 'SAC' END AS rfv_familia, ROUND(SUM(remaining), 6) AS remaining,
             ROUND(SUM(sales), 6) AS sales, ROUND(SUM(quotes), 6) AS quotes, ROUND(SUM(contacts), 6) AS contacts,
             ROUND(SUM(contacts_per_day), 6) AS contacts_per_day, COUNT(*) AS people FROM ({_rf_sql()}) f GROUP BY 1)
SELECT *, COALESCE(remaining / NULLIF(sales, 0), 0.0) AS ticket, COALESCE(sales / NULLIF(quotes, 0), 0.0) AS sales_per_quote,
       COALESCE(quotes / NULLIF(contacts, 0), 0.0) AS quotes_per_contact FROM g""", "deals"))
def q_reverse_funnel_families(spark, sf):
    T = _T(spark, sf)
    r = TG.owner_rates(T.deals)
    f = TG.reverse_funnel(r, r.select("user_id", money(F.col("won") * dec("1.5")).alias("target")))
    fam = F.when(F.col("user_id") % 3 == 0, "HOSPITALAR").when(F.col("user_id") % 3 == 1, "FARMACIAS").otherwise("SAC")
    return TG.reverse_funnel_families(f, T.crm_users.select("user_id", fam.alias("rfv_familia")))


@register("rank_salespeople", with_views(f"""
WITH f AS (SELECT o.* FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N'),
erp AS (SELECT salesperson_name, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS realised FROM f
        WHERE salesperson_group_code IN ('FA', 'FR', 'PC') AND invoice_date BETWEEN DATE '{MONTH}' AND last_day(DATE '{MONTH}')
          AND salesperson_name IS NOT NULL AND trim(salesperson_name) <> '' GROUP BY 1),
d AS (SELECT u.salesperson_name, CAST(l.won_time AS DATE) AS day, l.value FROM deals l JOIN crm_users u ON u.user_id = l.owner_id
      WHERE NOT COALESCE(is_deleted, FALSE) AND status = 'won'),
c AS (SELECT salesperson_name, SUM(value) FILTER (day BETWEEN DATE '{CRM_MONTH}' AND last_day(DATE '{CRM_MONTH}')) AS wm,
             SUM(value) FILTER (day = DATE '{CRM_DAY}') AS wd FROM d GROUP BY 1),
tg AS (SELECT salesperson_name, CAST(SUM(product_amount) * 1.1 AS DECIMAL(18,2)) AS target FROM f
       WHERE invoice_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30' AND salesperson_name <> 'SELLER 3' GROUP BY 1),
j AS (SELECT erp.salesperson_name, erp.realised, CAST(COALESCE(c.wm, 0) AS DECIMAL(18,2)) AS won_month, CAST(COALESCE(c.wd, 0) AS DECIMAL(18,2)) AS won_today,
             tg.target, CAST(tg.target AS DOUBLE) / 22.0 AS daily_target
      FROM erp LEFT JOIN c ON c.salesperson_name = erp.salesperson_name LEFT JOIN tg ON tg.salesperson_name = erp.salesperson_name),
k AS (SELECT *, CAST(realised AS DOUBLE) / CAST(target AS DOUBLE) AS pct, CAST(won_month AS DOUBLE) / CAST(target AS DOUBLE) AS pct_won,
             CASE WHEN daily_target IS NOT NULL THEN greatest(daily_target - CAST(won_today AS DOUBLE), 0.0) END AS missing_today,
             CAST(won_today AS DOUBLE) >= daily_target AS met_today, CAST(won_today AS DOUBLE) / daily_target AS pct_today FROM j)
SELECT *, CAST(row_number() OVER (ORDER BY pct DESC NULLS LAST, realised DESC, salesperson_name) AS INTEGER) AS position,
       CAST(row_number() OVER (ORDER BY pct_today DESC NULLS LAST, salesperson_name) AS INTEGER) AS position_today FROM k""",
                                         "sales_order", "nature", "deals", "crm_users"))
def q_rank_salespeople(spark, sf):
    T = _T(spark, sf)
    before = com.in_months(com.billed_orders(T.sales_order, T.nature, exclude_channels=(), statuses=None), "invoice_date", F.lit("2001-06-01").cast("date"))
    # one seller has no target
    goals = before.where("salesperson_name != 'SELLER 3'").groupBy("salesperson_name").agg(money(F.sum("product_amount") * dec("1.1")).alias("target"))
    months = T.deals.select(F.trunc(F.col("add_time").cast("date"), "month").alias("month")).distinct().where(F.col("month") == F.lit(CRM_MONTH).cast("date"))
    days = TG.business_days(months, spark.createDataFrame([("2024-01-01",)], "holiday string"))
    return TG.rank_salespeople(T.sales_order, T.nature, T.deals, T.crm_users.select("user_id", "salesperson_name"), goals, days, CRM_MONTH, CRM_DAY, erp_month=MONTH)


@register("mean_term", with_views("""
SELECT salesperson_name, CAST(date_trunc('month', invoice_date) AS DATE) AS month,
       CAST(SUM(payment_term_days * product_amount) AS DOUBLE) / NULLIF(CAST(SUM(product_amount) AS DOUBLE), 0) AS mean_term_days,
       CAST(SUM(product_amount) AS DECIMAL(18,2)) AS value
FROM sales_order WHERE invoice_date IS NOT NULL GROUP BY 1, 2""", "sales_order"))
def q_mean_term(spark, sf):
    return TG.mean_term(_T(spark, sf).sales_order)


# the driver's activity types stand in for the CRM's
_KINDS = {"calls": ["purchase"], "meetings": ["view"], "proposals": ["click"], "follow_ups": ["signup", "error"]}


def _indicators(T):
    users = T.crm_users.where("is_active").select("user_id", "salesperson_name")
    before = com.in_months(com.billed_orders(T.sales_order, T.nature, exclude_channels=(), statuses=None), "invoice_date", F.lit("2001-06-01").cast("date"))
    goals = before.groupBy("salesperson_name").agg(money(F.sum("product_amount") * dec("1.1")).alias("target"))
    return TG.performance_indicators(T.deals, T.activities, T.sales_order, T.nature, users, goals, CRM_MONTH, erp_month=MONTH, kinds=_KINDS)


_PERF_COLS = TG.EFFORT + TG.RESULT


def _perf_sql():
    mm = ", ".join(f"MIN({c}) AS mn_{c}, MAX({c}) AS mx_{c}" for c in _PERF_COLS)
    sc = []
    for c in _PERF_COLS:
        v, lo, hi = f"CAST(i.{c} AS DOUBLE)", f"CAST(mm.mn_{c} AS DOUBLE)", f"CAST(mm.mx_{c} AS DOUBLE)"
        e = f"CASE WHEN {v} IS NULL THEN NULL WHEN {hi} = {lo} THEN 50.0 ELSE ({v} - {lo}) / ({hi} - {lo}) * 100.0 END"
        if c == "cycle_days":
            e = f"CASE WHEN ({e}) IS NULL THEN NULL ELSE 100.0 - ({e}) END"
        sc.append(f"{e} AS score_{c}")

    def mean(cs):
        num = " + ".join(f"COALESCE(score_{c}, 0.0)" for c in cs)
        den = " + ".join(f"CAST(score_{c} IS NOT NULL AS INTEGER)" for c in cs)
        return f"({num}) / NULLIF(CAST(({den}) AS DOUBLE), 0)"

    month = f"BETWEEN DATE '{CRM_MONTH}' AND last_day(DATE '{CRM_MONTH}')"
    fin = "FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N' WHERE o.invoice_date"
    return f"""WITH u AS (SELECT user_id, salesperson_name FROM crm_users WHERE is_active),
d AS (SELECT u.salesperson_name, l.*, CAST(won_time AS DATE) AS wd, CAST(lost_time AS DATE) AS ld, CAST(add_time AS DATE) AS ad
      FROM deals l JOIN u ON u.user_id = l.owner_id WHERE NOT COALESCE(is_deleted, FALSE)),
dd AS (SELECT salesperson_name, COUNT(*) FILTER (ad {month}) AS opportunities,
              CAST(COALESCE(SUM(value) FILTER (ad {month}), 0) AS DECIMAL(18,2)) AS pipeline,
              COUNT(*) FILTER (status = 'won' AND wd {month}) AS w, COUNT(*) FILTER (status = 'lost' AND ld {month}) AS l,
              CAST(COALESCE(SUM(value) FILTER (status = 'won' AND wd {month}), 0) AS DECIMAL(18,2)) AS contracted,
              AVG(date_diff('day', ad, COALESCE(wd, ld))) FILTER (status IN ('won', 'lost') AND COALESCE(wd, ld) {month}) AS cycle_days
       FROM d GROUP BY 1),
aa AS (SELECT salesperson_name, COUNT(*) FILTER (type = 'purchase' AND done) AS calls, COUNT(*) FILTER (type = 'view' AND done) AS meetings,
              COUNT(*) FILTER (type = 'click' AND done) AS proposals, COUNT(*) FILTER (type IN ('signup', 'error') AND done) AS follow_ups,
              COUNT(*) AS activities
       FROM activities a JOIN u ON u.user_id = a.user_id WHERE due_date {month} GROUP BY 1),
ee AS (SELECT salesperson_name, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS realised, COUNT(*) AS n {fin} BETWEEN DATE '{MONTH}' AND last_day(DATE '{MONTH}')
         AND o.salesperson_group_code IN ('FA', 'FR', 'PC') GROUP BY 1),
tg AS (SELECT salesperson_name, CAST(SUM(product_amount) * 1.1 AS DECIMAL(18,2)) AS target {fin} BETWEEN DATE '2001-06-01' AND DATE '2001-06-30' GROUP BY 1),
i AS (SELECT tg.salesperson_name, tg.target, COALESCE(calls, 0) AS calls, COALESCE(meetings, 0) AS meetings, COALESCE(proposals, 0) AS proposals,
             COALESCE(follow_ups, 0) AS follow_ups, COALESCE(activities, 0) AS activities, COALESCE(opportunities, 0) AS opportunities, cycle_days,
             CAST(COALESCE(realised, 0) AS DECIMAL(18,2)) AS realised, CAST(COALESCE(contracted, 0) AS DECIMAL(18,2)) AS contracted,
             least(CAST(COALESCE(realised, 0) AS DOUBLE) / CAST(tg.target AS DOUBLE), 1.5) * 100.0 AS attainment,
             CAST(COALESCE(pipeline, 0) AS DECIMAL(18,2)) AS pipeline,
             CASE WHEN w + l > 0 THEN CAST(w AS DOUBLE) * 100.0 / CAST(w + l AS DOUBLE) ELSE 0.0 END AS win_rate,
             CASE WHEN n > 0 THEN CAST(realised AS DOUBLE) / CAST(n AS DOUBLE) ELSE 0.0 END AS ticket
      FROM tg LEFT JOIN aa ON aa.salesperson_name = tg.salesperson_name LEFT JOIN dd ON dd.salesperson_name = tg.salesperson_name
      LEFT JOIN ee ON ee.salesperson_name = tg.salesperson_name WHERE tg.target > 0),
mm AS (SELECT {mm} FROM i),
s AS (SELECT i.*, {", ".join(sc)} FROM i, mm),
s2 AS (SELECT *, {mean(TG.EFFORT)} AS effort_score, {mean(TG.RESULT)} AS result_score FROM s)
SELECT *, CASE WHEN effort_score >= 50 AND result_score >= 50 THEN 'Alta Performance' WHEN result_score >= 50 THEN 'Futuro Talento'
               WHEN effort_score >= 50 THEN 'Esforço Ineficiente' ELSE 'Baixa Entrega' END AS quadrant
FROM s2"""


@register("performance_matrix", with_views(_perf_sql(), "deals", "activities", "crm_users", "sales_order", "nature"))
def q_perf(spark, sf):
    return TG.performance_matrix(_indicators(_T(spark, sf)))


# what the calendar counts: financial natures, by one date or the other
_FIN = "FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N'"
_IN_MONTH = f">= DATE '{MONTH}' AND o.{{d}} < CAST(DATE '{MONTH}' + INTERVAL 1 MONTH AS DATE)"
_DAYS_SQL = f"""SELECT d.day, (dayofweek(d.day) BETWEEN 1 AND 5 AND h.holiday IS NULL) AS is_business_day FROM (
           SELECT CAST(unnest(generate_series(DATE '{MONTH}', last_day(DATE '{MONTH}'), INTERVAL 1 DAY)) AS DATE) AS day) d
         LEFT JOIN (SELECT CAST(holiday AS DATE) AS holiday FROM ({HOL_SQL})) h ON h.holiday = d.day"""
_GOAL = f"SELECT CAST(MAX(target) AS DOUBLE) AS t FROM tg WHERE month = DATE '{MONTH}' AND view_key = 'GERAL'"


def _month_target(T):
    return _targets(T).where((F.col("month") == F.lit(MONTH).cast("date")) & (F.col("view_key") == "GERAL"))


@register("sales_calendar", with_views(f"""WITH {DS}, tg AS ({TARGETS_SQL}), days AS ({_DAYS_SQL}),
rev AS (SELECT o.order_date AS day, CAST(SUM(o.product_amount) AS DECIMAL(18,2)) AS revenue {_FIN}
        WHERE o.order_date {_IN_MONTH.format(d='order_date')} GROUP BY 1),
nb AS (SELECT CAST(COUNT(*) FILTER (is_business_day) AS DOUBLE) AS bd FROM days), t AS ({_GOAL}),
o AS (SELECT days.day, CAST(floor((day(days.day) + dayofweek(DATE '{MONTH}') - 1) / 7) AS INTEGER) + 1 AS week,
             CAST(dayofweek(days.day) AS INTEGER) AS weekday, days.is_business_day, CAST(COALESCE(rev.revenue, 0) AS DECIMAL(18,2)) AS revenue,
             CASE WHEN t.t > 0 THEN t.t / NULLIF(nb.bd, 0) END AS daily_target
      FROM days LEFT JOIN rev ON rev.day = days.day, nb, t)
SELECT *, CAST(SUM(revenue) OVER (PARTITION BY week) AS DECIMAL(18,2)) AS week_total, CAST(revenue AS DOUBLE) >= daily_target AS hit FROM o""",
                                      "sales_order", "nature"))
def q_sales_calendar(spark, sf):
    T = _T(spark, sf)
    return TG.sales_calendar(T.sales_order, T.nature, _holidays(spark), MONTH, _month_target(T))


@register("sales_calendar_totals", with_views(f"""WITH {DS}, tg AS ({TARGETS_SQL}), days AS ({_DAYS_SQL}),
s AS (SELECT CAST(COALESCE(SUM(o.product_amount), 0) AS DECIMAL(18,2)) AS sold {_FIN} WHERE o.order_date {_IN_MONTH.format(d='order_date')}),
i AS (SELECT CAST(COALESCE(SUM(o.product_amount), 0) AS DECIMAL(18,2)) AS invoiced {_FIN} WHERE o.invoice_date {_IN_MONTH.format(d='invoice_date')}),
b AS (SELECT COUNT(*) FILTER (is_business_day) AS business_days, COUNT(*) FILTER (is_business_day AND day <= DATE '{REF_DAY}') AS elapsed FROM days),
t AS ({_GOAL}),
j AS (SELECT sold, invoiced, business_days, elapsed, CASE WHEN t.t > 0 THEN t.t ELSE 0.0 END AS target,
             greatest(business_days - elapsed, 0) AS days_left FROM s, i, b, t),
k AS (SELECT *, greatest(target - CAST(sold AS DOUBLE), 0.0) AS remaining FROM j)
SELECT sold, invoiced, business_days, elapsed, target, COALESCE(target / NULLIF(CAST(business_days AS DOUBLE), 0), 0.0) AS daily_target,
       COALESCE(CAST(sold AS DOUBLE) / NULLIF(target, 0), 0.0) AS reached, days_left, remaining,
       COALESCE(remaining / NULLIF(CAST(days_left AS DOUBLE), 0), 0.0) AS remaining_per_day,
       CASE WHEN elapsed > 0 THEN CAST(sold AS DOUBLE) / elapsed * business_days ELSE CAST(sold AS DOUBLE) END AS projection,
       CASE WHEN elapsed > 0 THEN CAST(invoiced AS DOUBLE) / elapsed * business_days ELSE CAST(invoiced AS DOUBLE) END AS invoiced_projection
FROM k""", "sales_order", "nature"))
def q_sales_calendar_totals(spark, sf):
    T = _T(spark, sf)
    return TG.sales_calendar_totals(T.sales_order, T.nature, _holidays(spark), MONTH, _month_target(T), REF_DAY)


@register("revenue_matrix", with_views(f"""WITH {DS},
g AS (SELECT year(invoice_date) AS year, month(invoice_date) AS month, SUM(product_amount) AS r FROM ds
      WHERE invoice_date >= DATE '1998-01-01' AND invoice_date < DATE '2002-01-01' GROUP BY 1, 2),
m AS (SELECT y.year, mo.month, CAST(COALESCE(g.r, 0) AS DECIMAL(18,2)) AS revenue FROM range(1998, 2002) y(year), range(1, 13) mo(month)
      LEFT JOIN g ON g.year = y.year AND g.month = mo.month),
c AS (SELECT *, CAST(SUM(revenue) OVER (PARTITION BY year ORDER BY month ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS cumulative,
             CAST(SUM(revenue) OVER (PARTITION BY year) AS DECIMAL(18,2)) AS year_total, MAX(revenue > 0) OVER (PARTITION BY year) AS some FROM m),
j AS (SELECT c.*, p.revenue AS pr, p.cumulative AS pc, p.year_total AS py, p.some AS has_yoy FROM c JOIN c p ON p.year + 1 = c.year AND p.month = c.month)
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, revenue, cumulative, year_total, has_yoy,
       CASE WHEN has_yoy THEN CAST(revenue AS DOUBLE) / NULLIF(CAST(pr AS DOUBLE), 0) - 1.0 END AS yoy_month,
       CASE WHEN has_yoy THEN CAST(cumulative AS DOUBLE) / NULLIF(CAST(pc AS DOUBLE), 0) - 1.0 END AS yoy_cumulative,
       CAST(year_total AS DOUBLE) / NULLIF(CAST(py AS DOUBLE), 0) - 1.0 AS yoy_total,
       (year > 2001 OR (year = 2001 AND month > 8)) AS future
FROM j WHERE year IN (1999, 2000, 2001)""", "sales_order", "nature"))
def q_revenue_matrix(spark, sf):
    return TG.revenue_matrix(_ds(_T(spark, sf)), [1999, 2000, 2001], SALES_REF)


# business days between an order and its invoice, both ways, by listing the days of the span
@register("order_business_days", with_views(f"""WITH h AS (SELECT CAST(holiday AS DATE) AS holiday FROM ({HOL_SQL})),
span AS (SELECT min(least(order_date, invoice_date)) AS lo, max(greatest(order_date, invoice_date)) AS hi FROM sales_order),
d AS (SELECT CAST(unnest(generate_series(lo, hi + 2, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
cum AS (SELECT day, SUM(CASE WHEN dayofweek(day) BETWEEN 1 AND 5 AND day NOT IN (SELECT holiday FROM h) THEN 1 ELSE 0 END)
                    OVER (ORDER BY day) AS upto FROM d),
c AS (SELECT day, upto, COALESCE(lag(upto) OVER (ORDER BY day), 0) AS before FROM cum)
SELECT o.order_number, o.order_date, o.invoice_date,
       CAST(CASE WHEN o.invoice_date >= o.order_date THEN i.before - s.before ELSE i.upto - s.upto END AS BIGINT) AS days_to_invoice,
       CAST(CASE WHEN o.order_date >= o.invoice_date THEN s.before - i.before ELSE s.upto - i.upto END AS BIGINT) AS days_back
FROM sales_order o LEFT JOIN c s ON s.day = o.order_date LEFT JOIN c i ON i.day = o.invoice_date""", "sales_order"))
def q_order_business_days(spark, sf):
    o, a, b = _T(spark, sf).sales_order, F.col("order_date"), F.col("invoice_date")
    return o.select("order_number", a, b, TG.busday_count(a, b, TG.HOLIDAYS_2001).alias("days_to_invoice"), TG.busday_count(b, a, TG.HOLIDAYS_2001).alias("days_back"))


# business days after and before the order date, by numbering the business days
@register("order_due_days", with_views(f"""WITH h AS (SELECT CAST(holiday AS DATE) AS holiday FROM ({HOL_SQL})),
span AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM sales_order),
d AS (SELECT CAST(unnest(generate_series(lo - 40, hi + 40, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
b AS (SELECT day, dayofweek(day) BETWEEN 1 AND 5 AND day NOT IN (SELECT holiday FROM h) AS open FROM d),
k AS (SELECT day, open, SUM(CASE WHEN open THEN 1 ELSE 0 END) OVER (ORDER BY day) - CASE WHEN open THEN 1 ELSE 0 END AS k FROM b),
o AS (SELECT s.order_number, s.order_date, k.k FROM sales_order s LEFT JOIN k ON k.day = s.order_date)
SELECT o.order_number, o.order_date, z.day AS opens, d.day AS due, r.day AS remind
FROM o LEFT JOIN k z ON z.open AND z.k = o.k LEFT JOIN k d ON d.open AND d.k = o.k + 10 LEFT JOIN k r ON r.open AND r.k = o.k - 3""", "sales_order"))
def q_order_due_days(spark, sf):
    day, off = F.col("order_date"), TG.HOLIDAYS_2001
    return _T(spark, sf).sales_order.select("order_number", day, TG.add_busdays(day, 0, off).alias("opens"), TG.add_busdays(day, 10, off).alias("due"),
                                            TG.add_busdays(day, -3, off).alias("remind"))
