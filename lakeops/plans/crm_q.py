"""Registered CRM / entity-resolution / customer-360 queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.operators import commercial as com
from lakeops.operators import crm
from lakeops.operators import entity as ER
from lakeops.plans.name_sql import weighted_pairs
from lakeops.plans import sqlfrag as S
from lakeops.plans.commercial_q import SALES_VIEWS
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.session import cut_lineage
from lakeops.sources.driver import EVENTS_NOW, SALES_REF, DriverTables

NOW = EVENTS_NOW
REF = SALES_REF
TH = float(P.FUZZY_THRESHOLD)


def _T(spark, sf):
    return DriverTables(spark, sf)


def _mk(x):
    return f"trim(regexp_replace(upper(strip_accents({x})), '[^A-Z0-9]+', ' ', 'g'))"


BRIDGE_SQL = f"""
WITH L AS (SELECT partner_code AS lid, partner_name AS lname_raw, regexp_replace(tax_id, '[^0-9]', '', 'g') AS ltax FROM partner),
R AS (SELECT org_id AS rid, org_name AS rname_raw, regexp_replace(cnpj, '[^0-9]', '', 'g') AS rtax FROM orgs),
tax AS (SELECT lid, lname_raw, rid, rname_raw, 'cnpj_exact' AS match_type, CAST(100.0 AS DOUBLE) AS match_score
        FROM L JOIN R ON L.ltax = R.rtax WHERE length(L.ltax) = {P.TAX_ID_COMPANY_LENGTH} AND length(R.rtax) >= {P.CRM_TAX_ID_MIN_DIGITS}),
rest AS (SELECT *, {_mk('lname_raw')} AS name FROM L WHERE lid NOT IN (SELECT lid FROM tax)),
Rnorm AS (SELECT *, {_mk('rname_raw')} AS name FROM R),
ln AS (SELECT DISTINCT name FROM rest WHERE length(name) >= {P.FUZZY_MIN_LENGTH}),
rn AS (SELECT DISTINCT name FROM Rnorm WHERE length(name) >= {P.FUZZY_MIN_LENGTH}),
{weighted_pairs('ln', 'rn', TH)},
best AS (SELECT lname, rname, score FROM (
           SELECT *, row_number() OVER (PARTITION BY lname ORDER BY score DESC, length(rname), rname DESC) AS k
           FROM sc) WHERE k = 1),
rmin AS (SELECT name AS rname, min(rid) AS rid, arg_min(rname_raw, rid) AS rname_raw FROM Rnorm
         WHERE length(name) >= {P.FUZZY_MIN_LENGTH} GROUP BY name),
fz AS (SELECT rest.lid, rest.lname_raw, rmin.rid, rmin.rname_raw, 'name_fuzzy' AS match_type, best.score AS match_score
       FROM rest JOIN best ON rest.name = best.lname JOIN rmin ON rmin.rname = best.rname
       WHERE length(rest.name) >= {P.FUZZY_MIN_LENGTH}),
m AS (SELECT * FROM tax UNION ALL SELECT * FROM fz),
allr AS (SELECT * FROM m UNION ALL
         SELECT lid, lname_raw, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'unmatched', CAST(NULL AS DOUBLE) FROM L
         WHERE lid NOT IN (SELECT lid FROM m))
SELECT lid AS partner_code, lname_raw AS partner_name, rid AS org_id, rname_raw AS org_name, match_type, match_score FROM allr"""
BRIDGE_VIEWS = ("partner", "orgs")

BEST_SQL = f"""SELECT * EXCLUDE (k) FROM (
  SELECT *, row_number() OVER (PARTITION BY partner_code ORDER BY CASE match_type WHEN 'cnpj_exact' THEN 1
         WHEN 'name_fuzzy' THEN 2 ELSE 3 END, match_score DESC, org_id) AS k
  FROM ({BRIDGE_SQL}) b WHERE match_type <> 'unmatched') WHERE k = 1"""


def _bridge(T):
    return ER.resolve_entities(T.partner, T.orgs)


@register("entity_bridge", with_views(BRIDGE_SQL, *BRIDGE_VIEWS))
def q_bridge(spark, sf):
    return _bridge(_T(spark, sf))


@register("best_bridge", with_views(BEST_SQL, *BRIDGE_VIEWS))
def q_best_bridge(spark, sf):
    return ER.best_bridge(_bridge(_T(spark, sf)))


@register("match_report", with_views(f"""
WITH g AS (SELECT match_type, COUNT(*) AS rows, COUNT(DISTINCT partner_code) AS codes, COUNT(DISTINCT org_id) AS orgs
           FROM ({BRIDGE_SQL}) b GROUP BY 1)
SELECT *, CAST(rows AS DOUBLE) * 100.0 / CAST((SELECT SUM(rows) FROM g) AS DOUBLE) AS pct FROM g""", *BRIDGE_VIEWS))
def q_match_report(spark, sf):
    return ER.match_report(_bridge(_T(spark, sf)))


@register("borderline_matches", with_views(f"""
SELECT * FROM ({BRIDGE_SQL}) b WHERE match_type = 'name_fuzzy' AND match_score < {float(P.FUZZY_REVIEW_BELOW)}""", *BRIDGE_VIEWS))
def q_borderline(spark, sf):
    return ER.borderline(_bridge(_T(spark, sf)))


@register("client_universe", with_views(f"""
SELECT DISTINCT partner_code, 'portfolio' AS origin FROM portfolio
UNION ALL
SELECT DISTINCT partner_code, 'active_24m' FROM sales_order
WHERE invoice_date >= CAST(DATE '{REF}' - INTERVAL 24 MONTH AS DATE) AND partner_code NOT IN (SELECT partner_code FROM portfolio)""",
                                      "portfolio", "sales_order"))
def q_universe(spark, sf):
    T = _T(spark, sf)
    return ER.client_universe(T.portfolio, T.sales_order, REF)


@register("match_list_orgs", with_views(f"""
WITH n AS (SELECT DISTINCT org_name AS input_name, {_mk('org_name')} AS name FROM orgs),
m AS (SELECT partner_code, partner_name, {_mk('partner_name')} AS name FROM partner),
ex AS (SELECT input_name, name, CAST(100.0 AS DOUBLE) AS score, 'exact' AS how FROM n WHERE name IN (SELECT name FROM m)),
rest AS (SELECT * FROM n WHERE input_name NOT IN (SELECT input_name FROM ex)),
ln AS (SELECT DISTINCT name FROM rest WHERE name <> ''), rn AS (SELECT DISTINCT name FROM m WHERE name <> ''),
{weighted_pairs('ln', 'rn', TH)},
best AS (SELECT lname, rname, score FROM (SELECT *, row_number() OVER (PARTITION BY lname ORDER BY score DESC, length(rname), rname DESC) AS k
         FROM sc) WHERE k = 1),
fz AS (SELECT rest.input_name, best.rname AS name, best.score, 'fuzzy' AS how FROM rest JOIN best ON rest.name = best.lname),
u AS (SELECT * FROM ex UNION ALL SELECT * FROM fz)
SELECT u.name, u.input_name, u.score, u.how, m.partner_code FROM u JOIN m ON m.name = u.name""", "orgs", "partner"))
def q_match_list(spark, sf):
    T = _T(spark, sf)
    return ER.match_list(T.orgs.select(F.col("org_name").alias("name")), T.partner)


# -- deals / 360 / alerts ----------------------------------------------------------------

LIVE = "SELECT * FROM deals WHERE NOT COALESCE(is_deleted, FALSE)"
METRICS_SQL = f"""
SELECT org_id, COUNT(*) AS deals_total, COUNT(CASE WHEN status = 'open' THEN 1 END) AS deals_open,
       COUNT(CASE WHEN status = 'won' THEN 1 END) AS deals_won, COUNT(CASE WHEN status = 'lost' THEN 1 END) AS deals_lost,
       CAST(COALESCE(SUM(CASE WHEN status = 'open' THEN value END), 0) AS DECIMAL(18,2)) AS open_value,
       CAST(COALESCE(SUM(CASE WHEN status = 'won' AND won_time >= TIMESTAMP '{NOW}' - INTERVAL {P.WON_LOOKBACK_DAYS} DAY
                               THEN value END), 0) AS DECIMAL(18,2)) AS won_value_12m,
       MAX(add_time) AS last_deal_at, MAX(CASE WHEN status = 'open' THEN expected_close_date END) AS next_close
FROM ({LIVE}) d GROUP BY org_id"""


@register("deal_metrics", with_views(METRICS_SQL, "deals"))
def q_deal_metrics(spark, sf):
    return crm.deal_metrics(_T(spark, sf).deals, NOW)


_SEGN = f"COALESCE(r.segment_num, {P.SEGMENT_UNKNOWN})"
_OPEN = "COALESCE(dm.deals_open, 0)"
_DAYS = f"CAST(date_diff('day', CAST(dm.last_deal_at AS DATE), CAST(TIMESTAMP '{NOW}' AS DATE)) AS INTEGER)"
_VAL = "COALESCE(r.total_value, 0)"


def _in(vals):
    return "(" + ", ".join(str(v) for v in vals) + ")"


C360_SQL = f"""
SELECT c.partner_code, c.partner_name, c.rfv_familia, c.salesperson_name AS rfv_salesperson,
       COALESCE(r.segment, '{P.NO_RFV_LABEL}') AS segment, CAST({_SEGN} AS INTEGER) AS segment_num,
       r.freq_bucket, r.rec_bucket, r.frequency, r.recency_days, CAST({_VAL} AS DECIMAL(18,2)) AS revenue,
       b.org_id, b.org_name, b.match_type AS bridge_match_type,
       COALESCE(dm.deals_total, 0) AS deals_total, {_OPEN} AS deals_open, COALESCE(dm.deals_won, 0) AS deals_won,
       CAST(COALESCE(dm.open_value, 0) AS DECIMAL(18,2)) AS open_value,
       CAST(COALESCE(dm.won_value_12m, 0) AS DECIMAL(18,2)) AS won_value_12m,
       dm.last_deal_at, dm.next_close, {_DAYS} AS days_without_deal,
       ({_SEGN} IN {_in(P.FLAG_OPPORTUNITY_SEGMENTS)} AND {_OPEN} = 0) AS flag_opportunity,
       ({_SEGN} IN {_in(P.FLAG_CHURN_SEGMENTS)} AND {_OPEN} = 0
        AND (dm.last_deal_at IS NULL OR {_DAYS} > {P.FLAG_CHURN_SILENT_DAYS})) AS flag_silent_churn,
       ({_SEGN} IN {_in(P.FLAG_CHURN_SEGMENTS)} AND {_OPEN} > 0) AS flag_recovery,
       ({_SEGN} = {P.FLAG_REACTIVATION_SEGMENT} AND {_VAL} > {P.FLAG_REACTIVATION_MIN_VALUE}) AS flag_reactivation,
       (b.org_id IS NULL) AS flag_off_radar
FROM portfolio c
LEFT JOIN (SELECT * FROM ({S.rfv_score(REF)}) s WHERE ref_date = (SELECT MAX(ref_date) FROM ({S.rfv_score(REF)}) s2)) r
  ON r.partner_name = c.partner_name AND r.rfv_familia = c.rfv_familia
LEFT JOIN ({BEST_SQL}) b ON b.partner_code = c.partner_code
LEFT JOIN ({METRICS_SQL}) dm ON dm.org_id = b.org_id
WHERE c.is_active"""
C360_VIEWS = SALES_VIEWS + BRIDGE_VIEWS + ("deals",)


def _best(T):
    return cut_lineage(ER.best_bridge(_bridge(T)))


def _c360(T, best=None):
    # the score and the bridge are silver tables: written once, then read (the latest date without a second scoring)
    score = cut_lineage(com.rfv_score(com.rfv_base(com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, REF), REF)))
    return crm.customer_360(T.portfolio, score, _best(T) if best is None else best, crm.deal_metrics(T.deals, NOW), NOW)


@register("customer_360", with_views(C360_SQL, *C360_VIEWS))
def q_c360(spark, sf):
    return _c360(_T(spark, sf))


def _msg_sql(tpl):
    fields = {"seg": "segment", "rev": "CAST(CAST(ROUND(revenue, 0) AS DECIMAL(38,0)) AS VARCHAR)",
              "days": "CAST(COALESCE(days_without_deal, 999) AS VARCHAR)", "open": "CAST(deals_open AS VARCHAR)",
              "pipe": "CAST(CAST(ROUND(open_value, 0) AS DECIMAL(38,0)) AS VARCHAR)"}
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", tpl):
        parts.append(S._lit(tpl[pos:m.start()]))
        parts.append(fields[m.group(1)])
        pos = m.end()
    parts.append(S._lit(tpl[pos:]))
    return " || ".join(parts)


def _alerts_sql():
    base = "partner_code, partner_name, rfv_familia, rfv_salesperson, segment, segment_num, revenue"
    sels = []
    for (typ, prio, tpl), flag in zip(P.ALERTS, crm.ALERT_FLAGS):
        if flag == "flag_off_radar":
            sels.append(f"""SELECT {base}, CAST(NULL AS BIGINT) AS org_id, CAST(NULL AS VARCHAR) AS org_name, CAST(0 AS BIGINT) AS deals_open,
       CAST(0 AS DECIMAL(18,2)) AS open_value, CAST(NULL AS INTEGER) AS days_without_deal, '{typ}' AS alert_type,
       {_msg_sql(tpl)} AS message, {prio} AS priority FROM c360 WHERE {flag} AND COALESCE(revenue, 0) > 0""")
        else:
            sels.append(f"""SELECT {base}, org_id, org_name, deals_open, open_value, days_without_deal, '{typ}' AS alert_type,
       {_msg_sql(tpl)} AS message, {prio} AS priority FROM c360 WHERE {flag}""")
    return f"WITH c360 AS ({C360_SQL})\n" + "\nUNION ALL\n".join(sels)


ALERTS_SQL = _alerts_sql()


def _alerts(T, best=None):
    return crm.alerts(_c360(T, best))


@register("alerts", with_views(ALERTS_SQL, *C360_VIEWS))
def q_alerts(spark, sf):
    return _alerts(_T(spark, sf))


@register("alert_digest", with_views(f"""
SELECT alert_type, priority, COUNT(*) AS companies, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue FROM (
  SELECT upper(trim(partner_name)) AS name_norm, alert_type, priority, MAX(revenue) AS revenue FROM ({ALERTS_SQL}) a GROUP BY 1, 2, 3)
GROUP BY 1, 2""", *C360_VIEWS))
def q_alert_digest(spark, sf):
    return crm.alert_digest(_alerts(_T(spark, sf)))


def _lst(c):
    return f"string_agg(DISTINCT CAST({c} AS VARCHAR), ', ' ORDER BY CAST({c} AS VARCHAR))"


@register("alert_detail_off_radar", with_views(f"""
WITH g AS (SELECT upper(trim(partner_name)) AS company, COUNT(DISTINCT partner_code) AS branches,
                  string_agg(DISTINCT rfv_familia, ' + ' ORDER BY rfv_familia) AS families, {_lst('rfv_salesperson')} AS owners,
                  {_lst('segment')} AS segments, MAX(revenue) AS revenue, MAX(deals_open) AS deals_open, MAX(open_value) AS open_value,
                  MIN(days_without_deal) AS days_without_deal, MIN(message) AS message
           FROM ({ALERTS_SQL}) a WHERE alert_type = 'FORA_DO_RADAR_CRM' GROUP BY 1),
k AS (SELECT upper(trim(p.partner_name)) AS company, TRUE AS in_crm, {_lst('b.org_name')} AS crm_names
      FROM ({BEST_SQL}) b JOIN partner p ON p.partner_code = b.partner_code WHERE b.org_id IS NOT NULL AND p.partner_name IS NOT NULL GROUP BY 1)
SELECT g.*, COALESCE(k.in_crm, FALSE) AS in_crm, k.crm_names FROM g LEFT JOIN k ON k.company = g.company""", *C360_VIEWS, "partner"))
def q_alert_detail(spark, sf):
    T = _T(spark, sf)
    best = _best(T)
    known = best.select("partner_code", "org_id", "org_name").join(T.partner.select("partner_code", "partner_name"), "partner_code")
    return crm.alert_detail(_alerts(T, best), known, "FORA_DO_RADAR_CRM")


# the panel's map: owner k of the portfolio is seller k in the CRM; pipelines by family
_PIPELINES = [(1, "HOSPITALAR"), (2, "FARMACIAS"), (3, "SAC")]
_PANEL_SEGS = ", ".join(f"COUNT(DISTINCT partner_name) FILTER (segment_num IN {_in(n)}) AS {c}" for c, n in (
    ("champions", (1,)), ("loyal", (2,)), ("potential_loyal", (3,)), ("cannot_lose", (8,)), ("at_risk", (9, 10)), ("lost", (11,))))


@register("salesperson_panel", with_views(f"""
WITH c AS ({C360_SQL}),
g AS (SELECT rfv_salesperson, rfv_familia, COUNT(DISTINCT partner_name) AS clients, {_PANEL_SEGS},
             CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(18,2)) AS revenue,
             COUNT(DISTINCT partner_name) FILTER (flag_opportunity) AS alerts_opportunity,
             COUNT(DISTINCT partner_name) FILTER (flag_silent_churn) AS alerts_churn,
             COUNT(DISTINCT partner_name) FILTER (flag_off_radar) AS off_radar FROM c GROUP BY 1, 2),
u AS (SELECT user_id, replace(salesperson_name, 'SELLER', 'OWNER') AS owner FROM crm_users),
d AS (SELECT u.owner, CASE pipeline_id WHEN 1 THEN 'HOSPITALAR' WHEN 2 THEN 'FARMACIAS' WHEN 3 THEN 'SAC' END AS fam,
             COUNT(*) FILTER (status = 'open') AS deals_open, COUNT(*) FILTER (status = 'won') AS deals_won,
             CAST(COALESCE(SUM(value) FILTER (status = 'open'), 0) AS DECIMAL(18,2)) AS open_value,
             CAST(COALESCE(SUM(value) FILTER (status = 'won' AND won_time >= TIMESTAMP '{NOW}' - INTERVAL 365 DAY), 0) AS DECIMAL(18,2)) AS won_value_12m
      FROM ({LIVE}) l JOIN u ON u.user_id = l.owner_id GROUP BY 1, 2),
k AS (SELECT u.owner, COUNT(DISTINCT conversation_id) AS calls, CAST(SUM(duration_seconds) AS DOUBLE) / 60.0 AS call_minutes,
             AVG(duration_seconds) / 60.0 AS mean_call_minutes, COUNT(*) FILTER (lower(ai_sentiment) = 'positive') AS positive_calls
      FROM calls JOIN u ON 'U' || CAST(u.user_id AS VARCHAR) = calls.user_key GROUP BY 1)
SELECT g.*, CAST(champions + loyal AS DOUBLE) * 100.0 / NULLIF(CAST(clients AS DOUBLE), 0) AS top_pct,
       CAST(revenue AS DOUBLE) / NULLIF(CAST(clients AS DOUBLE), 0) AS ticket,
       COALESCE(deals_open, 0) AS deals_open, COALESCE(deals_won, 0) AS deals_won,
       CAST(COALESCE(open_value, 0) AS DECIMAL(18,2)) AS open_value, CAST(COALESCE(won_value_12m, 0) AS DECIMAL(18,2)) AS won_value_12m,
       COALESCE(calls, 0) AS calls, COALESCE(call_minutes, 0.0) AS call_minutes, COALESCE(mean_call_minutes, 0.0) AS mean_call_minutes,
       COALESCE(positive_calls, 0) AS positive_calls, CAST(positive_calls AS DOUBLE) * 100.0 / NULLIF(CAST(calls AS DOUBLE), 0) AS positive_pct
FROM g LEFT JOIN d ON d.owner = g.rfv_salesperson AND d.fam = g.rfv_familia LEFT JOIN k ON k.owner = g.rfv_salesperson""", *C360_VIEWS, "calls", "crm_users"))
def q_salesperson_panel(spark, sf):
    T = _T(spark, sf)
    users = T.crm_users.withColumn("salesperson_name", F.regexp_replace("salesperson_name", "SELLER", "OWNER"))
    return crm.salesperson_panel(_c360(T), T.deals, P.table(spark, _PIPELINES, "pipeline_id bigint, rfv_familia string"), T.calls, users, NOW)


@register("deal_stage_health", with_views(f"""
WITH d AS ({LIVE}),
a AS (SELECT pipeline_id, stage_id, status, COUNT(*) AS deals, CAST(SUM(value) AS DECIMAL(18,2)) AS value,
             CAST(SUM(value) AS DOUBLE) / NULLIF(CAST(COUNT(value) AS DOUBLE), 0) AS mean_value,
             AVG(date_diff('day', CAST(stage_change_time AS DATE), CAST(TIMESTAMP '{NOW}' AS DATE))) AS mean_days_in_stage
      FROM d GROUP BY 1, 2, 3),
r AS (SELECT pipeline_id, stage_id, status, lost_reason, COUNT(*) AS n FROM d GROUP BY 1, 2, 3, 4),
t AS (SELECT pipeline_id, stage_id, status, lost_reason AS top_lost_reason FROM (
        SELECT *, row_number() OVER (PARTITION BY pipeline_id, stage_id, status ORDER BY n DESC, lost_reason DESC NULLS LAST) AS k FROM r)
      WHERE k = 1)
SELECT a.*, t.top_lost_reason, s.stage_name, s.order_nr FROM a
JOIN t ON t.pipeline_id = a.pipeline_id AND t.stage_id = a.stage_id AND t.status = a.status
JOIN stages s ON s.stage_id = a.stage_id""", "deals", "stages"))
def q_deal_stage_health(spark, sf):
    T = _T(spark, sf)
    return crm.deal_stage_health(T.deals, T.stages, NOW)


@register("funnel_status", with_views(f"""
SELECT status, COUNT(*) AS deals, CAST(SUM(value) AS DECIMAL(18,2)) AS value FROM ({LIVE}) d GROUP BY 1""", "deals"))
def q_funnel_status(spark, sf):
    return crm.funnel_status(_T(spark, sf).deals)


@register("funnel_kpis", with_views(f"""
WITH d AS (SELECT *, floor((epoch_us(won_time) - epoch_us(add_time)) / 86400000000.0) AS days FROM ({LIVE}) l),
g AS (SELECT COUNT(*) AS deals, COUNT(*) FILTER (status = 'open') AS open, COUNT(*) FILTER (status = 'won') AS won,
             COUNT(*) FILTER (status = 'lost') AS lost,
             CAST(COALESCE(SUM(value) FILTER (status = 'open'), 0) AS DECIMAL(18,2)) AS open_value,
             CAST(COALESCE(SUM(value) FILTER (status = 'won'), 0) AS DECIMAL(18,2)) AS won_value,
             AVG(days) FILTER (status = 'won' AND days BETWEEN 0 AND 365) AS mean_cycle_days FROM d),
p AS (SELECT *, CASE WHEN deals = 0 THEN 0.0 ELSE won * 100.0 / CAST(deals AS DOUBLE) END AS won_pct,
             CASE WHEN won + lost = 0 THEN 0.0 ELSE won * 100.0 / CAST(won + lost AS DOUBLE) END AS win_rate_pct FROM g)
SELECT *, ROUND(CAST(open_value AS DOUBLE) * win_rate_pct / 100.0, 4) AS forecast FROM p""", "deals"))
def q_funnel_kpis(spark, sf):
    return crm.funnel_kpis(_T(spark, sf).deals)


@register("funnel_by_stage", with_views(f"""
SELECT s.order_nr, s.stage_name, COUNT(*) AS deals, CAST(COALESCE(SUM(value), 0) AS DECIMAL(18,2)) AS value
FROM ({LIVE}) d LEFT JOIN stages s ON s.stage_id = d.stage_id WHERE status = 'open' GROUP BY 1, 2""", "deals", "stages"))
def q_funnel_by_stage(spark, sf):
    T = _T(spark, sf)
    return crm.funnel_by_stage(T.deals, T.stages)


@register("top_owners", with_views(f"""
SELECT COALESCE(u.user_name, 'Sem owner') AS user_name, COUNT(*) AS deals, CAST(COALESCE(SUM(value), 0) AS DECIMAL(18,2)) AS value
FROM ({LIVE}) d LEFT JOIN crm_users u ON u.user_id = d.owner_id GROUP BY 1 ORDER BY value DESC, user_name LIMIT 10""", "deals", "crm_users"))
def q_top_owners(spark, sf):
    T = _T(spark, sf)
    return crm.top_owners(T.deals, T.crm_users)


@register("top_open_deals", with_views(f"""
SELECT d.deal_id, d.pipeline_id, d.org_name, s.stage_name, u.user_name, CAST(COALESCE(d.value, 0) AS DECIMAL(18,2)) AS value
FROM ({LIVE}) d LEFT JOIN stages s ON s.stage_id = d.stage_id LEFT JOIN crm_users u ON u.user_id = d.owner_id WHERE d.status = 'open'
ORDER BY COALESCE(d.value, 0) DESC, d.deal_id LIMIT 30""", "deals", "stages", "crm_users"))
def q_top_open(spark, sf):
    T = _T(spark, sf)
    return crm.top_open_deals(T.deals, T.stages, T.crm_users)


@register("stage_stats", with_views(f"""
WITH g AS (SELECT stage_id, COUNT(*) AS deals, COUNT(CASE WHEN status = 'open' THEN 1 END) AS open,
                  COUNT(CASE WHEN status = 'won' THEN 1 END) AS won, COUNT(CASE WHEN status = 'lost' THEN 1 END) AS lost,
                  SUM(CASE WHEN status = 'won' THEN value END) AS wv FROM ({LIVE}) d GROUP BY 1)
SELECT s.stage_id, s.stage_name, s.order_nr, COALESCE(g.deals, 0) AS deals, COALESCE(g.open, 0) AS open,
       COALESCE(g.won, 0) AS won, COALESCE(g.lost, 0) AS lost,
       CAST(COALESCE(g.won, 0) AS DOUBLE) * 100.0 / NULLIF(CAST(COALESCE(g.won, 0) + COALESCE(g.lost, 0) AS DOUBLE), 0) AS win_rate_pct,
       CAST(g.wv AS DOUBLE) / NULLIF(CAST(g.won AS DOUBLE), 0) AS won_ticket
FROM stages s LEFT JOIN g ON g.stage_id = s.stage_id""", "deals", "stages"))
def q_stage_stats(spark, sf):
    T = _T(spark, sf)
    return crm.stage_stats(T.deals, T.stages)


@register("sector_conversion", with_views(f"""
SELECT pipeline_id,
       COUNT(CASE WHEN date_trunc('month', CAST(add_time AS DATE)) = DATE '2024-01-01' AND s.order_nr >= 2 THEN 1 END) AS active,
       COUNT(CASE WHEN status = 'won' AND date_trunc('month', CAST(won_time AS DATE)) = DATE '2024-01-01' THEN 1 END) AS won,
       CAST(COUNT(CASE WHEN status = 'won' AND date_trunc('month', CAST(won_time AS DATE)) = DATE '2024-01-01' THEN 1 END) AS DOUBLE) * 100.0
         / NULLIF(CAST(COUNT(CASE WHEN date_trunc('month', CAST(add_time AS DATE)) = DATE '2024-01-01' AND s.order_nr >= 2 THEN 1 END) AS DOUBLE), 0)
         AS conversion_pct
FROM ({LIVE}) d LEFT JOIN stages s ON s.stage_id = d.stage_id GROUP BY pipeline_id""", "deals", "stages"))
def q_sector_conv(spark, sf):
    T = _T(spark, sf)
    return crm.sector_conversion(T.deals, T.stages, "2024-01-01")


@register("call_stats", with_views("""
SELECT user_key, COUNT(DISTINCT conversation_id) AS conversations, CAST(SUM(duration_seconds) AS DOUBLE) / 60.0 AS total_minutes,
       AVG(duration_seconds) / 60.0 AS mean_minutes,
       COUNT(*) FILTER (lower(ai_sentiment) = 'positive') AS positive, COUNT(*) FILTER (lower(ai_sentiment) = 'negative') AS negative
FROM calls GROUP BY user_key""", "calls"))
def q_call_stats(spark, sf):
    return crm.call_stats(_T(spark, sf).calls)


def _act_sql(keys, source):
    day = "COALESCE(CAST(marked_as_done_time AS DATE), due_date)"
    return f"""SELECT * FROM (
SELECT {keys}, COUNT(*) FILTER (COALESCE(done, FALSE) AND {day} BETWEEN DATE '2024-01-01' AND DATE '2024-01-31') AS done,
       COUNT(*) FILTER (NOT COALESCE(done, FALSE) AND due_date < DATE '2024-01-20') AS overdue
FROM {source} WHERE a.user_id IS NOT NULL GROUP BY ALL) x WHERE done > 0 OR overdue > 0"""


@register("activities_by_type", with_views(_act_sql("type", "activities a"), "activities"))
def q_act_type(spark, sf):
    return crm.activities_by(_T(spark, sf).activities, "2024-01-01", "2024-01-31", "2024-01-20", "type")


@register("activities_by_user", with_views(_act_sql("a.user_id, u.user_name", "activities a JOIN crm_users u ON u.user_id = a.user_id AND u.is_active"),
                                           "activities", "crm_users"))
def q_act_user(spark, sf):
    T = _T(spark, sf)
    return crm.activities_by(T.activities, "2024-01-01", "2024-01-31", "2024-01-20", "user_id", T.crm_users)


# -- RFV panels ----------------------------------------------------------------------------

SCORE_SQL = S.rfv_score(REF)


def _score(T):
    return com.rfv_score(com.rfv_base(com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, REF), REF))


_CELLS = ", ".join(f"('{r[0]}', '{r[1]}', '{r[2]}', {r[3]}, {S._lit(r[4])})" for r in P.rfv_matrix_rows())


@register("rfv_cells", with_views(f"""
WITH g AS (SELECT cell, COUNT(DISTINCT partner_name) AS clients, CAST(SUM(total_value) AS DECIMAL(18,2)) AS revenue
           FROM ({SCORE_SQL}) s GROUP BY cell)
SELECT c.cell, c.freq_bucket, c.rec_bucket, CAST(c.segment_num AS INTEGER) AS segment_num, c.segment,
       COALESCE(g.clients, 0) AS clients, CAST(COALESCE(g.revenue, 0) AS DECIMAL(18,2)) AS revenue
FROM (VALUES {_CELLS}) c(cell, freq_bucket, rec_bucket, segment_num, segment) LEFT JOIN g ON g.cell = c.cell""", *SALES_VIEWS))
def q_rfv_cells(spark, sf):
    return crm.rfv_cells(_score(_T(spark, sf)))


@register("rfv_segments", with_views(f"""
WITH g AS (SELECT segment_num, segment, COUNT(DISTINCT partner_name) AS clients, CAST(SUM(total_value) AS DECIMAL(18,2)) AS revenue
           FROM ({SCORE_SQL}) s GROUP BY 1, 2)
SELECT *, CAST(clients AS DOUBLE) * 100.0 / CAST((SELECT SUM(clients) FROM g) AS DOUBLE) AS clients_pct FROM g""", *SALES_VIEWS))
def q_rfv_segments(spark, sf):
    return crm.rfv_segments(_score(_T(spark, sf)))


_KPI_SEGS = ", ".join(f"COUNT(*) FILTER (segment_num IN {_in(n)}) AS {c}" for c, n in (
    ("champions", (1,)), ("loyal", (2,)), ("potential_loyal", (3,)), ("cannot_lose", (8,)), ("hibernating", (10,)), ("at_risk", (9, 10)), ("lost", (11,))))


@register("rfv_kpis", with_views(f"""
SELECT COUNT(DISTINCT partner_name) AS clients, CAST(SUM(total_value) AS DECIMAL(18,2)) AS revenue,
       CAST(SUM(total_value) AS DOUBLE) / NULLIF(CAST(COUNT(total_value) AS DOUBLE), 0) AS mean_ticket, {_KPI_SEGS}, MAX(ref_date) AS ref_date
FROM ({SCORE_SQL}) s""", *SALES_VIEWS))
def q_rfv_kpis(spark, sf):
    return crm.rfv_kpis(_score(_T(spark, sf)))


@register("rfv_owner_panel", with_views(f"""
WITH g AS (SELECT rfv_salesperson, COUNT(DISTINCT partner_name) AS clients, COUNT(*) FILTER (cell = 'F1R1') AS champions,
  COUNT(*) FILTER (cell IN ('F1R2', 'F1R3', 'F2R1', 'F2R2', 'F2R3')) AS loyal, COUNT(*) FILTER (cell IN ('F3R1', 'F3R2', 'F4R1', 'F4R2')) AS potential_loyal,
  COUNT(*) FILTER (cell IN ('F1R4', 'F1R5')) AS cannot_lose, COUNT(*) FILTER (cell IN ('F2R4', 'F2R5', 'F3R4', 'F3R5', 'F4R4')) AS at_risk,
  COUNT(*) FILTER (cell IN ('F4R5', 'F5R4', 'F5R5')) AS lost, CAST(SUM(total_value) AS DECIMAL(18,2)) AS revenue FROM ({SCORE_SQL}) s GROUP BY 1)
SELECT *, CAST(revenue AS DOUBLE) / NULLIF(CAST(clients AS DOUBLE), 0) AS ticket FROM g""", *SALES_VIEWS))
def q_rfv_owner(spark, sf):
    return crm.rfv_owner_panel(_score(_T(spark, sf)))


@register("rfv_clients_at_risk", with_views(f"""
SELECT partner_name, rfv_familia, rfv_salesperson, partner_codes, recency_days, frequency, total_value
FROM ({SCORE_SQL}) s WHERE segment_num = 9""", *SALES_VIEWS))
def q_rfv_clients(spark, sf):
    return crm.rfv_clients(_score(_T(spark, sf)), 9)


@register("rfv_portfolios", with_views(f"SELECT DISTINCT rfv_familia, rfv_salesperson FROM ({SCORE_SQL}) s", *SALES_VIEWS))
def q_rfv_portfolios(spark, sf):
    return _score(_T(spark, sf)).select("rfv_familia", "rfv_salesperson").distinct()


@register("attach_portfolio", with_views(f"""
WITH ex AS (SELECT partner_name, rfv_familia, rfv_salesperson, unnest(string_split(partner_codes, ',')) AS code FROM ({SCORE_SQL}) s),
j AS (SELECT ex.*, p.salesperson_name AS owner FROM ex LEFT JOIN portfolio p ON CAST(p.partner_code AS VARCHAR) = ex.code)
SELECT partner_name, rfv_familia, rfv_salesperson, MIN(owner) AS portfolio_owner, COUNT(DISTINCT code) AS codes,
       COUNT(CASE WHEN owner IS NOT NULL THEN 1 END) AS codes_in_portfolio FROM j GROUP BY 1, 2, 3""", *SALES_VIEWS))
def q_attach_portfolio(spark, sf):
    T = _T(spark, sf)
    return crm.attach_portfolio(_score(T), T.portfolio)


@register("compare_reassignment", with_views(f"""
WITH s AS ({SCORE_SQL}),
mv AS (SELECT DISTINCT partner_name, 'OWNER 4' AS to_owner FROM s WHERE partner_name LIKE '%0'),
j AS (SELECT s.*, mv.to_owner FROM s LEFT JOIN mv ON mv.partner_name = s.partner_name),
b AS (SELECT rfv_salesperson AS owner, COUNT(DISTINCT partner_name) AS clients_before, SUM(total_value) AS revenue_before FROM j GROUP BY 1),
a AS (SELECT COALESCE(to_owner, rfv_salesperson) AS owner, COUNT(DISTINCT partner_name) AS clients_after, SUM(total_value) AS revenue_after
      FROM j GROUP BY 1)
SELECT COALESCE(b.owner, a.owner) AS owner, COALESCE(clients_before, 0) AS clients_before, COALESCE(clients_after, 0) AS clients_after,
       CAST(COALESCE(revenue_before, 0) AS DECIMAL(18,2)) AS revenue_before, CAST(COALESCE(revenue_after, 0) AS DECIMAL(18,2)) AS revenue_after,
       CAST(COALESCE(revenue_after, 0) - COALESCE(revenue_before, 0) AS DECIMAL(18,2)) AS revenue_impact
FROM b FULL OUTER JOIN a ON a.owner = b.owner""", *SALES_VIEWS))
def q_compare_reassign(spark, sf):
    s = _score(_T(spark, sf))
    moves = s.where(F.col("partner_name").endswith("0")).select("partner_name", F.lit("OWNER 4").alias("to_owner")).distinct()
    return crm.compare_reassignment(s, moves)


@register("rfv_summary_masked", with_views(f"""
SELECT ref_date, rfv_familia, rfv_salesperson, segment, segment_num, COUNT(DISTINCT partner_name) AS clients,
       CAST(0 AS DECIMAL(18,2)) AS revenue, CAST(0 AS DOUBLE) AS mean_ticket, AVG(frequency) AS mean_frequency,
       AVG(recency_days) AS mean_recency_days
FROM ({SCORE_SQL}) s GROUP BY ref_date, rfv_familia, rfv_salesperson, segment, segment_num""", *SALES_VIEWS))
def q_masked(spark, sf):
    return crm.mask_values(com.rfv_summary(_score(_T(spark, sf))), ["revenue", "mean_ticket"])
