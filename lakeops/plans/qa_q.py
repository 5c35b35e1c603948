"""Registered QA / reconciliation and data-quality queries (A-QA-1..6, QLT-1..8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.operators import commercial as com
from lakeops.operators import crm, qa, quality as QL
from lakeops.plans import sqlfrag as S
from lakeops.plans.commercial_q import SALES_VIEWS
from lakeops.plans.crm_q import ALERTS_SQL, C360_SQL, C360_VIEWS, _alerts, _c360
from lakeops.plans.name_sql import ratio_sql
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import SALES_REF, DriverTables

REF = SALES_REF
MONTH = "2001-07-01"
QA_DATE = "2001-07-31"


def _T(spark, sf):
    return DriverTables(spark, sf)


# -- A-QA-1 / 2 -------------------------------------------------------------------------

def _layers(T):
    m0 = F.lit(MONTH).cast("date")
    fam = F.broadcast(T.group_family)
    seg_fam = F.when(F.col("c_mktsegment") == "AUTOMOBILE", "FARMACIAS").when(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "HOSPITALAR")
    # declared: what the business reports from the raw order book (statuses 3/4, no nature filter)
    o = T.raw("orders").join(T.raw("customer"), F.col("o_custkey") == F.col("c_custkey")).where(
        F.col("o_orderstatus").isin("F", "O") & (F.trunc(F.col("o_orderdate").cast("date"), "month") == m0))
    o = o.withColumn("scope", seg_fam).where(F.col("scope").isNotNull())

    def wide(df, scope_col, amount, order, client):
        # per scope and GERAL in one aggregation (ROLLUP): each layer is scanned once
        r = df.rollup(F.col(scope_col).alias("scope")).agg(
            F.sum(amount).cast("double").alias("revenue"), F.countDistinct(order).cast("double").alias("orders"),
            F.countDistinct(client).cast("double").alias("clients"), F.grouping_id().alias("_g"))
        u = r.select(F.when(F.col("_g") == 1, F.lit("GERAL")).otherwise(F.col("scope")).alias("scope"),
                     "revenue", "orders", "clients").withColumn("ref_date", F.lit(QA_DATE).cast("date"))
        return qa.metrics_long(u, ["ref_date", "scope"], ["revenue", "orders", "clients"])

    declared = wide(o.withColumn("amt", F.col("o_totalprice").cast("decimal(18,2)")), "scope", "amt", "o_orderkey", "o_custkey")
    b = com.billed_orders(T.sales_order, T.nature).join(fam, "salesperson_group_code").where(F.trunc("invoice_date", "month") == m0)
    source = wide(b, "rfv_familia", "product_amount", "order_number", "partner_code")
    wsales = com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, REF).where(F.trunc("invoice_date", "month") == m0)
    warehouse = wide(wsales, "rfv_familia", "product_amount", "order_number", "partner_name")
    return declared, source, warehouse


def _wide_sql(src, scope, amount, order, client):
    return f"""SELECT DATE '{QA_DATE}' AS ref_date, scope, m.metric, m.value FROM (
  SELECT {scope} AS scope, CAST(SUM({amount}) AS DOUBLE) AS revenue, CAST(COUNT(DISTINCT {order}) AS DOUBLE) AS orders,
         CAST(COUNT(DISTINCT {client}) AS DOUBLE) AS clients FROM ({src}) x GROUP BY 1
  UNION ALL
  SELECT 'GERAL', CAST(SUM({amount}) AS DOUBLE), CAST(COUNT(DISTINCT {order}) AS DOUBLE), CAST(COUNT(DISTINCT {client}) AS DOUBLE)
  FROM ({src}) x) w,
LATERAL (SELECT * FROM (VALUES ('revenue', w.revenue), ('orders', w.orders), ('clients', w.clients)) v(metric, value)) m"""


_DECL_SRC = f"""SELECT o.o_orderkey, o.o_custkey, CAST(o.o_totalprice AS DECIMAL(18,2)) AS amt,
  CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'FARMACIAS' WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'HOSPITALAR' END AS scope
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus IN ('F', 'O') AND date_trunc('month', CAST(o.o_orderdate AS DATE)) = DATE '{MONTH}'"""
_SRC_SRC = f"""SELECT o.*, gf.rfv_familia FROM ({S.billed()}) o JOIN group_family gf ON gf.salesperson_group_code = o.salesperson_group_code
WHERE date_trunc('month', o.invoice_date) = DATE '{MONTH}'"""
_WH_SRC = f"SELECT * FROM ({S.silver_sales(REF)}) s WHERE date_trunc('month', invoice_date) = DATE '{MONTH}'"
QA_SQL = f"""WITH dcl AS ({_wide_sql(f"SELECT * FROM ({_DECL_SRC}) d WHERE scope IS NOT NULL", 'scope', 'amt', 'o_orderkey', 'o_custkey')}),
src AS ({_wide_sql(_SRC_SRC, 'rfv_familia', 'product_amount', 'order_number', 'partner_code')}),
wh AS ({_wide_sql(_WH_SRC, 'rfv_familia', 'product_amount', 'order_number', 'partner_name')}),
j AS (SELECT COALESCE(dcl.ref_date, src.ref_date, wh.ref_date) AS ref_date, COALESCE(dcl.scope, src.scope, wh.scope) AS scope,
             COALESCE(dcl.metric, src.metric, wh.metric) AS metric, dcl.value AS declared, src.value AS source, wh.value AS warehouse
      FROM dcl FULL OUTER JOIN src ON src.ref_date = dcl.ref_date AND src.scope = dcl.scope AND src.metric = dcl.metric
      FULL OUTER JOIN wh ON wh.ref_date = COALESCE(dcl.ref_date, src.ref_date) AND wh.scope = COALESCE(dcl.scope, src.scope)
                        AND wh.metric = COALESCE(dcl.metric, src.metric)),
z AS (SELECT *, COALESCE(declared, 0.0) AS d, COALESCE(source, 0.0) AS s, COALESCE(warehouse, 0.0) AS w FROM j),
k AS (SELECT ref_date, scope, metric, declared, source, warehouse, s - d AS delta_source, CASE WHEN d = 0 THEN 0.0 ELSE (s - d) / d * 100.0 END AS source_pct,
             w - s AS delta_warehouse, CASE WHEN s = 0 THEN 0.0 ELSE (w - s) / s * 100.0 END AS warehouse_pct,
             CASE WHEN d = 0 THEN 0.0 ELSE (w - d) / d * 100.0 END AS delta_pct FROM z)
SELECT *, CASE WHEN abs(delta_pct) < 1 THEN 'VERDE' WHEN abs(delta_pct) < 3 THEN 'AMARELO' ELSE 'VERMELHO' END AS status FROM k"""


def _qa(T):
    return qa.qa_cascade(*_layers(T))


@register("qa_cascade", with_views(QA_SQL, *SALES_VIEWS))
def q_qa(spark, sf):
    return _qa(_T(spark, sf))


@register("qa_status", with_views(f"""WITH q AS ({QA_SQL})
SELECT ref_date, scope, status, delta_pct,
       CAST(CASE scope WHEN 'GERAL' THEN 1 WHEN 'HOSPITALAR' THEN 2 WHEN 'FARMACIAS' THEN 3 WHEN 'SAC' THEN 4 ELSE 9 END AS INTEGER) AS scope_order
FROM q WHERE metric = 'revenue' AND ref_date = (SELECT MAX(ref_date) FROM q)""", *SALES_VIEWS))
def q_qa_status(spark, sf):
    return qa.qa_latest_status(_qa(_T(spark, sf)))


def _cells_sql(months):
    cells = ", ".join(f"('{r[0]}')" for r in P.rfv_matrix_rows())
    return f"""SELECT c.cell, COALESCE(g.clients, 0) AS clients FROM (VALUES {cells}) c(cell)
LEFT JOIN (SELECT cell, COUNT(DISTINCT partner_name) AS clients FROM ({S.rfv_score(REF, months)}) s GROUP BY cell) g ON g.cell = c.cell"""


@register("compare_declared_cells", with_views(f"""
SELECT COALESCE(a.cell, d.cell) AS cell, COALESCE(a.clients, 0) AS actual, COALESCE(d.clients, 0) AS declared,
       COALESCE(a.clients, 0) - COALESCE(d.clients, 0) AS diff,
       CAST(COALESCE(a.clients, 0) - COALESCE(d.clients, 0) AS DOUBLE) * 100.0 / NULLIF(CAST(COALESCE(d.clients, 0) AS DOUBLE), 0) AS diff_pct,
       abs(COALESCE(a.clients, 0) - COALESCE(d.clients, 0)) <= 3 AS within_abs,
       COALESCE(abs(CAST(COALESCE(a.clients, 0) - COALESCE(d.clients, 0) AS DOUBLE) * 100.0 / NULLIF(CAST(COALESCE(d.clients, 0) AS DOUBLE), 0)), 0.0) <= 10 AS within_pct
FROM ({_cells_sql(12)}) a FULL OUTER JOIN ({_cells_sql(36)}) d ON d.cell = a.cell""", *SALES_VIEWS))
def q_compare_declared(spark, sf):
    T = _T(spark, sf)

    def cells(m):
        s = com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, REF, lookback_months=m)
        return crm.rfv_cells(com.rfv_score(com.rfv_base(s, REF))).select("cell", "clients")

    return qa.compare_declared(cells(12), cells(36), ["cell"])


@register("grain_reconcile", with_views(f"""
WITH s AS ({S.silver_sales(REF)}),
r AS (SELECT rfv_familia, rfv_salesperson, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS revenue, GROUPING(rfv_familia, rfv_salesperson) AS gid
      FROM s GROUP BY ROLLUP (rfv_familia, rfv_salesperson)),
t AS (SELECT revenue AS total FROM r WHERE gid = 3),
l AS (SELECT gid, SUM(revenue) AS level_sum, COUNT(*) AS groups FROM r GROUP BY gid)
SELECT CASE WHEN gid = 3 THEN 'total' WHEN gid = 1 THEN 'family' ELSE 'family_x_salesperson' END AS grain, groups,
       CAST(level_sum AS DECIMAL(18,2)) AS level_sum, level_sum = t.total AS adds_up FROM l, t""", *SALES_VIEWS))
def q_grain(spark, sf):
    T = _T(spark, sf)
    return qa.grain_reconcile(com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, REF))


@register("validate_totals", with_views(f"""
SELECT COUNT(*) AS orders, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS total,
       {", ".join(f"CAST(COALESCE(SUM(CASE WHEN nature_code = '{c}' THEN product_amount END), 0) AS DECIMAL(18,2)) AS total_op_{c}" for c in "1234")}
FROM sales_order WHERE invoice_date BETWEEN DATE '2001-01-01' AND DATE '2001-06-30'""", "sales_order"))
def q_validate_totals(spark, sf):
    return qa.validate_totals(_T(spark, sf).sales_order, "2001-01-01", "2001-06-30")


@register("executive_summary", with_views(f"""
WITH c AS ({C360_SQL}), a AS ({ALERTS_SQL.replace('WITH c360 AS', 'WITH c360x AS').replace('FROM c360 ', 'FROM c360x ')}),
g AS (SELECT rfv_familia, COUNT(DISTINCT partner_code) AS clients, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue,
             COUNT(CASE WHEN segment_num IN (9, 10, 11) THEN 1 END) AS at_risk FROM c GROUP BY 1),
al AS (SELECT rfv_familia, {", ".join(f"COUNT(CASE WHEN priority = {p} THEN 1 END) AS alerts_p{p}" for p in range(1, 6))} FROM a GROUP BY 1)
SELECT g.*, {", ".join(f"COALESCE(al.alerts_p{p}, 0) AS alerts_p{p}" for p in range(1, 6))}
FROM g LEFT JOIN al ON al.rfv_familia = g.rfv_familia""", *C360_VIEWS))
def q_exec_summary(spark, sf):
    c = _c360(_T(spark, sf))  # one 360 (and one entity-resolution pass) feeds both inputs
    return qa.executive_summary(c, crm.alerts(c))


# -- QLT ----------------------------------------------------------------------------------

_TR = f"translate({{x}}, '{P.ACCENTED}', '{'?' * len(P.ACCENTED)}')"


def _corrupt_sql(x):
    return _TR.format(x=x)


DICT_SQL = f"""SELECT pattern, replacement FROM (
  SELECT pattern, token AS replacement, row_number() OVER (PARTITION BY pattern ORDER BY n DESC, token DESC) AS k FROM (
    SELECT {_corrupt_sql('token')} AS pattern, token, COUNT(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents) t
    WHERE NOT contains(token, '?') AND length(token) >= 4 AND token <> {_corrupt_sql('token')} GROUP BY 1, 2)) WHERE k = 1"""
# every pattern that a value holds, longest first, folded over the value
REPAIR_SQL = f"""WITH d AS ({DICT_SQL}),
c AS (SELECT conv_id, turn, {_corrupt_sql('text')} AS text FROM conversations),
av AS (SELECT DISTINCT text AS v FROM c WHERE contains(text, '?')),
f AS (SELECT v, list({{'p': d.pattern, 'r': d.replacement}} ORDER BY length(d.pattern) DESC, d.pattern) AS found
      FROM av JOIN d ON contains(av.v, d.pattern) GROUP BY v),
rb AS (SELECT v, (list_reduce(list_prepend({{'p': '', 'r': v}}, found), lambda a, x: {{'p': '', 'r': replace(a.r, x.p, x.r)}})).r AS fixed FROM f)
SELECT c.conv_id, c.turn, c.text, COALESCE(rb.fixed, c.text) AS text_repaired FROM c LEFT JOIN rb ON rb.v = c.text"""


def _repaired(T):
    d = QL.build_dictionary(T.raw("documents"), "text")
    conv = T.raw("conversations").select("conv_id", "turn", QL.corrupt("text").alias("text"))
    return QL.repair_terms(conv, "text", d, out="text_repaired").select("conv_id", "turn", "text", "text_repaired")


@register("repair_terms", REPAIR_SQL)
def q_repair(spark, sf):
    return _repaired(_T(spark, sf))


@register("unresolved_report", f"""WITH r AS ({REPAIR_SQL}),
l AS (SELECT 'text_repaired' AS "column", text_repaired AS value FROM r WHERE contains(text_repaired, '?')),
c AS (SELECT "column", COUNT(*) AS unresolved FROM l GROUP BY 1),
s AS (SELECT "column", string_agg(value, ' | ' ORDER BY value) AS samples FROM (
        SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) AS k FROM (SELECT DISTINCT * FROM l)) WHERE k <= 15
      GROUP BY 1)
SELECT c."column", c.unresolved, s.samples FROM c LEFT JOIN s ON s."column" = c."column" """)
def q_unresolved(spark, sf):
    return QL.unresolved_report(_repaired(_T(spark, sf)), ["text_repaired"])


def _cities(T):
    p = T.partner
    k = F.col("partner_code")
    corrupted = (F.when(k % 5 == 0, F.expr("concat(substring(city, 1, cast(partner_code % length(city) as int)), '?', "
                                           "substring(city, cast(partner_code % length(city) + 2 as int)))"))
                 .when(k % 5 == 1, F.expr("substring(city, 1, length(city) - 1)")).otherwise(F.col("city")))
    return p.select("partner_code", corrupted.alias("city"), "state")


def _ref_cities(T):
    n, r = T.raw("nation"), T.raw("region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("city_name"), F.col("r_name").alias("state_code"))


_CITY_IN = """SELECT p.partner_code,
  CASE WHEN p.partner_code % 5 = 0 THEN substr(p.city, 1, CAST(p.partner_code % length(p.city) AS INTEGER)) || '?'
                                          || substr(p.city, CAST(p.partner_code % length(p.city) + 2 AS INTEGER))
       WHEN p.partner_code % 5 = 1 THEN substr(p.city, 1, length(p.city) - 1) ELSE p.city END AS city, p.state
FROM partner p"""
_TEXT = lambda x: f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'))"
_RATIO = f"({ratio_sql('cv', 'cr')})"
# literal bands, not taken from the parameters: up to 6 letters 70, up to 12 letters 80, longer 85
_MINS = "CASE WHEN length(v) <= 6 THEN 70.0 WHEN length(v) <= 12 THEN 80.0 ELSE 85.0 END"
CITY_SQL = f"""WITH inp AS ({_CITY_IN}),
r AS (SELECT DISTINCT upper(n.n_name) AS rc, upper(g.r_name) AS rs, {_TEXT('upper(n.n_name)')} AS cr FROM nation n JOIN region g ON n.n_regionkey = g.r_regionkey),
v AS (SELECT DISTINCT upper(trim(city)) AS v, upper(state) AS s, {_TEXT('upper(trim(city))')} AS cv FROM inp WHERE city IS NOT NULL AND trim(city) <> ''),
m AS (SELECT v, s, rc AS fixed, 1 AS stage, 100.0 AS score FROM v JOIN r ON v.v = r.rc WHERE NOT contains(v.v, '?')
      UNION ALL SELECT v, s, rc, CASE WHEN v.s = r.rs THEN 2 ELSE 3 END, {_RATIO} FROM v, r
                WHERE contains(v.v, '?') AND length(v.v) = length(r.rc) AND r.rc LIKE replace(v.v, '?', '_')
      UNION ALL SELECT v, s, rc, CASE WHEN v.s = r.rs THEN 4 ELSE 5 END, {_RATIO} FROM v, r
                WHERE contains(v.v, '?') AND round_even({_RATIO}, 0) >= {_MINS}),
b AS (SELECT v, s, fixed AS city_fixed, stage FROM (
        SELECT *, row_number() OVER (PARTITION BY v, s ORDER BY stage, score DESC, fixed) AS k FROM m) WHERE k = 1)
SELECT inp.partner_code, inp.city, inp.state, b.city_fixed,
       CASE b.stage WHEN 1 THEN 'exact' WHEN 2 THEN 'wildcard' WHEN 3 THEN 'wildcard_national' WHEN 4 THEN 'fuzzy'
                    WHEN 5 THEN 'fuzzy_national' END AS match_how
FROM inp LEFT JOIN b ON b.v = upper(trim(inp.city)) AND b.s IS NOT DISTINCT FROM upper(inp.state)"""


@register("match_cities", with_views(CITY_SQL, "partner"))
def q_match_cities(spark, sf):
    T = _T(spark, sf)
    return QL.match_cities(_cities(T), _ref_cities(T))


@register("corruption_profile", with_views(f"""WITH inp AS ({_CITY_IN})
SELECT 'city' AS "column", COUNT(CASE WHEN city IS NOT NULL AND trim(city) <> '' THEN 1 END) AS total,
       COUNT(CASE WHEN city IS NOT NULL AND trim(city) <> '' AND contains(city, '?') THEN 1 END) AS corrupted,
       CAST(COUNT(CASE WHEN city IS NOT NULL AND trim(city) <> '' AND contains(city, '?') THEN 1 END) AS DOUBLE) * 100.0
         / NULLIF(CAST(COUNT(CASE WHEN city IS NOT NULL AND trim(city) <> '' THEN 1 END) AS DOUBLE), 0) AS corrupted_pct
FROM inp
UNION ALL
SELECT 'state', COUNT(CASE WHEN state IS NOT NULL AND trim(state) <> '' THEN 1 END),
       COUNT(CASE WHEN state IS NOT NULL AND trim(state) <> '' AND contains(state, '?') THEN 1 END),
       CAST(COUNT(CASE WHEN state IS NOT NULL AND trim(state) <> '' AND contains(state, '?') THEN 1 END) AS DOUBLE) * 100.0
         / NULLIF(CAST(COUNT(CASE WHEN state IS NOT NULL AND trim(state) <> '' THEN 1 END) AS DOUBLE), 0)
FROM inp""", "partner"))
def q_corruption(spark, sf):
    return QL.corruption_profile(_cities(_T(spark, sf)), ["city", "state"])


STATES = [("AF", "Africa"), ("AM", "América"), ("AS", "Ásia"), ("EU", "Europa"), ("ME", "Middle East")]


@register("normalise_state", with_views(f"""
WITH st AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{n}')" for c, n in STATES)}) t(code, name)),
keys AS (SELECT DISTINCT upper(code) AS k, upper(code) AS c FROM st
         UNION SELECT regexp_replace(upper(strip_accents(name)), '[^A-Z0-9]', '', 'g'), upper(code) FROM st),
p AS (SELECT partner_code, CASE WHEN partner_code % 3 = 0 THEN lower(state) WHEN partner_code % 3 = 1 THEN substr(state, 1, 2) ELSE state END AS state
      FROM partner)
SELECT p.partner_code, keys.c AS state FROM p
LEFT JOIN keys ON keys.k = regexp_replace(upper(strip_accents(p.state)), '[^A-Z0-9]', '', 'g')""", "partner"))
def q_norm_state(spark, sf):
    T = _T(spark, sf)
    k = F.col("partner_code")
    p = T.partner.select("partner_code", F.when(k % 3 == 0, F.lower("state")).when(k % 3 == 1, F.substring("state", 1, 2))
                         .otherwise(F.col("state")).alias("state"))
    st = spark.createDataFrame(STATES, "code string, name string")
    return QL.normalise_state(p, "state", st)


@register("map_stage_labels", with_views("""
SELECT d.deal_id, d.stage_id, COALESCE(s.stage_name, 'Sem etapa') AS stage_label FROM deals d
LEFT JOIN stages s ON s.stage_id = d.stage_id
WHERE NOT (d.stage_id = 4 AND d.pipeline_id = 3)""", "deals", "stages"))
def q_map_labels(spark, sf):
    T = _T(spark, sf)
    mp = T.stages.select(F.col("stage_id").alias("code"), F.col("stage_name").alias("label"))
    excl = spark.createDataFrame([(4, 3)], "stage_id bigint, pipeline_id bigint")
    d = T.deals.select("deal_id", "stage_id", "pipeline_id")
    return QL.map_labels(d, "stage_id", mp, "Sem etapa", out="stage_label", exclude_pairs=excl).select("deal_id", "stage_id", "stage_label")
