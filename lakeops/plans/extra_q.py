"""Registered queries for the remaining inventory rows: hybrid RFV assignment (JON-3), dominant group (WIN-2),
auto-summary (AGG-14), tagged union (SET-1), parameter upsert (CDC-12), prefix exclusion (FLT-5), months set (FLT-3),
portfolio label / revenue (A-COM-16), RFV periods (A-COM-15), daily rankings (A-COM-29)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import aggregations as AG
from lakeops.functions import columns as C
from lakeops.operators import cdc, commercial as com, partials, targets as TG
from lakeops.operators.price import PARAM_COLS
from lakeops.plans import sqlfrag as S
from lakeops.plans.commercial_q import HIST_REFS, SALES_VIEWS, _history_sql
from lakeops.plans.loads_q import _place
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import SALES_REF, DriverTables

REF = SALES_REF


def _T(spark, sf):
    return DriverTables(spark, sf)


def _nk(x):
    return f"upper(regexp_replace(strip_accents(COALESCE({x}, '')), '[^A-Za-z0-9 ]', '', 'g'))"


_NEW = S.lookup("j.dom_grp", P.NEW_CLIENT_FAMILY)
HYBRID_SALES = f"""
WITH cc AS (SELECT partner_code, rfv_familia AS cc_fam, salesperson_name AS cc_sp FROM (
              SELECT *, row_number() OVER (PARTITION BY partner_code ORDER BY rfv_familia, salesperson_name) AS k
              FROM portfolio WHERE is_active) WHERE k = 1),
cn AS (SELECT nome_norm, rfv_familia AS cn_fam, salesperson_name AS cn_sp FROM (
         SELECT {_nk('partner_name')} AS nome_norm, rfv_familia, salesperson_name,
                row_number() OVER (PARTITION BY {_nk('partner_name')} ORDER BY rfv_familia, salesperson_name) AS k
         FROM portfolio WHERE is_active) WHERE k = 1 AND nome_norm <> ''),
v AS (SELECT b.*, p.partner_name AS partner_name_erp, {_nk('p.partner_name')} AS nome_norm,
             COALESCE(p.partner_name, CAST(b.partner_code AS VARCHAR)) AS pkey
      FROM ({S.billed()} AND o.invoice_date >= {S.lookback_start(REF, 12)} AND o.invoice_date <= DATE '{REF}') b
      LEFT JOIN partner p ON p.partner_code = b.partner_code),
gd AS (SELECT pkey, grp AS dom_grp FROM (
         SELECT pkey, grp, row_number() OVER (PARTITION BY pkey ORDER BY val DESC, grp) AS k FROM (
           SELECT pkey, salesperson_group_code AS grp, SUM(product_amount) AS val FROM v
           WHERE salesperson_group_code IN ('FA', 'FR', 'PC') GROUP BY 1, 2)) WHERE k = 1),
j AS (SELECT v.*, cc.cc_fam, cc.cc_sp, cn.cn_fam, cn.cn_sp, gd.dom_grp FROM v
      LEFT JOIN cc ON cc.partner_code = v.partner_code LEFT JOIN cn ON cn.nome_norm = v.nome_norm
      LEFT JOIN gd ON gd.pkey = v.pkey)
SELECT j.order_number, j.invoice_date, j.partner_code, j.product_amount, j.pkey AS partner_name,
       COALESCE(j.cc_fam, j.cn_fam, {_NEW}) AS rfv_familia, COALESCE(j.cc_sp, j.cn_sp, '{P.NEW_CLIENT_OWNER}') AS rfv_salesperson
FROM j WHERE j.cc_fam IS NOT NULL OR j.cn_fam IS NOT NULL OR j.salesperson_group_code IN ('FA', 'FR', 'PC')"""
HYBRID_BASE = S.rfv_base_from(HYBRID_SALES, S.ref_date(REF))


def _hybrid(T):
    return com.hybrid_rfv_base(T.sales_order, T.nature, T.partner, T.portfolio, REF)


@register("rfv_base_hybrid", with_views(HYBRID_BASE, "sales_order", "nature", "partner", "portfolio"))
def q_hybrid_base(spark, sf):
    return _hybrid(_T(spark, sf))


@register("rfv_score_hybrid", with_views(S.rfv_score_from(HYBRID_BASE), "sales_order", "nature", "partner", "portfolio"))
def q_hybrid_score(spark, sf):
    return com.rfv_score(_hybrid(_T(spark, sf)))


@register("dominant_group", with_views("""
SELECT partner_code, salesperson_group_code FROM (
  SELECT partner_code, salesperson_group_code, row_number() OVER (PARTITION BY partner_code ORDER BY v DESC, salesperson_group_code) AS k
  FROM (SELECT partner_code, salesperson_group_code, SUM(product_amount) AS v FROM sales_order
        WHERE salesperson_group_code IS NOT NULL GROUP BY 1, 2)) WHERE k = 1""", "sales_order"))
def q_dominant(spark, sf):
    s = _T(spark, sf).sales_order.where(F.col("salesperson_group_code").isNotNull())
    return com.dominant(s, "partner_code", "salesperson_group_code", "product_amount")


_MONEY_COLS = ["product_amount", "icms_amount", "ipi_amount", "freight_amount", "total_amount"]


@register("auto_summary_orders", with_views(
    "SELECT 'rows' AS measure, CAST(COUNT(*) AS DECIMAL(38,2)) AS value FROM sales_order\n"
    + "\n".join(f"UNION ALL SELECT 'sum_{c}', CAST(SUM({c}) AS DECIMAL(38,2)) FROM sales_order" for c in _MONEY_COLS),
    "sales_order"))
def q_auto_summary(spark, sf):
    return AG.auto_summary(_T(spark, sf).sales_order)


_DEAL_COLS = ["org_id", "deal_id", "status", "value", "add_time", "won_time", "expected_close_date", "pipeline_id", "owner_id"]


@register("deals_union_tagged", with_views("\nUNION ALL\n".join(
    f"SELECT {', '.join(_DEAL_COLS)}, 'pipeline_{p}' AS source FROM deals WHERE pipeline_id = {p} AND NOT COALESCE(is_deleted, FALSE)"
    for p in (1, 2, 3)), "deals"))
def q_union_tagged(spark, sf):
    d = _T(spark, sf).deals.where(~F.coalesce(F.col("is_deleted"), F.lit(False))).select(*_DEAL_COLS)
    return AG.union_tagged({f"pipeline_{p}": d.where(F.col("pipeline_id") == p) for p in (1, 2, 3)})


def _param_delta(T):
    pp = T.price_params
    k = F.col("item_code").cast("bigint")
    upd = pp.where(k % 5 == 0).withColumn("pct_ads", F.lit(4.0))
    new = (T.raw("part").where(F.col("p_partkey") % 4 == 3)
           .select(F.col("p_partkey").cast("string").alias("item_code"), F.lit("Amazon").alias("canal"),
                   F.lit("2001-07-01").cast("date").alias("mes"),
                   *[(F.lit(2.0) if c == "pct_comissao" else F.lit(None).cast("double")).alias(c) for c in PARAM_COLS]))
    return upd.unionByName(new)


_PC = ", ".join(PARAM_COLS)


@register("upsert_price_params", with_views(f"""
WITH d AS (SELECT item_code, canal, mes, {', '.join('CAST(4.0 AS DOUBLE) AS pct_ads' if c == 'pct_ads' else c for c in PARAM_COLS)}
           FROM price_params WHERE CAST(item_code AS BIGINT) % 5 = 0
           UNION ALL
           SELECT CAST(p_partkey AS VARCHAR), 'Amazon', DATE '2001-07-01',
                  {', '.join('CAST(2.0 AS DOUBLE)' if c == 'pct_comissao' else 'CAST(NULL AS DOUBLE)' for c in PARAM_COLS)}
           FROM part WHERE p_partkey % 4 = 3)
SELECT t.* FROM price_params t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.item_code = t.item_code AND d.canal = t.canal AND d.mes = t.mes)
UNION ALL SELECT item_code, canal, mes, {_PC} FROM d""", "price_params"))
def q_upsert_params(spark, sf):
    T = _T(spark, sf)
    return cdc.upsert(T.price_params, _param_delta(T), ["item_code", "canal", "mes"])


@register("sales_excluding_prefixes", with_views("""
SELECT salesperson_name, COUNT(*) AS orders, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS revenue FROM sales_order
WHERE NOT (upper(salesperson_name) LIKE 'SELLER 1%' OR upper(salesperson_name) LIKE 'SELLER 2%') OR salesperson_name IS NULL
GROUP BY 1""", "sales_order"))
def q_excl_prefix(spark, sf):
    s = com.exclude_prefixes(_T(spark, sf).sales_order, "salesperson_name", ["SELLER 1", "SELLER 2"])
    return s.groupBy("salesperson_name").agg(F.count("*").alias("orders"),
                                             F.sum("product_amount").cast("decimal(18,2)").alias("revenue"))


@register("sales_three_months", with_views("""
SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, COUNT(*) AS orders FROM sales_order
WHERE date_trunc('month', invoice_date) IN (DATE '2001-07-01', DATE '2001-06-01', DATE '2000-07-01') GROUP BY 1""", "sales_order"))
def q_months_in(spark, sf):
    s = com.months_in(_T(spark, sf).sales_order, "invoice_date", "2001-07-01")
    return s.groupBy(F.trunc("invoice_date", "month").alias("month")).agg(F.count("*").alias("orders"))


@register("portfolio_label", with_views("""
SELECT DISTINCT rfv_familia, salesperson_name, concat_ws(' · ', rfv_familia, salesperson_name) AS label FROM portfolio""",
                                        "portfolio"))
def q_portfolio_label(spark, sf):
    return com.portfolio_label(_T(spark, sf).portfolio)


@register("portfolio_revenue", with_views(f"""
SELECT p.carteira_code, COUNT(DISTINCT o.partner_code) AS codes, COUNT(DISTINCT o.order_number) AS orders,
       CAST(SUM(o.product_amount) AS DECIMAL(18,2)) AS revenue
FROM sales_order o JOIN nature n ON n.nature_code = o.nature_code AND n.financial_flag <> 'N'
JOIN partner p ON p.partner_code = o.partner_code AND p.carteira_code IS NOT NULL
WHERE o.channel_code <> '000054' AND o.invoice_date >= {S.lookback_start(REF, 12)} AND o.invoice_date <= DATE '{REF}' GROUP BY 1""",
                                         "sales_order", "nature", "partner"))
def q_portfolio_revenue(spark, sf):
    T = _T(spark, sf)
    return com.portfolio_revenue(T.sales_order, T.nature, T.partner, REF)


@register("rfv_periods", with_views(f"SELECT DISTINCT ref_date FROM ({_history_sql()}) h", *SALES_VIEWS))
def q_rfv_periods(spark, sf):
    T = _T(spark, sf)
    s = com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, None)
    return com.rfv_history(s, HIST_REFS).select("ref_date").distinct()


@register("rank_day", with_views("""
WITH d AS (SELECT * FROM deals WHERE NOT COALESCE(is_deleted, FALSE) AND status = 'won'),
w AS (SELECT owner_id AS user_id,
             CAST(COALESCE(SUM(CASE WHEN date_trunc('month', CAST(won_time AS DATE)) = DATE '2024-01-01' THEN value END), 0) AS DECIMAL(18,2)) AS won_month,
             CAST(COALESCE(SUM(CASE WHEN CAST(won_time AS DATE) = DATE '2024-01-15' THEN value END), 0) AS DECIMAL(18,2)) AS won_day
      FROM d GROUP BY 1),
t AS (SELECT user_id, CAST(won_month * 1.5 AS DECIMAL(18,2)) AS target FROM w),
days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
b AS (SELECT COUNT(CASE WHEN dayofweek(day) BETWEEN 1 AND 5 AND day <> DATE '2024-01-01' THEN 1 END) AS total,
             COUNT(CASE WHEN dayofweek(day) BETWEEN 1 AND 5 AND day <> DATE '2024-01-01' AND day <= DATE '2024-01-15' THEN 1 END) AS elapsed
      FROM days),
j AS (SELECT w.user_id, t.target, w.won_day, w.won_month,
             CAST(w.won_day AS DOUBLE) * 100.0 / NULLIF(CAST(t.target AS DOUBLE) / NULLIF(CAST(b.total AS DOUBLE), 0), 0) AS pct_day,
             CAST(w.won_month AS DOUBLE) * 100.0
               / NULLIF(CAST(t.target AS DOUBLE) / NULLIF(CAST(b.total AS DOUBLE), 0) * CAST(b.elapsed AS DOUBLE), 0) AS pct_carry
      FROM w JOIN t ON t.user_id = w.user_id, b)
SELECT *, CAST(row_number() OVER (ORDER BY pct_day DESC NULLS LAST, won_day DESC, user_id) AS INTEGER) AS rank_day,
          CAST(row_number() OVER (ORDER BY pct_carry DESC NULLS LAST, won_month DESC, user_id) AS INTEGER) AS rank_carry FROM j""", "deals"))
def q_rank_day(spark, sf):
    T = _T(spark, sf)
    won = TG.won_by_owner(T.deals, T.crm_users, "2024-01-01", "2024-01-15").drop("user_name")
    tg = won.select("user_id", (F.col("won_month") * F.lit(1.5).cast("decimal(2,1)")).cast("decimal(18,2)").alias("target"))
    months = T.deals.select(F.trunc(F.col("add_time").cast("date"), "month").alias("month")).distinct().where(
        F.col("month") == F.lit("2024-01-01").cast("date"))
    bd = TG.business_days(months, spark.createDataFrame([("2024-01-01",)], "holiday string"), "2024-01-15")
    return TG.rank_day(won, tg, bd, "2024-01-01")


@register("most_frequent_event", """
SELECT user_id, event_type FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type DESC) AS k
  FROM (SELECT user_id, event_type, COUNT(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2)) WHERE k = 1""")
def q_most_frequent(spark, sf):
    from lakeops.operators.entity import most_frequent

    return most_frequent(_T(spark, sf).raw("events"), "user_id", "event_type")


# the rolling year from stored monthly states, held against the exact rows: counts and sums are equal, estimates within their stated error
@register("year_from_states", with_views(f"""WITH f AS (SELECT * FROM sales_order
  WHERE invoice_date >= {S.lookback_start(REF, 12)} AND invoice_date < CAST(date_trunc('month', DATE '{REF}') + INTERVAL 1 MONTH AS DATE)),
g AS (SELECT salesperson_group_code, COUNT(*) AS n_rows, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS amount FROM f GROUP BY 1),
t AS (SELECT salesperson_group_code, MAX(n) AS top_rows FROM (SELECT salesperson_group_code, salesperson_name, COUNT(*) AS n FROM f GROUP BY 1, 2) GROUP BY 1)
SELECT g.*, t.top_rows, TRUE AS clients_near, TRUE AS median_near FROM g JOIN t ON t.salesperson_group_code IS NOT DISTINCT FROM g.salesperson_group_code""", "sales_order"))
def q_year_from_states(spark, sf):
    key, ref = "salesperson_group_code", F.lit(REF).cast("date")
    sales, path = _T(spark, sf).sales_order, _place(spark, "states")
    states = partials.monthly_states(sales, [key], "invoice_date", measure="product_amount", distinct="partner_code", item="salesperson_name")
    states.repartition("month").write.partitionBy("month").parquet(path)
    start, month = C.lookback_start(REF, 12), F.trunc(ref, "month")
    got = partials.over_months(spark.read.parquet(path), [key], start, month)
    facts = sales.where((F.col("invoice_date") >= start) & (F.col("invoice_date") < F.add_months(month, 1))).select(F.col(key).alias("_k"), "partner_code", "product_amount")
    v, q, n = F.col("product_amount").cast("double"), F.col("quantile"), F.count("*")
    held = got.join(facts, F.col(key).eqNullSafe(F.col("_k"))).groupBy(key, "n_rows", "amount", "distinct", "quantile", F.col("top")[0]["count"].alias("top_rows")).agg(
        F.countDistinct("partner_code").alias("_clients"), (C.count_if(v < q) / n).alias("_below"), (C.count_if(v <= q) / n).alias("_upto"))
    return held.select(key, "n_rows", C.money("amount").alias("amount"), "top_rows", (F.abs(F.col("distinct") - F.col("_clients")) <= 0.05 * F.col("_clients")).alias("clients_near"),
                       ((F.col("_below") <= 0.53) & (F.col("_upto") >= 0.47)).alias("median_near"))
