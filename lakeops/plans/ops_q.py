"""Registered operations / engineering / service queries (A-OPS-1..8, A-SAC-1..4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.operators import operations as OP
from lakeops.operators import service as SV
from lakeops.plans import sqlfrag as S
from lakeops.plans.loads_q import _place
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import EVENTS_NOW, SALES_REF, DriverTables

NOW = EVENTS_NOW


def _T(spark, sf):
    return DriverTables(spark, sf)


@register("production_monthly", with_views("""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(DISTINCT prod_order_number) AS orders,
       CAST(SUM(planned_qty) AS DECIMAL(18,4)) AS planned, CAST(SUM(actual_qty) AS DECIMAL(18,4)) AS actual,
       CAST(CAST(SUM(actual_qty) AS DECIMAL(18,4)) AS DOUBLE) * 100.0 / NULLIF(CAST(CAST(SUM(planned_qty) AS DECIMAL(18,4)) AS DOUBLE), 0) AS efficiency_pct
FROM production WHERE excluded_at IS NULL AND order_date >= CAST(DATE '2001-08-01' - INTERVAL 13 MONTH AS DATE) GROUP BY 1""", "production"))
def q_prod_monthly(spark, sf):
    return OP.production_monthly(_T(spark, sf).production, SALES_REF)


@register("production_status", with_views(f"""
SELECT {S.lookup('prod_status', OP.PROD_STATUS, 'Outro')} AS status, COUNT(DISTINCT prod_order_number) AS orders,
       CAST(SUM(planned_qty) AS DECIMAL(18,4)) AS planned FROM production WHERE excluded_at IS NULL GROUP BY 1""", "production"))
def q_prod_status(spark, sf):
    return OP.production_status(_T(spark, sf).production)


@register("top_components", with_views("""
WITH g AS (SELECT item_code, CAST(SUM(quantity) AS DECIMAL(18,4)) AS quantity, COUNT(DISTINCT prod_order_number) AS orders
           FROM components WHERE excluded_at IS NULL GROUP BY 1 ORDER BY quantity DESC, item_code LIMIT 20)
SELECT g.*, i.item_name FROM g LEFT JOIN item i ON i.item_code = g.item_code""", "components", "item"))
def q_top_components(spark, sf):
    T = _T(spark, sf)
    return OP.top_components(T.components, T.item)


_STOCK_POS = """SELECT s.* EXCLUDE (excluded_at), i.item_name, i.group_code FROM stock s LEFT JOIN item i ON i.item_code = s.item_code
WHERE s.snapshot_date = (SELECT MAX(snapshot_date) FROM stock) AND s.excluded_at IS NULL AND s.general_balance > 0"""


@register("stock_items", with_views(_STOCK_POS, "stock", "item"))
def q_stock_items(spark, sf):
    T = _T(spark, sf)
    return OP.stock_items(T.stock, T.item)


@register("stock_by_group", with_views(f"""
SELECT group_code, COUNT(*) AS items, CAST(SUM(general_balance) AS DECIMAL(18,4)) AS units FROM ({_STOCK_POS}) x GROUP BY 1""",
                                       "stock", "item"))
def q_stock_group(spark, sf):
    T = _T(spark, sf)
    return OP.stock_by_group(OP.stock_items(T.stock, T.item))


@register("stock_movement", with_views(f"""
SELECT CAST(date_trunc('month', movement_date) AS DATE) AS month,
       CAST(COALESCE(SUM(CASE WHEN operation_type = 'E' THEN quantity END), 0) AS DECIMAL(18,4)) AS units_in,
       CAST(COALESCE(SUM(CASE WHEN operation_type = 'S' THEN quantity END), 0) AS DECIMAL(18,4)) AS units_out
FROM movements WHERE excluded_at IS NULL
  AND movement_date BETWEEN CAST(DATE '{SALES_REF}' - INTERVAL 13 MONTH AS DATE) AND DATE '{SALES_REF}' GROUP BY 1""",
                                       "movements"))
def q_stock_movement(spark, sf):
    return OP.stock_movement(_T(spark, sf).movements, SALES_REF)


@register("bom_lines", with_views(f"""
SELECT b.* EXCLUDE (excluded_at), p.item_name AS parent_name, c.item_name AS child_name, {S.lookup('b.link_type', OP.LINK_LABELS, 'Outro')} AS link_label
FROM bom b LEFT JOIN item p ON p.item_code = b.parent_item_code LEFT JOIN item c ON c.item_code = b.child_item_code WHERE b.excluded_at IS NULL""",
                                  "bom", "item"))
def q_bom_lines(spark, sf):
    T = _T(spark, sf)
    return OP.bom_lines(T.bom, T.item)


@register("bom_kpis", with_views("""
SELECT COUNT(*) AS lines, COUNT(DISTINCT parent_item_code) AS parents, COUNT(DISTINCT child_item_code) AS children,
       CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT parent_item_code) AS DOUBLE), 0) AS children_per_parent FROM bom WHERE excluded_at IS NULL""",
                                 "bom"))
def q_bom_kpis(spark, sf):
    return OP.bom_kpis(_T(spark, sf).bom)


@register("bom_explode", with_views(f"""
WITH RECURSIVE e AS (SELECT parent_item_code, child_item_code, CAST(quantity AS DECIMAL(38,6)) AS quantity FROM bom WHERE excluded_at IS NULL),
x(root_item_code, item_code, level, total_quantity, path) AS (
  SELECT parent_item_code, child_item_code, 1, quantity, parent_item_code || '{P.BOM_PATH_SEP}' || child_item_code FROM e
  UNION ALL
  SELECT x.root_item_code, e.child_item_code, x.level + 1, CAST(x.total_quantity * e.quantity AS DECIMAL(38,6)),
         x.path || '{P.BOM_PATH_SEP}' || e.child_item_code
  FROM x JOIN e ON e.parent_item_code = x.item_code WHERE x.level < {P.BOM_MAX_DEPTH})
SELECT root_item_code, item_code, CAST(level AS INTEGER) AS level, total_quantity, path FROM x""", "bom"))
def q_bom_explode(spark, sf):
    return OP.bom_explode(_T(spark, sf).bom)


@register("catalog_kpis", with_views("""
SELECT COUNT(*) AS items, COUNT(CASE WHEN is_active THEN 1 END) AS active, COUNT(DISTINCT group_code) AS groups,
       COUNT(DISTINCT family_code) AS families FROM item""", "item"))
def q_catalog_kpis(spark, sf):
    return OP.catalog_kpis(_T(spark, sf).item)


@register("catalog_mix", with_views("""
SELECT group_code, COUNT(*) AS items FROM item GROUP BY 1 ORDER BY items DESC, group_code LIMIT 10""", "item"))
def q_catalog_mix(spark, sf):
    return OP.catalog_mix(_T(spark, sf).item)


@register("catalog_search", with_views("""
WITH h AS (SELECT * FROM item WHERE item_code ILIKE '%bolt%' OR item_name ILIKE '%bolt%')
SELECT h2.*, (SELECT COUNT(*) FROM h) AS total FROM (SELECT * FROM h ORDER BY item_code LIMIT 50 OFFSET 50) h2""", "item"))
def q_catalog_search(spark, sf):
    return OP.catalog_search(_T(spark, sf).item, "bolt", page=2, size=50)


@register("serials_per_item", with_views("""
WITH g AS (SELECT item_code, COUNT(DISTINCT serial_number) AS serials, COUNT(CASE WHEN is_in_use = 'X' THEN 1 END) AS in_use,
                  COUNT(DISTINCT batch_number) AS lots FROM serials WHERE excluded_at IS NULL GROUP BY 1)
SELECT g.*, i.item_name FROM g LEFT JOIN item i ON i.item_code = g.item_code""", "serials", "item"))
def q_serials(spark, sf):
    T = _T(spark, sf)
    return OP.serials(T.serials, T.item)


# -- service -----------------------------------------------------------------------------

_HOURS = f"CAST(trunc((epoch_us(COALESCE(won_time, lost_time, TIMESTAMP '{NOW}')) - epoch_us(add_time)) / 3600000000.0) AS BIGINT)"
_OPENED = "CAST(date_trunc('month', CAST(add_time AS DATE)) AS DATE)"


@register("tickets", with_views(f"""
SELECT {_OPENED} AS month, pipeline_id, COALESCE(status, 'open') AS status, COUNT(*) AS tickets, AVG({_HOURS}) AS mean_hours
FROM deals WHERE add_time IS NOT NULL GROUP BY 1, 2, 3""", "deals"))
def q_tickets(spark, sf):
    return SV.tickets(_T(spark, sf).deals, NOW)


@register("resolution_rate", with_views(f"""
WITH t AS (SELECT {_OPENED} AS month, COALESCE(status, 'open') AS status, {_HOURS} AS h FROM deals WHERE add_time IS NOT NULL),
g AS (SELECT month, COUNT(*) AS tickets, COUNT(CASE WHEN status = 'won' THEN 1 END) AS resolved,
             COUNT(CASE WHEN status NOT IN ('won', 'lost') THEN 1 END) AS open, AVG(h) AS mean_hours FROM t GROUP BY ROLLUP (month))
SELECT *, CAST(resolved AS DOUBLE) * 100.0 / NULLIF(CAST(tickets AS DOUBLE), 0) AS resolution_pct FROM g""", "deals"))
def q_resolution_rate(spark, sf):
    return SV.resolution_rate(_T(spark, sf).deals, NOW)


@register("sla_resolution", with_views(f"""
SELECT {_OPENED} AS month, COUNT(*) AS tickets, AVG({_HOURS}) AS mean_hours FROM deals WHERE add_time IS NOT NULL GROUP BY 1""", "deals"))
def q_sla(spark, sf):
    return SV.sla_resolution(_T(spark, sf).deals, NOW)


_FIRST_REPLY = """SELECT CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month, COUNT(*) AS replied,
       CAST(quantile_disc(event_id % 120 - 10, 0.5) AS BIGINT) AS median_minutes
FROM events WHERE event_id % 7 <> 0 AND event_id % 120 - 10 >= 0 AND user_id % 2 = 0 GROUP BY 1"""


@register("first_reply", _FIRST_REPLY)
def q_first_reply(spark, sf):
    return SV.first_reply(_T(spark, sf).chats)


@register("first_reply_kpi", f"SELECT CAST(quantile_cont(median_minutes, 0.5) AS DOUBLE) AS median_minutes, COUNT(*) AS months FROM ({_FIRST_REPLY})")
def q_first_reply_kpi(spark, sf):
    return SV.first_reply_kpi(SV.first_reply(_T(spark, sf).chats))


@register("calls_summary", with_views("""
SELECT CAST(date_trunc('month', CAST(call_created AS DATE)) AS DATE) AS month, direction, ai_sentiment, COUNT(*) AS calls,
       CAST(SUM(duration_seconds) AS DOUBLE) / 60.0 AS minutes,
       (CAST(SUM(duration_seconds) AS DOUBLE) / 60.0) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS mean_minutes
FROM calls GROUP BY 1, 2, 3""", "calls"))
def q_calls_summary(spark, sf):
    return SV.calls_summary(_T(spark, sf).calls)


@register("calls_window", with_views("""
SELECT MIN(call_created) AS first_call, MAX(call_created) AS last_call, COUNT(*) AS calls FROM calls""", "calls"))
def q_calls_window(spark, sf):
    return SV.calls_window(_T(spark, sf).calls)


@register("chats_summary", """
SELECT CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month,
       CASE WHEN event_id % 2 = 0 THEN 'WhatsApp' ELSE 'Email' END AS channel, COUNT(*) AS chats,
       COUNT(CASE WHEN event_id % 5 = 0 THEN 1 END) AS open
FROM events WHERE user_id % 2 = 0 GROUP BY 1, 2""")
def q_chats(spark, sf):
    return SV.chats_summary(_T(spark, sf).chats, "SAC")


# the chats are parsed once into a stored VARIANT; the panel reads that table by path
@register("chat_panel", """
SELECT CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month, CASE WHEN user_id % 2 = 0 THEN 'SAC' ELSE 'Comercial' END AS sector,
       COUNT(*) AS chats, COUNT(CASE WHEN event_id % 5 = 0 THEN 1 END) AS open,
       COUNT(CASE WHEN event_id % 7 <> 0 AND event_id % 120 - 10 >= 0 THEN 1 END) AS replied,
       CAST(quantile_disc(CASE WHEN event_id % 7 <> 0 AND event_id % 120 - 10 >= 0 THEN event_id % 120 - 10 END, 0.5) AS BIGINT) AS median_minutes
FROM events GROUP BY 1, 2""")
def q_chat_panel(spark, sf):
    path = _place(spark, "chats")
    SV.with_variant(_T(spark, sf).chats).write.parquet(path)
    return SV.chat_panel(spark.read.parquet(path))
