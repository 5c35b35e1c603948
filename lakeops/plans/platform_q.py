"""Registered data-platform queries: watermarks and run log (INC), source readers (SRC),
row-count validation (SNK-5) and projections (PRJ)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import increment as INC
from lakeops.operators import projection as PJ
from lakeops.operators.cdc import one_per_key
from lakeops.plans.oracle_views import with_views
from lakeops.plans.registry import register
from lakeops.sources import readers as R
from lakeops.sources import sinks as SK
from lakeops.sources.driver import EVENTS_NOW, DriverTables

NOW = EVENTS_NOW
SPLIT = "2024-01-15 00:00:00"


def _T(spark, sf):
    return DriverTables(spark, sf)


# -- INC ----------------------------------------------------------------------------

@register("max_watermark", with_views("SELECT CAST(MAX(updated_at) AS TIMESTAMP) AS watermark FROM sales_order", "sales_order"))
def q_max_wm(spark, sf):
    return INC.max_watermark(_T(spark, sf).sales_order, "updated_at")


@register("max_watermark_date", with_views("SELECT CAST(MAX(invoice_date) AS TIMESTAMP) AS watermark FROM sales_order",
                                           "sales_order"))
def q_max_wm_date(spark, sf):
    return INC.max_watermark(_T(spark, sf).sales_order, "invoice_date")


def _control(T):
    r = T.runs.where((F.col("status") == "ok") & (F.col("started_at") < F.lit(SPLIT).cast("timestamp_ntz")))
    c = r.select("source", "entity", F.col("max_event_at").alias("watermark"), F.col("started_at").alias("run_time"),
                 F.col("rows_loaded").alias("rows"), "mode")
    return one_per_key(c, ["source", "entity"], ["run_time"])


_CONTROL_SQL = f"""SELECT source, entity, watermark, run_time, rows, mode FROM (
  SELECT source, entity, max_event_at AS watermark, started_at AS run_time, rows_loaded AS rows, mode,
         row_number() OVER (PARTITION BY source, entity ORDER BY started_at DESC) AS rn
  FROM runs WHERE status = 'ok' AND started_at < TIMESTAMP '{SPLIT}') WHERE rn = 1"""


@register("watermark_control", with_views(f"""
WITH c AS ({_CONTROL_SQL}),
m AS (SELECT source, entity, watermark, run_time, rows, mode FROM (
  SELECT source, entity, max_event_at AS watermark, started_at AS run_time, rows_loaded AS rows, mode,
         row_number() OVER (PARTITION BY source, entity ORDER BY started_at DESC) AS rn
  FROM runs WHERE status = 'ok' AND started_at >= TIMESTAMP '{SPLIT}') WHERE rn = 1)
SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.source = c.source AND m.entity = c.entity)
UNION ALL SELECT * FROM m""", "runs"))
def q_watermark_control(spark, sf):
    T = _T(spark, sf)
    r = T.runs.where(F.col("started_at") >= F.lit(SPLIT).cast("timestamp_ntz"))
    marks = r.select("source", "entity", F.col("max_event_at").alias("watermark"), F.col("started_at").alias("run_time"),
                     F.col("rows_loaded").alias("rows"), "mode", "status")
    return INC.set_watermarks(_control(T), marks)


@register("read_watermarks", with_views("""
SELECT source, entity, max_event_at AS watermark, 'run_log' AS origin FROM (
  SELECT *, row_number() OVER (PARTITION BY source, entity ORDER BY started_at DESC, max_event_at DESC) AS rn
  FROM runs WHERE status = 'ok' AND max_event_at IS NOT NULL) WHERE rn = 1""", "runs"))
def q_read_wm(spark, sf):
    return INC.read_watermarks(_T(spark, sf).runs)


@register("batch_max_event", "SELECT CAST(MAX(ts) AS TIMESTAMP) AS max_event_at FROM events")
def q_batch_max(spark, sf):
    return INC.batch_max_event(_T(spark, sf).raw("events"), "ts")


@register("run_summary", with_views("""
SELECT status, COUNT(*) AS runs, CAST(SUM(rows_extracted) AS BIGINT) AS rows_extracted,
       CAST(SUM(rows_loaded) AS BIGINT) AS rows_loaded, ROUND(SUM(seconds), 3) AS seconds FROM runs GROUP BY status""", "runs"))
def q_run_summary(spark, sf):
    return INC.run_summary(_T(spark, sf).runs)


@register("slowest_runs", with_views("""
SELECT run_id, source, entity, status, seconds FROM runs ORDER BY seconds DESC, run_id LIMIT 10""", "runs"))
def q_slowest(spark, sf):
    return INC.slowest_runs(_T(spark, sf).runs)


@register("freshness", with_views("""
SELECT source, entity, started_at, status, rows_loaded, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, entity ORDER BY started_at DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1""",
                                  "runs"))
def q_freshness(spark, sf):
    return INC.freshness(_T(spark, sf).runs)


_AGE = f"(epoch_us(TIMESTAMP '{NOW}') - epoch_us(l.last_ok_at)) // 60000000"


@register("freshness_status", with_views(f"""
SELECT l.source, l.last_ok_at, t.threshold_minutes, {_AGE} AS age_minutes,
       CASE WHEN l.last_ok_at IS NULL THEN 'sem leitura' WHEN {_AGE} <= t.threshold_minutes THEN 'green'
            WHEN {_AGE} <= t.threshold_minutes * 2 THEN 'amber' ELSE 'red' END AS state
FROM (SELECT source, MAX(started_at) AS last_ok_at FROM runs WHERE status = 'ok' AND started_at < TIMESTAMP '{SPLIT}'
      GROUP BY source) l
LEFT JOIN fresh_thresholds t ON t.source = l.source""", "runs", "fresh_thresholds"))
def q_fresh_status(spark, sf):
    T = _T(spark, sf)
    last = INC.last_ok(T.runs.where(F.col("started_at") < F.lit(SPLIT).cast("timestamp_ntz")))
    return INC.freshness_status(last, T.fresh_thresholds, NOW)


@register("runs_digest", with_views(f"""
SELECT source, strftime(MAX(started_at) - INTERVAL 3 HOUR, '%d/%m/%Y %H:%M') AS last_load_local,
       (epoch_us(TIMESTAMP '{NOW}') - epoch_us(MAX(started_at))) // 60000000 AS age_minutes,
       COUNT(CASE WHEN CAST(started_at - INTERVAL 3 HOUR AS DATE) = CAST(TIMESTAMP '{NOW}' - INTERVAL 3 HOUR AS DATE) THEN 1 END) AS loads_today,
       COUNT(*) AS loads_total
FROM runs GROUP BY source""", "runs"))
def q_runs_digest(spark, sf):
    return INC.runs_digest(_T(spark, sf).runs, NOW)


@register("last_load", with_views("SELECT strftime(MAX(started_at) - INTERVAL 3 HOUR, '%d/%m/%Y %H:%M') AS last_load FROM runs",
                                  "runs"))
def q_last_load(spark, sf):
    return INC.last_load(_T(spark, sf).runs, "started_at")


# -- SRC ----------------------------------------------------------------------------

def purchase_lines_spec(sf: str) -> R.EntitySpec:
    return R.EntitySpec(
        name="fact_purchase_line", path=f"{sf}/lineitem.parquet", predicate="l_returnflag = 'R'",
        columns={"order_number": "CAST(l_orderkey AS STRING)", "line_number": "l_linenumber",
                 "supplier_code": "l_suppkey", "quantity": "CAST(l_quantity AS DECIMAL(18,4))",
                 "amount": "CAST(l_extendedprice AS DECIMAL(18,2))", "invoice_date": "CAST(l_shipdate AS DATE)"},
        key=("order_number", "line_number"), watermark="invoice_date")


@register("read_entity_purchases", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_number, l_linenumber AS line_number, l_suppkey AS supplier_code,
       CAST(l_quantity AS DECIMAL(18,4)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CAST(l_shipdate AS DATE) AS invoice_date
FROM lineitem WHERE l_returnflag = 'R'""")
def q_read_entity(spark, sf):
    return R.read_entity(spark, purchase_lines_spec(sf))


@register("read_delta_orders", with_views("""
SELECT * FROM sales_order WHERE updated_at >= TIMESTAMP '2001-06-01 00:00:00' OR excluded_at >= TIMESTAMP '2001-06-01 00:00:00'""",
                                          "sales_order"))
def q_read_delta(spark, sf):
    return R.read_delta(_T(spark, sf).sales_order, "updated_at", "2001-06-01 00:00:00", "excluded_at")


@register("header_lines", with_views("""
SELECT i.order_number, i.line_number, i.operation_type, i.item_code, i.quantity, i.unit_price, i.icms_amount, i.ipi_amount,
       COALESCE(i.excluded_at, o.excluded_at) AS excluded_at, o.partner_code, o.invoice_date
FROM order_item i JOIN sales_order o ON o.order_number = i.order_number""", "order_item", "sales_order"))
def q_header_lines(spark, sf):
    T = _T(spark, sf)
    return R.header_lines(T.sales_order, T.order_item, "order_number", inherit=["excluded_at"],
                          header_cols=["partner_code", "invoice_date"])


@register("role_lookup_deals", with_views("""
SELECT d.deal_id, d.owner_id, d.org_id % 11 AS creator_id, u1.user_name AS owner_name, u2.user_name AS creator_name
FROM deals d LEFT JOIN crm_users u1 ON u1.user_id = d.owner_id LEFT JOIN crm_users u2 ON u2.user_id = d.org_id % 11""",
                                          "deals", "crm_users"))
def q_role_lookup(spark, sf):
    T = _T(spark, sf)
    f = T.deals.select("deal_id", "owner_id", (F.col("org_id") % 11).alias("creator_id"))
    return R.role_lookup(f, T.crm_users, "user_id", "user_name", {"owner_id": "owner_name", "creator_id": "creator_name"})


@register("distinct_codes", with_views("""
SELECT DISTINCT code FROM (
  SELECT trim(channel_code) AS code FROM sales_order UNION ALL SELECT trim(nature_code) FROM sales_order
  UNION ALL SELECT trim(salesperson_group_code) FROM sales_order UNION ALL SELECT trim(CAST(order_status AS VARCHAR)) FROM sales_order)
WHERE code IS NOT NULL AND code <> ''""", "sales_order"))
def q_distinct_codes(spark, sf):
    return R.distinct_codes(_T(spark, sf).sales_order, ["channel_code", "nature_code", "salesperson_group_code", "order_status"])


@register("derive_lifecycle", with_views("""
SELECT order_number, excluded_at, excluded_at IS NULL AS is_active, COALESCE(excluded_at, updated_at) AS updated_at,
       NULLIF(channel_code, '') AS channel_code FROM sales_order""", "sales_order"))
def q_lifecycle(spark, sf):
    df = _T(spark, sf).sales_order.select("order_number", "excluded_at", "updated_at", "channel_code")
    out = R.derive_lifecycle(df, "excluded_at", changed="excluded_at", created="updated_at", blank_to_null=["channel_code"])
    return out


@register("document_lines", """
SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS position, unnest(arr) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents)""")
def q_doc_lines(spark, sf):
    d = _T(spark, sf).raw("documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return R.explode_children(d, "lines", "doc_id", "line")


# -- SNK-5 ---------------------------------------------------------------------------

@register("validate_counts", with_views("""
WITH e AS (SELECT 'orders' AS entity, COUNT(*) AS expected FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
           UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'part', COUNT(*) FROM part),
a AS (SELECT 'orders' AS entity, COUNT(*) AS actual FROM sales_order UNION ALL SELECT 'lineitem', COUNT(*) FROM order_item
      UNION ALL SELECT 'customer', COUNT(*) FROM partner WHERE is_active UNION ALL SELECT 'bom', COUNT(*) FROM bom)
SELECT COALESCE(e.entity, a.entity) AS entity, COALESCE(e.expected, -1) AS expected, COALESCE(a.actual, -1) AS actual,
       COALESCE(a.actual, -1) - COALESCE(e.expected, -1) AS diff,
       COALESCE(a.actual, -1) - COALESCE(e.expected, -1) = 0 AS ok
FROM e FULL OUTER JOIN a ON a.entity = e.entity""", "sales_order", "order_item", "partner", "bom"))
def q_validate_counts(spark, sf):
    T = _T(spark, sf)
    exp = SK.counts({"orders": T.raw("orders"), "lineitem": T.raw("lineitem"), "customer": T.raw("customer"),
                     "part": T.raw("part")})
    act = SK.counts({"orders": T.sales_order, "lineitem": T.order_item, "customer": T.partner.where("is_active"),
                     "bom": T.bom})
    return SK.validate_counts(exp, act)


# -- PRJ ------------------------------------------------------------------------------

RAW_SCHEMA = {"order_key": "bigint", "qty": "double", "ship": "date", "flag": "boolean", "name": "string", "missing_col": "int"}


def _raw_lines(T):
    li = T.raw("lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        F.when(ln == 7, F.lit("n/a")).otherwise(F.col("l_orderkey").cast("string")).alias("order_key"),
        F.col("l_quantity").cast("string").alias("qty"),
        F.when(ln == 6, F.lit("2001-13-45")).otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("ship"),
        F.when(F.col("l_returnflag") == "A", "yes").when(F.col("l_returnflag") == "N", "0").otherwise("maybe").alias("flag"),
        F.when(ln == 5, F.lit(" None ")).otherwise(F.concat(F.lit(" "), F.col("l_returnflag"), F.lit("  "))).alias("name"),
    )


_RAW_SQL = """SELECT CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_orderkey AS VARCHAR) END AS order_key,
       CAST(l_quantity AS VARCHAR) AS qty,
       CASE WHEN l_linenumber = 6 THEN '2001-13-45' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS ship,
       CASE WHEN l_returnflag = 'A' THEN 'yes' WHEN l_returnflag = 'N' THEN '0' ELSE 'maybe' END AS flag,
       CASE WHEN l_linenumber = 5 THEN ' None ' ELSE ' ' || l_returnflag || '  ' END AS name FROM lineitem"""


@register("cast_to_schema", f"""
SELECT TRY_CAST(trim(order_key) AS BIGINT) AS order_key, TRY_CAST(trim(qty) AS DOUBLE) AS qty,
       TRY_CAST(trim(ship) AS DATE) AS ship,
       CASE WHEN lower(trim(flag)) IN ('true', '1', 'yes', 't') THEN TRUE
            WHEN lower(trim(flag)) IN ('false', '0', 'no', 'f') THEN FALSE END AS flag,
       CASE WHEN trim(replace(name, chr(0), '')) IN ('', 'None', 'nan', 'NaN') THEN NULL ELSE trim(replace(name, chr(0), '')) END AS name,
       CAST(NULL AS INTEGER) AS missing_col
FROM ({_RAW_SQL}) r""")
def q_cast_schema(spark, sf):
    return PJ.cast_to_schema(_raw_lines(_T(spark, sf)), RAW_SCHEMA)


@register("clean_strings", f"""
SELECT CASE WHEN trim(replace(name, chr(0), '')) IN ('', 'None', 'nan', 'NaN') THEN NULL ELSE trim(replace(name, chr(0), '')) END AS name,
       CASE WHEN trim(replace(flag, chr(0), '')) IN ('', 'None', 'nan', 'NaN') THEN NULL ELSE trim(replace(flag, chr(0), '')) END AS flag,
       order_key, qty, ship
FROM ({_RAW_SQL}) r""")
def q_clean_strings(spark, sf):
    return PJ.clean_strings(_raw_lines(_T(spark, sf)), ["name", "flag"])


@register("dedup_report", """
SELECT COUNT(*) AS rows_in, (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_out,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS removed FROM lineitem""")
def q_dedup_report(spark, sf):
    from lakeops.operators.cdc import dedup

    li = _T(spark, sf).raw("lineitem")
    out = dedup(li, ["l_orderkey", "l_linenumber"])
    a = li.agg(F.count("*").alias("rows_in"))
    b = out.agg(F.count("*").alias("rows_out"))
    return a.crossJoin(b).withColumn("removed", F.col("rows_in") - F.col("rows_out"))


@register("seq_key_orders", """
SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER (ORDER BY o_orderkey) AS sk_order FROM orders""")
def q_seq_key(spark, sf):
    o = _T(spark, sf).raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return PJ.add_seq_key(o, "sk_order", ["o_orderkey"])


@register("hash_key_items", with_views("""
SELECT order_number, line_number, item_code,
       CAST('0x' || substr(md5(concat_ws(chr(31), COALESCE(CAST(order_number AS VARCHAR), chr(0)),
            COALESCE(CAST(CAST(line_number AS DECIMAL(38,0)) AS VARCHAR), chr(0)),
            COALESCE(CAST(item_code AS VARCHAR), chr(0)))), 1, 15) AS BIGINT) AS sk_item_line
FROM order_item""", "order_item"))
def q_hash_key(spark, sf):
    it = _T(spark, sf).order_item.select("order_number", "line_number", "item_code")
    return PJ.add_hash_key(it, "sk_item_line", ["order_number", "line_number", "item_code"], integer_cols=["line_number"])


@register("envelope_events", """
SELECT 'run-1' AS run_id, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, 'events' AS source, 'analytics' AS domain,
       CAST(event_id AS VARCHAR) AS record_id, ts AS record_event_at,
       CAST(json_object('event_id', event_id, 'event_type', event_type, 'props', props) AS VARCHAR) AS payload_json
FROM events""")
def q_envelope(spark, sf):
    e = _T(spark, sf).raw("events").select("event_id", "event_type", "props", "user_id", "ts")
    return PJ.to_envelope(e, "events", "run-1", "2024-02-01 00:00:00", "event_id", "ts",
                          extras={"domain": F.lit("analytics")}, drop=["user_id", "ts"])


@register("project_typed_props", """
SELECT event_id, props, TRY_CAST(trim(json_extract_string(props, '$.k')) AS INTEGER) AS k, 'events' AS source
FROM events""")
def q_project_typed(spark, sf):
    e = _T(spark, sf).raw("events").select("event_id", "props")
    return PJ.project_typed(e, "props", [("k", "$.k", "int"), ("source", "$context.source", "string")],
                            context={"source": "events"})
