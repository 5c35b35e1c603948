"""Registered CDC / merge queries over snapshots derived from the driver tables.

Yesterday's order snapshot is every order with ``o_orderkey % 10 <> 9``; today's
delta re-extracts the orders of 2001 plus the new ones, and repeats every
seventh key with an older version, so dedup-before-merge is exercised.
The file catalogue comes from ``documents`` (path by source/lang).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import cdc
from lakeops.plans.oracle_views import view, with_views
from lakeops.plans.registry import register
from lakeops.sources.driver import DriverTables, money

TS = "2001-08-02 00:00:00"
CDC_COLS = ["order_number", "partner_code", "order_date", "invoice_date", "order_status", "product_amount", "updated_at",
            "excluded_at"]
VERSION_OF = ["order_status", "product_amount", "invoice_date"]
EXT_BY_LANG = [("en", "pdf"), ("fr", "docx"), ("de", "xlsx"), ("es", "png")]
CATALOG_EXT = ["pdf", "docx", "xlsx"]
OFFICIAL = ["/src0", "/src1", "/src2"]


def _target(T):
    return T.sales_order.where(F.col("quote_number") % 10 != 9).select(*CDC_COLS)


def _delta(T):
    s = T.sales_order.where((F.col("order_date") >= F.lit("2001-01-01").cast("date")) | (F.col("quote_number") % 10 == 9))
    k = F.col("quote_number")
    new = s.select("order_number", "partner_code", "order_date", "invoice_date", "order_status",
                   F.when(k % 3 == 0, money(F.col("product_amount") * F.lit(1.01).cast("decimal(3,2)")))
                   .otherwise(F.col("product_amount")).alias("product_amount"),
                   (F.col("updated_at") + F.make_dt_interval(F.lit(1))).alias("updated_at"), "excluded_at")
    old = s.where(k % 7 == 0).select("order_number", "partner_code", "order_date", "invoice_date", "order_status",
                                     money(F.col("product_amount") - F.lit(1)).alias("product_amount"),
                                     "updated_at", "excluded_at")
    return new.unionByName(old)


view("cdc_target", f"SELECT {', '.join(CDC_COLS)} FROM sales_order WHERE quote_number % 10 <> 9", ["sales_order"])
view("cdc_delta", """
SELECT order_number, partner_code, order_date, invoice_date, order_status,
       CASE WHEN quote_number % 3 = 0 THEN CAST(product_amount * CAST(1.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) ELSE product_amount END AS product_amount,
       updated_at + INTERVAL 1 DAY AS updated_at, excluded_at
FROM sales_order WHERE order_date >= DATE '2001-01-01' OR quote_number % 10 = 9
UNION ALL
SELECT order_number, partner_code, order_date, invoice_date, order_status, CAST(product_amount - 1 AS DECIMAL(18,2)),
       updated_at, excluded_at
FROM sales_order WHERE (order_date >= DATE '2001-01-01' OR quote_number % 10 = 9) AND quote_number % 7 = 0""", ["sales_order"])
view("cdc_delta1", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_number ORDER BY updated_at DESC) AS rn
FROM cdc_delta) WHERE rn = 1""", ["cdc_delta"])


def _hash_sql(cols):
    return "md5(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + "))"


@register("dedup_latest_per_key", with_views("SELECT * FROM cdc_delta1", "cdc_delta1"))
def q_dedup(spark, sf):
    return cdc.one_per_key(_delta(DriverTables(spark, sf)), "order_number", "updated_at")


@register("upsert_orders", with_views("""
SELECT t.* FROM cdc_target t WHERE NOT EXISTS (SELECT 1 FROM cdc_delta1 d WHERE d.order_number = t.order_number)
UNION ALL SELECT * FROM cdc_delta1""", "cdc_target", "cdc_delta1"))
def q_upsert(spark, sf):
    T = DriverTables(spark, sf)
    return cdc.upsert(_target(T), _delta(T), "order_number", "updated_at")


@register("archive_changed_orders", with_views(f"""
SELECT t.*, TIMESTAMP '{TS}' AS archived_at
FROM (SELECT *, {_hash_sql(VERSION_OF)} AS version FROM cdc_target) t
JOIN (SELECT order_number, {_hash_sql(VERSION_OF)} AS nv FROM cdc_delta1) d ON d.order_number = t.order_number
WHERE t.version IS DISTINCT FROM d.nv""", "cdc_target", "cdc_delta1"))
def q_archive(spark, sf):
    T = DriverTables(spark, sf)
    t = _target(T).withColumn("version", cdc.row_hash(VERSION_OF))
    d = cdc.one_per_key(_delta(T), "order_number", "updated_at").withColumn("version", cdc.row_hash(VERSION_OF))
    return cdc.archive_changed(t, d, "order_number", "version", TS)


@register("soft_delete_missing", with_views(f"""
SELECT t.order_number, t.partner_code, t.order_date, t.invoice_date, t.order_status, t.product_amount, t.updated_at,
       CASE WHEN p.order_number IS NULL AND t.excluded_at IS NULL THEN TIMESTAMP '{TS}' ELSE t.excluded_at END AS excluded_at,
       (CASE WHEN p.order_number IS NULL AND t.excluded_at IS NULL THEN TIMESTAMP '{TS}' ELSE t.excluded_at END) IS NULL AS is_active
FROM cdc_target t LEFT JOIN (SELECT DISTINCT order_number FROM sales_order WHERE quote_number % 11 <> 0) p
  ON p.order_number = t.order_number""", "cdc_target", "sales_order"))
def q_soft_delete(spark, sf):
    T = DriverTables(spark, sf)
    present = T.sales_order.where(F.col("quote_number") % 11 != 0)
    return cdc.soft_delete_missing(_target(T), present, "order_number", TS)


@register("preserve_first_seen", with_views("""
SELECT d.order_number, d.partner_code, d.order_date, d.invoice_date, d.order_status, d.product_amount, d.updated_at,
       d.excluded_at, COALESCE(CAST(t.order_date AS TIMESTAMP), d.updated_at) AS first_seen_at
FROM cdc_delta1 d LEFT JOIN cdc_target t ON t.order_number = d.order_number""", "cdc_delta1", "cdc_target"))
def q_preserve(spark, sf):
    T = DriverTables(spark, sf)
    d = cdc.one_per_key(_delta(T), "order_number", "updated_at").withColumn("first_seen_at", F.col("updated_at"))
    t = _target(T).withColumn("first_seen_at", F.col("order_date").cast("timestamp_ntz"))
    return cdc.preserve_columns(d, t, "order_number", "first_seen_at")


@register("replace_window_orders", with_views("""
SELECT * FROM cdc_target WHERE order_date < DATE '2001-06-01' OR order_date IS NULL
UNION ALL SELECT * FROM cdc_delta1 WHERE order_date >= DATE '2001-06-01'""", "cdc_target", "cdc_delta1"))
def q_replace_window(spark, sf):
    T = DriverTables(spark, sf)
    d = cdc.one_per_key(_delta(T), "order_number", "updated_at").where(F.col("order_date") >= F.lit("2001-06-01").cast("date"))
    return cdc.replace_window(_target(T), d, "order_date", F.lit("2001-06-01").cast("date"))


@register("replace_period_months", with_views("""
WITH m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS value,
                  COUNT(*) AS n FROM cdc_target GROUP BY 1),
r AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(SUM(product_amount) AS DECIMAL(18,2)) AS value,
             COUNT(*) AS n FROM cdc_delta1 WHERE order_date >= DATE '2001-05-01' GROUP BY 1)
SELECT * FROM m WHERE month NOT IN (SELECT month FROM r) UNION ALL SELECT * FROM r""", "cdc_target", "cdc_delta1"))
def q_replace_period(spark, sf):
    T = DriverTables(spark, sf)

    def monthly(df):
        return df.groupBy(F.trunc("order_date", "month").alias("month")).agg(
            money(F.sum("product_amount")).alias("value"), F.count("*").alias("n"))

    d = cdc.one_per_key(_delta(T), "order_number", "updated_at").where(F.col("order_date") >= F.lit("2001-05-01").cast("date"))
    return cdc.replace_period(monthly(_target(T)), monthly(d), "month")


# -- file catalogue ---------------------------------------------------------------

def _files(T, salt: str | None = None):
    d = T.raw("documents")
    from lakeops import params as P

    ext = P.case_lookup(F.col("lang"), EXT_BY_LANG, "bin")
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), ext)
    content = F.col("text") if salt is None else F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(salt))).otherwise(F.col("text"))
    return d.select(path.alias("file_path"), content.alias("content"), "doc_id")


def _official(spark):
    return spark.createDataFrame([(x,) for x in OFFICIAL], "directory string")


_EXT_SQL = "CASE " + " ".join(f"WHEN lang = '{a}' THEN '{b}'" for a, b in EXT_BY_LANG) + " ELSE 'bin' END"
view("doc_files", f"""SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.' || {_EXT_SQL} AS file_path, text AS content, doc_id
FROM documents""")
view("doc_files_prev", f"""SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.' || {_EXT_SQL} AS file_path,
CASE WHEN doc_id % 5 = 0 THEN text || 'v0' ELSE text END AS content, doc_id FROM documents""")


def _catalog_sql(files: str) -> str:
    ext_list = ", ".join(f"'{e}'" for e in CATALOG_EXT)
    off = ", ".join(f"'{o}'" for o in OFFICIAL)
    return f"""SELECT c.*, COALESCE(c.directory IN ({off}), FALSE) AS is_official FROM (
  SELECT file_path, regexp_replace(file_path, '/[^/]*$', '') AS directory,
         regexp_extract(file_path, '[^/]*$') AS file_name,
         regexp_replace(regexp_extract(file_path, '[^/]*$'), '\\.[^.]*$', '') AS name,
         lower(regexp_extract(regexp_extract(file_path, '[^/]*$'), '[^.]*$')) AS extension,
         CAST(strlen(content) AS BIGINT) AS size_bytes, sha256(content) AS content_hash, doc_id
  FROM {files}) c WHERE extension IN ({ext_list})"""


@register("build_catalog", with_views(f"SELECT * EXCLUDE (doc_id) FROM ({_catalog_sql('doc_files')})", "doc_files"))
def q_build_catalog(spark, sf):
    T = DriverTables(spark, sf)
    return cdc.build_catalog(_files(T), CATALOG_EXT, _official(spark))


def _mirror(spark, sf):
    T = DriverTables(spark, sf)
    prev = (cdc.build_catalog(_files(T, "v0").where(F.col("doc_id") % 7 != 0), CATALOG_EXT, _official(spark))
            .withColumn("first_seen_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
            .withColumn("excluded_at", F.lit(None).cast("timestamp_ntz")))
    snap = (cdc.build_catalog(_files(T).where(F.col("doc_id") % 11 != 0), CATALOG_EXT, _official(spark))
            .withColumn("first_seen_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
            .withColumn("excluded_at", F.lit(None).cast("timestamp_ntz")))
    return cdc.mirror_catalog(prev, snap, "file_path", "content_hash", "2024-02-01 00:00:00")


_CAT_COLS = "file_path, directory, file_name, name, extension, size_bytes, content_hash, is_official"
_PREV = f"""SELECT {_CAT_COLS}, TIMESTAMP '2024-01-01 00:00:00' AS first_seen_at, CAST(NULL AS TIMESTAMP) AS excluded_at
FROM ({_catalog_sql('(SELECT * FROM doc_files_prev WHERE doc_id % 7 <> 0)')})"""
_SNAP = f"""SELECT {_CAT_COLS}, TIMESTAMP '2024-02-01 00:00:00' AS first_seen_at, CAST(NULL AS TIMESTAMP) AS excluded_at
FROM ({_catalog_sql('(SELECT * FROM doc_files WHERE doc_id % 11 <> 0)')})"""
_SNAP_P = f"""SELECT s.* EXCLUDE (first_seen_at), COALESCE(p.first_seen_at, s.first_seen_at) AS first_seen_at
FROM ({_SNAP}) s LEFT JOIN ({_PREV}) p ON p.file_path = s.file_path"""


@register("mirror_catalog_target", with_views(f"""
WITH prev AS ({_PREV}), snap AS ({_SNAP_P}),
merged AS (SELECT * FROM prev WHERE file_path NOT IN (SELECT file_path FROM snap)
           UNION ALL SELECT {_CAT_COLS}, first_seen_at, excluded_at FROM snap)
SELECT m.* EXCLUDE (excluded_at),
       CASE WHEN s.file_path IS NULL AND m.excluded_at IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE m.excluded_at END AS excluded_at,
       (CASE WHEN s.file_path IS NULL AND m.excluded_at IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE m.excluded_at END) IS NULL AS is_active
FROM merged m LEFT JOIN (SELECT DISTINCT file_path FROM ({_SNAP})) s ON s.file_path = m.file_path""", "doc_files", "doc_files_prev"))
def q_mirror_target(spark, sf):
    return _mirror(spark, sf)["target"]


@register("mirror_catalog_history", with_views(f"""
WITH prev AS ({_PREV}), snap AS ({_SNAP_P})
SELECT p.*, TIMESTAMP '2024-02-01 00:00:00' AS archived_at FROM prev p JOIN snap s ON s.file_path = p.file_path
WHERE p.content_hash IS DISTINCT FROM s.content_hash""", "doc_files", "doc_files_prev"))
def q_mirror_history(spark, sf):
    return _mirror(spark, sf)["history"]


# -- portfolio maintenance -----------------------------------------------------------

def _new_list(T):
    p = T.portfolio.where(F.col("partner_code") % 3 != 0)
    k = F.col("partner_code")
    first = p.select("partner_code", "partner_name", "rfv_familia",
                     F.when(k % 4 == 0, F.lit("OWNER NEW")).otherwise(F.col("salesperson_name")).alias("salesperson_name"),
                     "salesperson_group_code", F.lit(1).alias("_pos"))
    dup = p.where(k % 5 == 0).select("partner_code", "partner_name", "rfv_familia", F.lit("DUP").alias("salesperson_name"),
                                     "salesperson_group_code", F.lit(2).alias("_pos"))
    return first.unionByName(dup)


@register("sync_portfolio", with_views("""
WITH n0 AS (SELECT partner_code, partner_name, rfv_familia,
                   CASE WHEN partner_code % 4 = 0 THEN 'OWNER NEW' ELSE salesperson_name END AS salesperson_name,
                   salesperson_group_code, 1 AS _pos FROM portfolio WHERE partner_code % 3 <> 0
            UNION ALL
            SELECT partner_code, partner_name, rfv_familia, 'DUP', salesperson_group_code, 2
            FROM portfolio WHERE partner_code % 3 <> 0 AND partner_code % 5 = 0),
n AS (SELECT * EXCLUDE (rn, _pos), TRUE AS is_active FROM (
        SELECT *, row_number() OVER (PARTITION BY partner_code, rfv_familia ORDER BY _pos) AS rn FROM n0) WHERE rn = 1)
SELECT * FROM n
UNION ALL
SELECT c.partner_code, c.partner_name, c.rfv_familia, c.salesperson_name, c.salesperson_group_code, FALSE
FROM portfolio c WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.partner_code = c.partner_code AND n.rfv_familia = c.rfv_familia)""",
                                       "portfolio"))
def q_sync_portfolio(spark, sf):
    T = DriverTables(spark, sf)
    return cdc.sync_portfolio(_new_list(T), T.portfolio.drop("is_active"))


@register("assign_first_salesperson", with_views("""
SELECT p.*, COALESCE(a.salesperson_name, 'SEM VENDEDOR') AS salesperson_name
FROM partner p LEFT JOIN (
  SELECT partner_code, salesperson_name FROM (
    SELECT partner_code, salesperson_name, row_number() OVER (PARTITION BY partner_code ORDER BY quote_number, salesperson_name) AS rn
    FROM sales_order) WHERE rn = 1) a ON a.partner_code = p.partner_code""", "partner", "sales_order"))
def q_assign_first(spark, sf):
    T = DriverTables(spark, sf)
    return cdc.assign_first(T.partner, T.sales_order, "partner_code", "salesperson_name", "quote_number", "SEM VENDEDOR")


@register("redirect_owner", with_views("""
SELECT p.partner_code, p.partner_name, p.rfv_familia,
       CASE WHEN p.salesperson_name = 'OWNER 0' THEN COALESCE(m.new_owner, 'OWNER 1', p.salesperson_name) ELSE p.salesperson_name END AS salesperson_name,
       p.salesperson_group_code, p.is_active,
       (p.salesperson_name = 'OWNER 0' AND COALESCE(m.new_owner, 'OWNER 1', p.salesperson_name) <> p.salesperson_name) AS redirected
FROM portfolio p LEFT JOIN (SELECT partner_code, 'OWNER 9' AS new_owner FROM portfolio WHERE partner_code % 3 = 0) m
  ON m.partner_code = p.partner_code""", "portfolio"))
def q_redirect(spark, sf):
    T = DriverTables(spark, sf)
    m = T.portfolio.where(F.col("partner_code") % 3 == 0).select("partner_code", F.lit("OWNER 9").alias("new_owner"))
    return cdc.redirect_owner(T.portfolio, "salesperson_name", "OWNER 0", m, "partner_code", "OWNER 1")


@register("compare_portfolio_buyers", with_views("""
WITH a AS (SELECT DISTINCT partner_code FROM portfolio),
b AS (SELECT DISTINCT partner_code FROM sales_order WHERE invoice_date >= DATE '1999-08-01')
SELECT COUNT(CASE WHEN b.partner_code IS NULL THEN 1 END) AS only_a, COUNT(CASE WHEN a.partner_code IS NULL THEN 1 END) AS only_b,
       COUNT(CASE WHEN a.partner_code IS NOT NULL AND b.partner_code IS NOT NULL THEN 1 END) AS both
FROM a FULL OUTER JOIN b ON a.partner_code = b.partner_code""", "portfolio", "sales_order"))
def q_compare_keys(spark, sf):
    T = DriverTables(spark, sf)
    b = T.sales_order.where(F.col("invoice_date") >= F.lit("1999-08-01").cast("date"))
    return cdc.compare_keys(T.portfolio, b, "partner_code")
