"""DuckDB SQL for the logical views of ``lakeops.sources.driver`` (oracle side).

``with_views(sql, *names)`` prefixes a query with the CTEs it needs (and their
dependencies), so every oracle query is one self-contained statement over the
driver's base tables.
"""

from __future__ import annotations

from lakeops import params as P
from lakeops.sources.driver import FRESH_THRESHOLDS, PRICE_PARAM_CHANNELS, PRICE_PARAM_MONTHS, account_rows


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return _q(str(v))


def case(expr: str, pairs, default=None) -> str:
    whens = " ".join(f"WHEN {expr} = {_lit(k)} THEN {_lit(v)}" for k, v in pairs)
    return f"CASE {whens} ELSE {_lit(default)} END"


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, sql: str, deps=()):
    VIEWS[name] = (sql, tuple(deps))


view("sales_order", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_number,
       o.o_orderkey AS quote_number,
       o.o_custkey AS partner_code,
       (o.o_orderkey % 2) + 1 AS company_code,
       CAST(o.o_orderkey % 5 AS VARCHAR) AS nature_code,
       {case("substr(o.o_orderpriority, 1, 1)", [("1", "92"), ("2", "AM"), ("3", "SH"), ("4", "000054"), ("5", "000003")])} AS channel_code,
       CAST(c.c_nationkey % 7 AS BIGINT) AS salesperson_code,
       'SELLER ' || CAST(c.c_nationkey % 7 AS VARCHAR) AS salesperson_name,
       {case("c.c_mktsegment", [("BUILDING", "FA"), ("AUTOMOBILE", "FR"), ("MACHINERY", "PC"), ("HOUSEHOLD", "EC")])} AS salesperson_group_code,
       CAST(o.o_orderdate AS DATE) AS order_date,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 0 THEN NULL
            ELSE CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 4 AS INTEGER) END AS invoice_date,
       CAST({case("o.o_orderstatus", [("F", 3), ("O", 4), ("P", 2)])} AS INTEGER) AS order_status,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS product_amount,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.12 AS DECIMAL(18,2)) AS icms_amount,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,2)) AS ipi_amount,
       CAST(o.o_orderkey % 50 AS DECIMAL(18,2)) AS freight_amount,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) + CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,2))
            + CAST(o.o_orderkey % 50 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS total_amount,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 0 THEN NULL ELSE o.o_orderkey + 100000 END AS invoice_number,
       CAST((o.o_orderkey % 4) * 30 AS INTEGER) AS payment_term_days,
       CASE WHEN o.o_orderkey % 37 = 0 THEN o.o_orderdate + INTERVAL 30 DAY END AS excluded_at,
       o.o_orderdate AS updated_at
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")

view("nature", values([("0", "S", "N", "N"), ("1", "S", "P", "N"), ("2", "S", "E", "N"), ("3", "S", "F", "N"), ("4", "S", "F", "S")],
                      ["nature_code", "direction", "financial_flag", "is_return"]))

view("group_family", values(P.GROUP_FAMILY, ["salesperson_group_code", "rfv_familia"]))

view("portfolio", f"""
SELECT c_custkey AS partner_code,
       'CLIENT ' || CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS partner_name,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'FARMACIAS' ELSE 'HOSPITALAR' END AS rfv_familia,
       'OWNER ' || CAST(c_custkey % 5 AS VARCHAR) AS salesperson_name,
       {case("c_mktsegment", [("BUILDING", "FA"), ("AUTOMOBILE", "FR"), ("MACHINERY", "PC")])} AS salesperson_group_code,
       (c_custkey % 8 <> 5) AS is_active
FROM customer
WHERE c_custkey % 8 < 6 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
""")

view("partner", """
SELECT c.c_custkey AS partner_code, c.c_name AS partner_name,
       lpad(CAST(c.c_custkey AS VARCHAR), 14, '0') AS tax_id,
       n.n_name AS city, r.r_name AS state,
       CASE WHEN c.c_custkey % 8 < 6 THEN CAST(c.c_custkey % 8 AS VARCHAR) END AS carteira_code,
       (c.c_custkey % 13 <> 0) AS is_active
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")

view("item", """
SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_name AS item_name, p_brand AS group_code, p_type AS family_code,
       CASE WHEN p_partkey % 10 = 0 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.6 AS DECIMAL(18,2)) END AS linked_items_cost,
       (p_partkey % 13 <> 0) AS is_active
FROM part
""")

view("order_item", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_number, l_linenumber AS line_number, 'S' AS operation_type,
       CAST(l_partkey AS VARCHAR) AS item_code,
       CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
       CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,4)) AS unit_price,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS icms_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS ipi_amount,
       CASE WHEN l_orderkey % 37 = 0 THEN l_shipdate END AS excluded_at
FROM lineitem
""")

view("purchase_order", """
SELECT CAST(l.l_orderkey AS VARCHAR) AS order_number, l.l_suppkey AS partner_code, s.s_name AS supplier_name,
       CAST(l.l_orderkey % 5 AS VARCHAR) AS nature_code, CAST(l.l_shipdate AS DATE) AS invoice_date,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS product_amount,
       CASE WHEN l.l_orderkey % 41 = 0 THEN l.l_shipdate END AS excluded_at
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_returnflag = 'R'
""")

view("import_order", """
SELECT CAST(l.l_orderkey AS VARCHAR) AS import_number, s.s_name AS supplier_name,
       CAST(l.l_shipdate AS DATE) AS order_date,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_brl,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.2 AS DECIMAL(18,2)) AS total_usd,
       CASE WHEN l.l_orderkey % 41 = 0 THEN l.l_shipdate END AS excluded_at
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_returnflag = 'A'
""")

view("titles_all", """
SELECT l_orderkey * 10 + l_linenumber AS title_number, CAST(l_orderkey AS VARCHAR) AS order_number,
       l_suppkey AS partner_code, (l_orderkey % 2) + 1 AS company_code, l_suppkey % 3 AS bank_code,
       CASE WHEN l_returnflag = 'N' THEN 'D' ELSE 'E' END AS settlement_type,
       l_returnflag || CAST(l_linenumber % 5 AS VARCHAR) AS financial_item_code,
       CAST(l_shipdate AS DATE) AS issue_date,
       CAST(l_shipdate AS DATE) + 30 AS due_date,
       CAST(l_shipdate AS DATE) + CAST(l_linenumber * 7 AS INTEGER) AS payment_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS document_amount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS paid_amount,
       CASE WHEN l_linenumber % 4 = 0 THEN NULL
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) END AS net_amount,
       CASE WHEN l_orderkey % 43 = 0 THEN l_shipdate END AS excluded_at,
       l_linestatus, l_orderkey
FROM lineitem
""")

view("settled_title", "SELECT * EXCLUDE (l_linestatus, l_orderkey, net_amount) FROM titles_all WHERE l_linestatus = 'F'",
     ["titles_all"])
view("receivable", "SELECT * EXCLUDE (l_linestatus, l_orderkey, paid_amount, payment_date, settlement_type) FROM titles_all "
                   "WHERE l_linestatus = 'O' AND l_orderkey % 2 = 0", ["titles_all"])
view("payable", "SELECT * EXCLUDE (l_linestatus, l_orderkey, paid_amount, payment_date, settlement_type) FROM titles_all "
                "WHERE l_linestatus = 'O' AND l_orderkey % 2 = 1", ["titles_all"])
view("accounts", values(account_rows(), ["financial_item_code", "subgroup", "group_name", "account_sign"]))

view("bom", """
SELECT CAST((p_partkey - 1) // 3 AS VARCHAR) AS parent_item_code, CAST(p_partkey AS VARCHAR) AS child_item_code,
       CAST(p_size AS DECIMAL(18,4)) AS quantity, CASE WHEN p_partkey % 4 = 0 THEN 'A' ELSE 'M' END AS link_type,
       CASE WHEN p_partkey % 29 = 0 THEN DATE '2001-08-01' END AS excluded_at
FROM part WHERE p_partkey > 0
""")

view("deals", """
SELECT event_id AS deal_id, user_id AS org_id, 'ORG ' || CAST(user_id AS VARCHAR) AS org_name,
       user_id % 11 AS owner_id, (event_id % 3) + 1 AS pipeline_id,
       CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS BIGINT) AS stage_id,
       CASE WHEN event_type = 'purchase' THEN 'won' WHEN event_type = 'error' THEN 'lost' ELSE 'open' END AS status,
       CAST(value AS DECIMAL(18,2)) AS value,
       CASE WHEN event_type = 'error' AND event_id % 5 <> 0 THEN 'MOTIVO ' || CAST(event_id % 4 AS VARCHAR) END AS lost_reason,
       ts AS add_time,
       ts + to_hours(CAST(event_id % 72 AS INTEGER)) AS update_time,
       ts + to_days(CAST(event_id % 10 AS INTEGER)) AS stage_change_time,
       CASE WHEN event_type = 'purchase' THEN ts + to_days(CAST(event_id % 20 AS INTEGER)) END AS won_time,
       CASE WHEN event_type = 'error' THEN ts + to_days(CAST(event_id % 15 AS INTEGER)) END AS lost_time,
       CAST(ts AS DATE) + CAST(30 + event_id % 30 AS INTEGER) AS expected_close_date,
       CASE WHEN event_id % 50 = 0 THEN TRUE WHEN event_id % 50 = 1 THEN NULL ELSE FALSE END AS is_deleted
FROM events
""")

view("stages", "SELECT CAST(stage_id AS BIGINT) AS stage_id, stage_name, CAST(order_nr AS INTEGER) AS order_nr FROM ("
     + values([(1, "Prospecção", 1), (2, "Contato", 2), (3, "Proposta", 3), (4, "Negociação", 4), (5, "Fechamento", 5)],
              ["stage_id", "stage_name", "order_nr"]) + ") s")

view("activities", """
SELECT event_id AS activity_id, user_id % 11 AS user_id, event_type AS type, (event_id % 4 <> 0) AS done,
       CAST(ts AS DATE) AS due_date,
       CASE WHEN event_id % 4 <> 0 THEN ts + to_hours(CAST(event_id % 48 AS INTEGER)) END AS marked_as_done_time
FROM events
""")

view("calls", """
SELECT CAST(event_id - event_id % 3 AS VARCHAR) AS conversation_id, 'U' || CAST(user_id % 11 AS VARCHAR) AS user_key,
       CAST(floor(value * 10) AS BIGINT) AS duration_seconds,
       CASE WHEN event_id % 2 = 0 THEN 'inbound' ELSE 'outbound' END AS direction,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 30 THEN 'negative'
            WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 70 THEN 'neutral' ELSE 'positive' END AS ai_sentiment,
       ts AS call_created
FROM events
""")

view("quotes", """
SELECT o_orderkey AS quote_number, o_custkey AS partner_code,
       o_orderdate - to_days(CAST(o_orderkey % 60 AS INTEGER)) AS created_at,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS BIGINT) AS detailed_status,
       CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, CASE WHEN o_orderkey % 31 = 0 THEN o_orderdate END AS excluded_at
FROM orders
""")

_ch = ", ".join(_lit(c) for c in PRICE_PARAM_CHANNELS)
_ms = ", ".join(f"DATE '{m}'" for m in PRICE_PARAM_MONTHS)
view("price_params", f"""
SELECT CAST(p_partkey AS VARCHAR) AS item_code, c.canal, m.mes,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice * 0.5 END AS custo_peca,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(3.0 AS DOUBLE) END AS pct_ads,
       CAST(5.0 AS DOUBLE) AS pct_comissao, CAST(2.0 AS DOUBLE) AS pct_irpj_csll,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(1.2 AS DOUBLE) END AS pct_irpj,
       CAST(0.9 AS DOUBLE) AS pct_csll, CAST(0.65 AS DOUBLE) AS pct_pis, CAST(3.0 AS DOUBLE) AS pct_cofins,
       CAST(4.0 AS DOUBLE) AS pct_credito_icms_ipi,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(3.5 AS DOUBLE) END AS pct_credito_icms,
       CAST(1.0 AS DOUBLE) AS pct_credito_ipi,
       CAST((p_partkey % 10) * 1.5 AS DOUBLE) AS mao_obra_unit,
       CAST(2.5 AS DOUBLE) AS pct_custo_fixo,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(1.5 AS DOUBLE) END AS pct_outras
FROM part, (SELECT unnest([{_ch}]) AS canal) c, (SELECT unnest([{_ms}]) AS mes) m
WHERE p_partkey % 4 <> 3
""")

view("runs", """
SELECT CAST(event_id AS VARCHAR) AS run_id, 'src' || CAST(user_id % 4 AS VARCHAR) AS source, event_type AS entity,
       CASE WHEN event_id % 10 = 0 THEN 'error' WHEN event_id % 10 = 1 THEN 'skipped' ELSE 'ok' END AS status,
       event_id % 1000 AS rows_extracted,
       CASE WHEN event_id % 10 > 1 THEN event_id % 1000 ELSE 0 END AS rows_loaded,
       CASE WHEN event_id % 10 > 1 THEN ts - INTERVAL 1 HOUR END AS max_event_at,
       ts AS started_at, value AS seconds,
       CASE WHEN event_id % 3 = 0 THEN 'full' ELSE 'incremental' END AS mode,
       CASE WHEN event_id % 10 = 0 THEN 'timeout ' || CAST(event_id AS VARCHAR) END AS error
FROM events
""")
view("fresh_thresholds", values(FRESH_THRESHOLDS, ["source", "threshold_minutes"]))

view("orgs", """
SELECT user_id AS org_id,
       CASE WHEN user_id % 3 = 0 THEN 'Customer#' || lpad(CAST(user_id * 7 AS VARCHAR), 9, '0')
            WHEN user_id % 3 = 1 THEN 'Custmer#' || lpad(CAST(user_id * 7 AS VARCHAR), 9, '0')
            ELSE 'Org ' || CAST(user_id AS VARCHAR) END AS org_name,
       CASE WHEN user_id % 4 = 0 THEN lpad(CAST(user_id * 7 + 1 AS VARCHAR), 14, '0') END AS cnpj
FROM (SELECT DISTINCT user_id FROM events)
""")

view("production", """
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS prod_order_number, CAST(l_shipdate AS DATE) AS order_date,
       CAST(l_linenumber % 4 AS INTEGER) AS prod_status, CAST(l_quantity AS DECIMAL(18,4)) AS planned_qty,
       CAST(CAST(l_quantity AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS actual_qty,
       CAST(l_partkey AS VARCHAR) AS item_code, CASE WHEN l_orderkey % 29 = 0 THEN l_shipdate END AS excluded_at
FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'N'
""")
view("components", """
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS prod_order_number, CAST(l_partkey AS VARCHAR) AS item_code,
       CAST(l_quantity AS DECIMAL(18,4)) AS quantity, CASE WHEN l_orderkey % 29 = 0 THEN l_shipdate END AS excluded_at
FROM lineitem WHERE l_returnflag = 'R'
""")
view("stock", """
SELECT CAST(p_partkey AS VARCHAR) AS item_code, CAST(p_size - 25 AS DECIMAL(18,4)) AS general_balance,
       DATE '2001-08-01' AS snapshot_date, CASE WHEN p_partkey % 29 = 0 THEN DATE '2001-08-01' END AS excluded_at FROM part
""")
view("movements", """
SELECT CAST(l_partkey AS VARCHAR) AS item_code, CAST(l_shipdate AS DATE) AS movement_date,
       CASE WHEN l_returnflag = 'R' THEN 'E' ELSE 'S' END AS operation_type, CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
       CASE WHEN l_orderkey % 29 = 0 THEN l_shipdate END AS excluded_at
FROM lineitem
""")
view("serials", """
SELECT CAST(l_partkey AS VARCHAR) AS item_code, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS serial_number,
       l_orderkey % 100 AS batch_number, CASE WHEN l_linestatus = 'O' THEN 'X' END AS is_in_use,
       CASE WHEN l_orderkey % 29 = 0 THEN l_shipdate END AS excluded_at FROM lineitem
""")

view("crm_users", "SELECT CAST(user_id AS BIGINT) AS user_id, user_name, salesperson_name, is_active FROM ("
     + values([(i, f"USER {i}", f"SELLER {i % 7}", i % 5 != 4) for i in range(11)], ["user_id", "user_name", "salesperson_name", "is_active"]) + ") u")


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` (dependencies first)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0].strip()})" for n in order)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
