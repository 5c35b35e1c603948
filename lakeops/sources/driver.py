"""Logical business tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables.  ``DriverTables`` maps them onto the
logical inputs the operators expect (sales orders, items, partners, titles,
CRM deals, ...).  Every view is a lazy projection over a parquet scan, so
filters and column pruning still reach the files.  The same mapping is written
in SQL in ``lakeops.plans.oracle_views`` for the DuckDB oracle.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import params as P

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Reference dates of the driver data (max order date, end of the event month).
SALES_REF = "2001-08-01"
EVENTS_REF = "2024-01-31"
EVENTS_NOW = "2024-01-31 00:00:00"


def dec(x) -> Column:
    return F.lit(Decimal(str(x)))


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _mod_str(c: Column, m: int) -> Column:
    return (c % m).cast("string")


def hours(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), c.cast("int"), F.lit(0), F.lit(0))


def days(c: Column) -> Column:
    return F.make_dt_interval(c.cast("int"), F.lit(0), F.lit(0), F.lit(0))


class DriverTables:
    """Lazy logical views over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- commercial -------------------------------------------------------
    @cached_property
    def sales_order(self) -> DataFrame:
        o = self.raw("orders")
        c = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        k = F.col("o_orderkey")
        order_date = F.col("o_orderdate").cast("date")
        invoice_date = F.when((F.col("o_orderstatus") == "P") & (k % 3 == 0), F.lit(None).cast("date")).otherwise(
            F.date_add(order_date, (k % 4).cast("int")))
        product = money(F.col("o_totalprice"))
        icms = money(product * dec("0.12"))
        ipi = money(product * dec("0.05"))
        freight = money(k % 50)
        return (
            o.join(c, o.o_custkey == c.c_custkey, "left")
            .select(
                k.cast("string").alias("order_number"),
                k.alias("quote_number"),
                F.col("o_custkey").alias("partner_code"),
                ((k % 2) + 1).alias("company_code"),
                _mod_str(k, 5).alias("nature_code"),
                P.case_lookup(F.substring("o_orderpriority", 1, 1),
                              [("1", "92"), ("2", "AM"), ("3", "SH"), ("4", "000054"), ("5", "000003")]).alias("channel_code"),
                (F.col("c_nationkey") % 7).cast("bigint").alias("salesperson_code"),
                F.concat(F.lit("SELLER "), _mod_str(F.col("c_nationkey"), 7)).alias("salesperson_name"),
                P.case_lookup(F.col("c_mktsegment"),
                              [("BUILDING", "FA"), ("AUTOMOBILE", "FR"), ("MACHINERY", "PC"), ("HOUSEHOLD", "EC")]
                              ).alias("salesperson_group_code"),
                order_date.alias("order_date"),
                invoice_date.alias("invoice_date"),
                P.case_lookup(F.col("o_orderstatus"), [("F", 3), ("O", 4), ("P", 2)]).cast("int").alias("order_status"),
                product.alias("product_amount"),
                icms.alias("icms_amount"),
                ipi.alias("ipi_amount"),
                freight.alias("freight_amount"),
                money(product + ipi + freight).alias("total_amount"),
                F.when(invoice_date.isNotNull(), k + 100000).alias("invoice_number"),
                ((k % 4) * 30).cast("int").alias("payment_term_days"),
                F.when(k % 37 == 0, F.col("o_orderdate") + days(F.lit(30))).alias("excluded_at"),
                F.col("o_orderdate").alias("updated_at"),
            )
        )

    @cached_property
    def nature(self) -> DataFrame:
        rows = [("0", "S", "N", "N"), ("1", "S", "P", "N"), ("2", "S", "E", "N"), ("3", "S", "F", "N"), ("4", "S", "F", "S")]
        return P.table(self.spark, rows, "nature_code string, direction string, financial_flag string, is_return string")

    @cached_property
    def group_family(self) -> DataFrame:
        return P.table(self.spark, P.GROUP_FAMILY, "salesperson_group_code string, rfv_familia string")

    @cached_property
    def portfolio(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        seg = F.col("c_mktsegment")
        return (
            c.where((k % 8 < 6) & seg.isin("BUILDING", "MACHINERY", "AUTOMOBILE"))
            .select(
                k.alias("partner_code"),
                F.concat(F.lit("CLIENT "), (k - k % 2).cast("string")).alias("partner_name"),
                F.when(seg == "AUTOMOBILE", "FARMACIAS").otherwise("HOSPITALAR").alias("rfv_familia"),
                F.concat(F.lit("OWNER "), _mod_str(k, 5)).alias("salesperson_name"),
                P.case_lookup(seg, [("BUILDING", "FA"), ("AUTOMOBILE", "FR"), ("MACHINERY", "PC")]).alias("salesperson_group_code"),
                (k % 8 != 5).alias("is_active"),
            )
        )

    @cached_property
    def partner(self) -> DataFrame:
        c = self.raw("customer")
        n = self.raw("nation")
        r = self.raw("region")
        k = F.col("c_custkey")
        return (
            c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(
                k.alias("partner_code"),
                F.col("c_name").alias("partner_name"),
                F.lpad(k.cast("string"), 14, "0").alias("tax_id"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.when(k % 8 < 6, _mod_str(k, 8)).alias("carteira_code"),
                (k % 13 != 0).alias("is_active"),
            )
        )

    @cached_property
    def item(self) -> DataFrame:
        p = self.raw("part")
        k = F.col("p_partkey")
        return p.select(
            k.cast("string").alias("item_code"),
            F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("group_code"),
            F.col("p_type").alias("family_code"),
            F.when(k % 10 == 0, money(F.lit(0))).otherwise(money(money(F.col("p_retailprice")) * dec("0.6"))).alias("linked_items_cost"),
            (k % 13 != 0).alias("is_active"),
        )

    @cached_property
    def order_item(self) -> DataFrame:
        li = self.raw("lineitem")
        line_value = money(F.col("l_extendedprice"))
        return li.select(
            F.col("l_orderkey").cast("string").alias("order_number"),
            F.col("l_linenumber").alias("line_number"),
            F.lit("S").alias("operation_type"),
            F.col("l_partkey").cast("string").alias("item_code"),
            F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
            (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("decimal(18,0)") * dec("0.01"))
            .cast("decimal(18,4)").alias("unit_price"),
            money(line_value * F.col("l_tax").cast("decimal(4,2)")).alias("icms_amount"),
            money(line_value * F.col("l_discount").cast("decimal(4,2)")).alias("ipi_amount"),
            F.when(F.col("l_orderkey") % 37 == 0, F.col("l_shipdate")).alias("excluded_at"),
        )

    # -- purchases / finance -------------------------------------------------
    @cached_property
    def purchase_order(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        s = self.raw("supplier").select("s_suppkey", "s_name")
        return li.join(s, li.l_suppkey == s.s_suppkey, "left").select(
            F.col("l_orderkey").cast("string").alias("order_number"),
            F.col("l_suppkey").alias("partner_code"),
            F.col("s_name").alias("supplier_name"),
            _mod_str(F.col("l_orderkey"), 5).alias("nature_code"),
            F.col("l_shipdate").cast("date").alias("invoice_date"),
            money(F.col("l_extendedprice")).alias("product_amount"),
            F.when(F.col("l_orderkey") % 41 == 0, F.col("l_shipdate")).alias("excluded_at"),
        )

    @cached_property
    def import_order(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "A")
        s = self.raw("supplier").select("s_suppkey", "s_name")
        brl = money(F.col("l_extendedprice"))
        return li.join(s, li.l_suppkey == s.s_suppkey, "left").select(
            F.col("l_orderkey").cast("string").alias("import_number"),
            F.col("s_name").alias("supplier_name"),
            F.col("l_shipdate").cast("date").alias("order_date"),
            brl.alias("total_brl"),
            money(brl * dec("0.2")).alias("total_usd"),
            F.when(F.col("l_orderkey") % 41 == 0, F.col("l_shipdate")).alias("excluded_at"),
        )

    def _titles(self) -> DataFrame:
        li = self.raw("lineitem")
        issue = F.col("l_shipdate").cast("date")
        doc = money(F.col("l_extendedprice"))
        net = money(doc * (dec("1") - F.col("l_discount").cast("decimal(4,2)")))
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("title_number"),
            F.col("l_orderkey").cast("string").alias("order_number"),
            F.col("l_suppkey").alias("partner_code"),
            ((F.col("l_orderkey") % 2) + 1).alias("company_code"),
            (F.col("l_suppkey") % 3).alias("bank_code"),
            F.when(F.col("l_returnflag") == "N", "D").otherwise("E").alias("settlement_type"),
            F.concat(F.col("l_returnflag"), _mod_str(F.col("l_linenumber"), 5)).alias("financial_item_code"),
            issue.alias("issue_date"),
            F.date_add(issue, 30).alias("due_date"),
            F.date_add(issue, (F.col("l_linenumber") * 7).cast("int")).alias("payment_date"),
            doc.alias("document_amount"),
            net.alias("paid_amount"),
            F.when(F.col("l_linenumber") % 4 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(net).alias("net_amount"),
            F.when(F.col("l_orderkey") % 43 == 0, F.col("l_shipdate")).alias("excluded_at"),
            F.col("l_linestatus"),
            F.col("l_orderkey"),
        )

    @cached_property
    def settled_title(self) -> DataFrame:
        t = self._titles().where(F.col("l_linestatus") == "F")
        return t.drop("l_linestatus", "l_orderkey", "net_amount")

    @cached_property
    def receivable(self) -> DataFrame:
        t = self._titles().where((F.col("l_linestatus") == "O") & (F.col("l_orderkey") % 2 == 0))
        return t.drop("l_linestatus", "l_orderkey", "paid_amount", "payment_date", "settlement_type")

    @cached_property
    def payable(self) -> DataFrame:
        t = self._titles().where((F.col("l_linestatus") == "O") & (F.col("l_orderkey") % 2 == 1))
        return t.drop("l_linestatus", "l_orderkey", "paid_amount", "payment_date", "settlement_type")

    @cached_property
    def accounts(self) -> DataFrame:
        return P.table(self.spark, account_rows(),
                       "financial_item_code string, subgroup string, group_name string, account_sign string")

    # -- engineering / operations ---------------------------------------------
    @cached_property
    def bom(self) -> DataFrame:
        p = self.raw("part").where(F.col("p_partkey") > 0)
        k = F.col("p_partkey")
        return p.select(
            ((k - 1 - (k - 1) % 3) / 3).cast("bigint").cast("string").alias("parent_item_code"),
            k.cast("string").alias("child_item_code"),
            F.col("p_size").cast("decimal(18,4)").alias("quantity"),
            F.when(k % 4 == 0, "A").otherwise("M").alias("link_type"),
            F.when(k % 29 == 0, F.lit(SALES_REF).cast("date")).alias("excluded_at"),
        )

    # -- CRM ------------------------------------------------------------------
    @cached_property
    def deals(self) -> DataFrame:
        e = self.raw("events")
        i = F.col("event_id")
        t = F.col("event_type")
        status = F.when(t == "purchase", "won").when(t == "error", "lost").otherwise("open")
        ts = F.col("ts")
        return e.select(
            i.alias("deal_id"),
            F.col("user_id").alias("org_id"),
            F.concat(F.lit("ORG "), F.col("user_id").cast("string")).alias("org_name"),
            (F.col("user_id") % 11).alias("owner_id"),
            ((i % 3) + 1).alias("pipeline_id"),
            P.case_lookup(t, [("signup", 1), ("view", 2), ("click", 3)], 4).cast("bigint").alias("stage_id"),
            status.alias("status"),
            money(F.col("value")).alias("value"),
            F.when((t == "error") & (i % 5 != 0), F.concat(F.lit("MOTIVO "), _mod_str(i, 4))).alias("lost_reason"),
            ts.alias("add_time"),
            (ts + hours(i % 72)).alias("update_time"),
            (ts + days(i % 10)).alias("stage_change_time"),
            F.when(t == "purchase", ts + days(i % 20)).alias("won_time"),
            F.when(t == "error", ts + days(i % 15)).alias("lost_time"),
            F.date_add(ts.cast("date"), (30 + i % 30).cast("int")).alias("expected_close_date"),
            F.when(i % 50 == 0, F.lit(True)).when(i % 50 == 1, F.lit(None).cast("boolean")).otherwise(F.lit(False)).alias("is_deleted"),
        )

    @cached_property
    def stages(self) -> DataFrame:
        rows = [(1, "Prospecção", 1), (2, "Contato", 2), (3, "Proposta", 3), (4, "Negociação", 4), (5, "Fechamento", 5)]
        return P.table(self.spark, rows, "stage_id bigint, stage_name string, order_nr int")

    @cached_property
    def activities(self) -> DataFrame:
        e = self.raw("events")
        i = F.col("event_id")
        done = i % 4 != 0
        return e.select(
            i.alias("activity_id"),
            (F.col("user_id") % 11).alias("user_id"),
            F.col("event_type").alias("type"),
            done.alias("done"),
            F.col("ts").cast("date").alias("due_date"),
            F.when(done, F.col("ts") + hours(i % 48)).alias("marked_as_done_time"),
        )

    @cached_property
    def calls(self) -> DataFrame:
        e = self.raw("events")
        i = F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("int")
        return e.select(
            (i - i % 3).cast("string").alias("conversation_id"),
            F.concat(F.lit("U"), _mod_str(F.col("user_id"), 11)).alias("user_key"),
            F.floor(F.col("value") * 10).cast("bigint").alias("duration_seconds"),
            F.when(i % 2 == 0, "inbound").otherwise("outbound").alias("direction"),
            F.when(k < 30, "negative").when(k < 70, "neutral").otherwise("positive").alias("ai_sentiment"),
            F.col("ts").alias("call_created"),
        )

    @cached_property
    def quotes(self) -> DataFrame:
        o = self.raw("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("quote_number"),
            F.col("o_custkey").alias("partner_code"),
            (F.col("o_orderdate") - days(k % 60)).alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).cast("bigint").alias("detailed_status"),
            money(F.col("o_totalprice")).alias("total_amount"),
            F.when(k % 31 == 0, F.col("o_orderdate")).alias("excluded_at"),
        )

    @cached_property
    def price_params(self) -> DataFrame:
        """Cost/percentage parameters per item x channel x month (rule-built from ``part``)."""
        p = self.raw("part").where(F.col("p_partkey") % 4 != 3)
        k = F.col("p_partkey")
        nul = F.lit(None).cast("double")
        return p.select(
            k.cast("string").alias("item_code"),
            F.explode(F.array(*[F.lit(c) for c in PRICE_PARAM_CHANNELS])).alias("canal"),
            F.col("p_retailprice"), k,
        ).select(
            "item_code", "canal",
            F.explode(F.array(*[F.lit(m).cast("date") for m in PRICE_PARAM_MONTHS])).alias("mes"),
            F.when(k % 5 == 0, nul).otherwise(F.col("p_retailprice") * 0.5).alias("custo_peca"),
            F.when(k % 2 == 0, F.lit(3.0)).otherwise(nul).alias("pct_ads"),
            F.lit(5.0).alias("pct_comissao"),
            F.lit(2.0).alias("pct_irpj_csll"),
            F.when(k % 3 == 0, nul).otherwise(F.lit(1.2)).alias("pct_irpj"),
            F.lit(0.9).alias("pct_csll"),
            F.lit(0.65).alias("pct_pis"),
            F.lit(3.0).alias("pct_cofins"),
            F.lit(4.0).alias("pct_credito_icms_ipi"),
            F.when(k % 7 == 0, nul).otherwise(F.lit(3.5)).alias("pct_credito_icms"),
            F.lit(1.0).alias("pct_credito_ipi"),
            ((k % 10) * 1.5).alias("mao_obra_unit"),
            F.lit(2.5).alias("pct_custo_fixo"),
            F.when(k % 6 == 0, nul).otherwise(F.lit(1.5)).alias("pct_outras"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Ingestion run log (one run per event): status, rows, max event time, duration, mode."""
        e = self.raw("events")
        i = F.col("event_id")
        status = F.when(i % 10 == 0, "error").when(i % 10 == 1, "skipped").otherwise("ok")
        return e.select(
            i.cast("string").alias("run_id"),
            F.concat(F.lit("src"), _mod_str(F.col("user_id"), 4)).alias("source"),
            F.col("event_type").alias("entity"),
            status.alias("status"),
            (i % 1000).alias("rows_extracted"),
            F.when(status == "ok", i % 1000).otherwise(F.lit(0).cast("bigint")).alias("rows_loaded"),
            F.when(status == "ok", F.col("ts") - hours(F.lit(1))).alias("max_event_at"),
            F.col("ts").alias("started_at"),
            F.col("value").alias("seconds"),
            F.when(i % 3 == 0, "full").otherwise("incremental").alias("mode"),
            F.when(status == "error", F.concat(F.lit("timeout "), i.cast("string"))).alias("error"),
        )

    @cached_property
    def fresh_thresholds(self) -> DataFrame:
        return P.table(self.spark, FRESH_THRESHOLDS, "source string, threshold_minutes int")

    @cached_property
    def orgs(self) -> DataFrame:
        """CRM organisations (one per event user): exact, misspelt or unrelated names; some with a tax id."""
        u = F.col("user_id")
        code = F.lpad((u * 7).cast("string"), 9, "0")
        name = (F.when(u % 3 == 0, F.concat(F.lit("Customer#"), code)).when(u % 3 == 1, F.concat(F.lit("Custmer#"), code))
                .otherwise(F.concat(F.lit("Org "), u.cast("string"))))
        cnpj = F.when(u % 4 == 0, F.lpad((u * 7 + 1).cast("string"), 14, "0"))
        return self.raw("events").select("user_id").distinct().select(u.alias("org_id"), name.alias("org_name"),
                                                                      cnpj.alias("cnpj"))

    # -- operations ---------------------------------------------------------------
    @cached_property
    def production(self) -> DataFrame:
        li = self.raw("lineitem").where((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"))
        qty = F.col("l_quantity").cast("decimal(18,4)")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("prod_order_number"),
            F.col("l_shipdate").cast("date").alias("order_date"),
            (F.col("l_linenumber") % 4).cast("int").alias("prod_status"),
            qty.alias("planned_qty"),
            (qty * (dec("1") - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)").alias("actual_qty"),
            F.col("l_partkey").cast("string").alias("item_code"),
            F.when(F.col("l_orderkey") % 29 == 0, F.col("l_shipdate")).alias("excluded_at"),
        )

    @cached_property
    def components(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("prod_order_number"),
                         F.col("l_partkey").cast("string").alias("item_code"),
                         F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
                         F.when(F.col("l_orderkey") % 29 == 0, F.col("l_shipdate")).alias("excluded_at"))

    @cached_property
    def stock(self) -> DataFrame:
        p = self.raw("part")
        return p.select(F.col("p_partkey").cast("string").alias("item_code"),
                        (F.col("p_size") - 25).cast("decimal(18,4)").alias("general_balance"),
                        F.lit(SALES_REF).cast("date").alias("snapshot_date"),
                        F.when(F.col("p_partkey") % 29 == 0, F.lit(SALES_REF).cast("date")).alias("excluded_at"))

    @cached_property
    def movements(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(F.col("l_partkey").cast("string").alias("item_code"),
                         F.col("l_shipdate").cast("date").alias("movement_date"),
                         F.when(F.col("l_returnflag") == "R", "E").otherwise("S").alias("operation_type"),
                         F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
                         F.when(F.col("l_orderkey") % 29 == 0, F.col("l_shipdate")).alias("excluded_at"))

    @cached_property
    def serials(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(F.col("l_partkey").cast("string").alias("item_code"),
                         F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
                         .alias("serial_number"),
                         (F.col("l_orderkey") % 100).alias("batch_number"),
                         F.when(F.col("l_linestatus") == "O", F.lit("X")).alias("is_in_use"),
                         F.when(F.col("l_orderkey") % 29 == 0, F.col("l_shipdate")).alias("excluded_at"))

    @cached_property
    def chats(self) -> DataFrame:
        """Raw chat documents (JSON payload) built from events."""
        e = self.raw("events")
        i = F.col("event_id")
        reply = F.when(i % 7 != 0, F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), (i % 120 - 10).cast("int")))
        payload = F.to_json(F.struct(
            F.col("ts").alias("createdAtUTC"),
            F.struct(F.when(F.col("user_id") % 2 == 0, "SAC").otherwise("Comercial").alias("name")).alias("sector"),
            F.struct(F.when(i % 2 == 0, "WhatsApp").otherwise("Email").alias("name")).alias("channel"),
            (i % 5 == 0).alias("open"),
            F.struct(F.col("ts").alias("eventAtUTC")).alias("firstContactMessage"),
            F.struct(reply.alias("eventAtUTC")).alias("firstMemberReplyMessage"),
        ))
        return e.select(i.cast("string").alias("chat_id"), payload.alias("payload_json"))

    @cached_property
    def crm_users(self) -> DataFrame:
        rows = [(i, f"USER {i}", f"SELLER {i % 7}", i % 5 != 4) for i in range(11)]
        return P.table(self.spark, rows, "user_id bigint, user_name string, salesperson_name string, is_active boolean")


FRESH_THRESHOLDS = [("src0", 60), ("src1", 120), ("src2", 1440), ("src3", 30)]
PRICE_PARAM_CHANNELS = ["Distribuidor/Interno", "Mercado Livre", "Amazon"]
PRICE_PARAM_MONTHS = ["2001-06-01", "2001-07-01"]


def account_rows():
    """Chart of accounts for the driver's 15 financial item codes (rule-built)."""
    groups = [g for g, _ in P.PNL_ORDER]
    rows = []
    for fi, flag in enumerate("ANR"):
        for d in range(5):
            g = groups[(fi * 5 + d) % len(groups)]
            sign = "CREDIT" if g == "FATURAMENTO" else "DEBIT"
            rows.append((f"{flag}{d}", f"{g} {d}", g, sign))
    return rows
