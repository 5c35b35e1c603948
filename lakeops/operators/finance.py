"""Finance: billing allocation, titles, cash / accrual P&L, monthly summary, gold P&L and KPIs.

Scale notes: every "share of the order" (pro-rata allocation, installment
share) is computed as a grouped sum joined back on the key, not a window
partitioned by the key: the aggregation is partial (map-side) and the join
back is a sort-merge join whose skewed partitions AQE splits, so one huge
order never lands in a single task.  Chart of accounts and display order are
fixed-size parameter tables (broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C


def share_of(df: DataFrame, value: str, by: str, out: str = "share", total_name: str | None = None) -> DataFrame:
    """WIN-1 pro-rata share ``value / SUM(value) per by`` (DOUBLE, NULL when the total is 0).

    Rows without a key share the total of all such rows, as a window partitioned by the key would give.
    """
    tot = df.groupBy(F.col(by).alias("_share_by")).agg(F.sum(value).alias("_share_total"))
    j = df.join(tot, df[by].eqNullSafe(tot["_share_by"])).drop("_share_by")
    j = j.withColumn(out, C.safe_div(F.col(value), F.col("_share_total")))
    if total_name:
        return j.withColumnRenamed("_share_total", total_name)
    return j.drop("_share_total")


def billing_natures(natures: DataFrame) -> DataFrame:
    ir = F.col("is_return")
    return natures.where((F.col("direction") == "S") & (F.col("financial_flag") == "F")
                         & (ir.isNull() | ir.isin("N", ""))).select("nature_code").distinct()


def allocate_billing(orders: DataFrame, items: DataFrame, natures: DataFrame, products: DataFrame,
                     partners: DataFrame, line_value: Column | None = None) -> DataFrame:
    """A-FIN-1: freight / IPI / ICMS of each billed order split pro rata to its item lines."""
    lv = line_value if line_value is not None else F.col("unit_price") * F.col("quantity")
    o = (orders.join(F.broadcast(billing_natures(natures)), "nature_code")
         .where(F.col("invoice_number").isNotNull() & F.col("excluded_at").isNull())
         .select("order_number", "invoice_number", "partner_code", "company_code", "nature_code", "salesperson_code",
                 "order_date", "invoice_date", "freight_amount", "ipi_amount", "icms_amount"))
    it = (items.where((F.col("operation_type") == "S") & F.col("excluded_at").isNull())
          .select("order_number", "item_code", "quantity", C.money(lv).alias("line_value")))
    it = share_of(it, "line_value", "order_number", "item_pct", "order_items_total")
    j = o.join(it, "order_number")
    share = F.col("item_pct")
    fr = F.col("freight_amount").cast("double") * share
    ipi = F.col("ipi_amount").cast("double") * share
    icms = F.col("icms_amount").cast("double") * share
    out = j.select(
        "order_number", "invoice_number", "partner_code", "company_code", "nature_code", "salesperson_code",
        "order_date", "invoice_date", "item_code", "quantity", "line_value",
        C.money(F.col("order_items_total")).alias("order_items_total"), "item_pct",
        *(F.round(x, 4).alias(n) for x, n in ((fr, "freight_allocated"), (ipi, "ipi_allocated"), (icms, "icms_allocated"))),
        F.round(F.col("line_value").cast("double") + fr + ipi, 4).alias("total_item_allocated"),
    )
    out = out.join(products.select("item_code", "item_name", "group_code", "family_code"), "item_code", "left")
    return out.join(partners.select("partner_code", "partner_name"), "partner_code", "left")


def _live(df: DataFrame) -> DataFrame:
    """FLT-4: rows that are not cancelled."""
    return df.where(F.col("excluded_at").isNull())


def _enrich_titles(df: DataFrame, accounts: DataFrame, partners: DataFrame) -> DataFrame:
    acc = F.broadcast(accounts.select("financial_item_code", "subgroup", "group_name", "account_sign"))
    return (df.join(acc, "financial_item_code", "left")
            .join(partners.select("partner_code", "partner_name"), "partner_code", "left"))


TITLE_COLS = ["title_number", "order_number", "settlement_type", "partner_code", "company_code", "bank_code",
              "issue_date", "due_date", "payment_date", "document_amount", "paid_amount", "net_amount",
              "financial_item_code", "installment_pct"]


def _with_share(t: DataFrame, with_share: bool) -> DataFrame:
    if with_share:
        return share_of(t, "document_amount", "order_number", "installment_pct")
    return t.withColumn("installment_pct", F.lit(None).cast("double"))


def titles_settled(settled: DataFrame, accounts: DataFrame, partners: DataFrame, with_share: bool = True) -> DataFrame:
    """A-FIN-2: settled titles with installment share and account mapping.

    ``with_share=False`` skips the per-order share (an aggregate joined back) for consumers that
    only sum amounts, such as the monthly P&L.
    """
    t = _live(settled).where(F.col("payment_date").isNotNull())
    t = _with_share(t, with_share)
    t = t.withColumn("net_amount", F.lit(None).cast("decimal(18,2)"))
    return _enrich_titles(t.select(*TITLE_COLS), accounts, partners)


def titles_open(payable: DataFrame, receivable: DataFrame, accounts: DataFrame, partners: DataFrame,
                with_share: bool = True) -> DataFrame:
    """A-FIN-3: open titles, payables (type E) UNION ALL receivables (type D, no bank)."""
    def prep(df, kind, keep_bank):
        t = _with_share(_live(df), with_share)
        return t.select(
            "title_number", "order_number", F.lit(kind).alias("settlement_type"), "partner_code", "company_code",
            (F.col("bank_code") if keep_bank else F.lit(None).cast("bigint")).alias("bank_code"),
            "issue_date", "due_date", F.lit(None).cast("date").alias("payment_date"), "document_amount",
            F.lit(None).cast("decimal(18,2)").alias("paid_amount"), "net_amount", "financial_item_code", "installment_pct")

    u = prep(payable, "E", True).unionByName(prep(receivable, "D", False))
    return _enrich_titles(u, accounts, partners)


PNL_COLS = ["status", "regime", "dre_date", "title_number", "order_number", "settlement_type", "partner_code",
            "partner_name", "company_code", "financial_item_code", "subgroup", "group_name", "account_sign",
            "installment_pct", "document_amount", "effective_amount", "net_amount"]


def _pnl(settled: DataFrame, open_: DataFrame, regime: str, realised_date: str, realised_amount: str,
         open_date: str) -> DataFrame:
    r = settled.select(F.lit("REALIZADO").alias("status"), F.lit(regime).alias("regime"),
                       F.col(realised_date).alias("dre_date"), "*",
                       F.col(realised_amount).alias("effective_amount")).drop("net_amount").withColumn(
        "net_amount", F.lit(None).cast("decimal(18,2)"))
    o = open_.select(F.lit("REALIZAR").alias("status"), F.lit(regime).alias("regime"),
                     F.col(open_date).alias("dre_date"), "*",
                     F.lit(None).cast("decimal(18,2)").alias("effective_amount"))
    return r.select(*PNL_COLS).unionByName(o.select(*PNL_COLS))


def pnl_cash(settled_silver: DataFrame, open_silver: DataFrame) -> DataFrame:
    """A-FIN-4: cash regime lines (realised at payment date, open at due date)."""
    return _pnl(settled_silver, open_silver, "CAIXA", "payment_date", "paid_amount", "due_date")


def pnl_accrual(settled_silver: DataFrame, open_silver: DataFrame) -> DataFrame:
    """A-FIN-5: accrual regime lines (issue date, document amount)."""
    return _pnl(settled_silver, open_silver, "COMPETENCIA", "issue_date", "document_amount", "issue_date")


def pnl_monthly(lines: DataFrame) -> DataFrame:
    """A-FIN-6: regime x month x status x company x type x group x subgroup x sign."""
    return lines.where(F.col("dre_date").isNotNull()).groupBy(
        "regime", F.date_format("dre_date", "yyyy-MM").alias("year_month"), "status", "company_code",
        "settlement_type", "group_name", "subgroup", "account_sign").agg(
        C.money_sum(F.coalesce("effective_amount", "document_amount")).alias("amount"),
        F.count("*").alias("title_count"))


def product_margin(alloc: DataFrame) -> DataFrame:
    """A-FIN-7: item x company x month revenue from the allocation (cost/margin NULL until costs exist)."""
    return alloc.groupBy("item_code", "item_name", "group_code", "family_code", "company_code",
                         F.date_format("order_date", "yyyy-MM").alias("year_month")).agg(
        F.sum("quantity").cast("decimal(18,4)").alias("quantity"),
        C.money_sum("line_value").alias("revenue"),
        F.round(F.sum("total_item_allocated"), 4).alias("revenue_with_charges"),
        F.countDistinct("order_number").alias("n_orders"),
    ).withColumn("cost", F.lit(None).cast("decimal(18,2)")).withColumn("margin", F.lit(None).cast("decimal(18,2)"))


def gold_pnl(monthly: DataFrame, ref: str, order=P.PNL_ORDER, default_order=P.PNL_ORDER_DEFAULT) -> DataFrame:
    """A-FIN-8: realised lines, signed by account, display order, months up to the reference month."""
    mes = F.try_to_date(F.concat(F.col("year_month"), F.lit("-01")), "yyyy-MM-dd")
    sign = F.col("account_sign")
    amt = F.col("amount")
    valor = F.when(sign == "DEBIT", -amt).otherwise(amt)
    df = monthly.where((F.col("status") == "REALIZADO") & mes.isNotNull()
                       & (mes <= F.trunc(F.lit(ref).cast("date"), "month")))
    return df.select(
        mes.alias("month"), "regime", F.col("group_name").alias("pnl_group"),
        F.coalesce("subgroup", "group_name").alias("description"), "company_code",
        C.money(valor).alias("value"),
        P.case_lookup(F.col("group_name"), order, default_order).cast("int").alias("display_order"),
        "title_count")


KPI_GROUPS = [("faturamento", "FATURAMENTO"), ("impostos_vendas", "IMPOSTOS S/ VENDAS"),
              ("custos_variaveis", "CUSTOS VARIÁVEIS DIRETOS"), ("despesas_fixas", "DESPESAS FIXAS"),
              ("despesas_comerciais", "DESPESAS COMERCIAIS"), ("marketing", "MARKETING"),
              ("investimentos", "INVESTIMENTOS"), ("atividades_financeiras", "ATIVIDADES FINANCEIRAS")]


def gold_kpis(pnl: DataFrame) -> DataFrame:
    """A-FIN-9: group pivot per month x regime, gross margin, EBITDA, net profit (costs already negative)."""
    g = F.col("pnl_group")
    aggs = [C.money(F.coalesce(F.sum(F.when(g == grp, F.col("value"))), F.lit(0))).alias(name) for name, grp in KPI_GROUPS]
    k = pnl.groupBy("month", "regime").agg(*aggs)
    gross = F.col("faturamento") + F.col("impostos_vendas") + F.col("custos_variaveis")
    ebitda = gross + F.col("despesas_fixas") + F.col("despesas_comerciais") + F.col("marketing")
    net = ebitda + F.col("investimentos") + F.col("atividades_financeiras")
    return k.select("*", C.money(gross).alias("margem_bruta"), C.money(ebitda).alias("ebitda"),
                    C.money(net).alias("lucro_liquido"))


KPI_CARDS = ["faturamento", "margem_bruta", "ebitda", "lucro_liquido"]


def kpi_cards(kpis: DataFrame, regime: str, start: str, end: str) -> DataFrame:
    """A-FIN-10: per month in range, each KPI with change vs the previous month on |previous| and direction."""
    df = kpis.where((F.col("regime") == regime) & F.col("month").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    long = df.select("month", F.explode(F.array(*[F.struct(F.lit(k).alias("kpi"), F.col(k).alias("value"))
                                                   for k in KPI_CARDS])).alias("c")).select("month", "c.kpi", "c.value")
    w = Window.partitionBy("kpi").orderBy("month")  # months x 4 KPIs after aggregation
    prev = F.lag("value").over(w)
    chg = F.try_divide(F.col("value").cast("double") - prev.cast("double"), F.abs(prev.cast("double"))) * F.lit(100.0)
    out = long.withColumn("previous", prev).withColumn("change_pct", chg)
    return out.withColumn("direction", F.when(F.col("change_pct") > 0, "up").when(F.col("change_pct") < 0, "down")
                          .otherwise("flat"))


def pnl_by_group(pnl: DataFrame, regime: str, start: str, end: str) -> DataFrame:
    """A-FIN-10: P&L by group over a month range, with display order and the share of total magnitude."""
    df = pnl.where((F.col("regime") == regime) & F.col("month").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    g = df.groupBy("pnl_group", "display_order").agg(C.money_sum("value").alias("value"))
    tot = g.agg(F.sum(F.abs("value")).alias("_abs"))
    return g.crossJoin(F.broadcast(tot)).select("pnl_group", "display_order", "value",
                                                C.pct(F.abs("value"), "_abs").alias("share_pct"))


def open_ledger(titles_open_df: DataFrame, kind: str, ref: str, warning=P.OVERDUE_WARNING_PCT,
                danger=P.OVERDUE_DANGER_PCT) -> DataFrame:
    """A-FIN-11: receivable (D) / payable (E) ledger totals: value, count, overdue value, overdue %, band."""
    t = titles_open_df.where(F.col("settlement_type") == kind)
    od = F.col("due_date") < F.lit(ref).cast("date")
    amt = F.coalesce("net_amount", "document_amount")
    agg = t.agg(C.money_sum0(amt).alias("total"), F.count("*").alias("n_titles"),
                C.money(F.coalesce(F.sum(F.when(od, amt)), F.lit(0))).alias("overdue"), C.count_if(od).alias("n_overdue"))
    pct = C.pct("overdue", "total")
    return agg.withColumn("overdue_pct", pct).withColumn(
        "band", F.when(pct > danger, "danger").when(pct > warning, "warning").otherwise("ok"))


def open_title_list(titles_open_df: DataFrame, kind: str, n: int = 200, missing: str = "—") -> DataFrame:
    """A-FIN-11: the ``n`` titles of a ledger that fall due first, with partner, group and subgroup (``missing`` where there is none).

    Titles without a due date come last; titles of one date by number, partner and value.  A top-n report: each task keeps its first ``n`` rows.
    """
    t = titles_open_df.where(F.col("settlement_type") == kind)
    named = {c: F.coalesce(c, F.lit(missing)).alias(c) for c in ("partner_name", "group_name", "subgroup")}
    out = t.select("title_number", named["partner_name"], "due_date", C.money(F.coalesce("net_amount", "document_amount")).alias("value"), named["group_name"], named["subgroup"])
    return out.orderBy(F.col("due_date").asc_nulls_last(), "title_number", "partner_name", "value", "group_name", "subgroup").limit(n)


def open_by_due_month(titles_open_df: DataFrame, kind: str) -> DataFrame:
    t = titles_open_df.where(F.col("settlement_type") == kind)
    return t.groupBy(F.trunc("due_date", "month").alias("due_month")).agg(
        C.money_sum(F.coalesce("net_amount", "document_amount")).alias("value"), F.count("*").alias("n_titles"))


def settlements_monthly(settled_silver: DataFrame) -> DataFrame:
    """A-FIN-12: paid value by month x settlement type."""
    return settled_silver.groupBy(F.trunc("payment_date", "month").alias("month"), "settlement_type").agg(
        C.money_sum("paid_amount").alias("paid"), F.count("*").alias("n_titles"))


def cash_flow(settled_silver: DataFrame) -> DataFrame:
    """A-FIN-12: inflow (D) / outflow (E) / balance per month and the cumulative balance."""
    st = F.col("settlement_type")
    m = settled_silver.groupBy(F.trunc("payment_date", "month").alias("month")).agg(
        C.money(F.coalesce(F.sum(F.when(st == "D", F.col("paid_amount"))), F.lit(0))).alias("inflow"),
        C.money(F.coalesce(F.sum(F.when(st == "E", F.col("paid_amount"))), F.lit(0))).alias("outflow"))
    m = m.withColumn("balance", C.money(F.col("inflow") - F.col("outflow")))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    return m.withColumn("cumulative", C.money(F.sum("balance").over(w)))


def pnl_lines(settled_silver: DataFrame, open_silver: DataFrame) -> DataFrame:
    """A-FIN-4 + A-FIN-5 in one pass: every title yields its cash and its accrual line (``explode``),
    so each title source is scanned and enriched once for both regimes."""
    null_dec = F.lit(None).cast("decimal(18,2)")
    base = ["title_number", "order_number", "settlement_type", "partner_code", "partner_name", "company_code",
            "financial_item_code", "subgroup", "group_name", "account_sign", "installment_pct", "document_amount"]

    def lines(df, status, cash_date, cash_amount, acc_amount, net):
        reg = F.explode(F.array(
            F.struct(F.lit("CAIXA").alias("regime"), F.col(cash_date).alias("dre_date"), cash_amount.alias("effective_amount")),
            F.struct(F.lit("COMPETENCIA").alias("regime"), F.col("issue_date").alias("dre_date"), acc_amount.alias("effective_amount"))))
        return df.select(F.lit(status).alias("status"), *base, net.alias("net_amount"), reg.alias("r")).select(
            "status", "r.regime", "r.dre_date", *base, "r.effective_amount", "net_amount")

    r = lines(settled_silver, "REALIZADO", "payment_date", F.col("paid_amount"), F.col("document_amount"), null_dec)
    o = lines(open_silver, "REALIZAR", "due_date", null_dec, null_dec, F.col("net_amount"))
    return r.unionByName(o).select(*PNL_COLS)
