"""Sales, purchases and quote analytics (A-COM-17..24).

Each dashboard panel that the source system computed with several queries and
pandas post-processing is one declarative plan here: one scan with pushed-down
date predicates, conditional aggregates for the different periods in the same
pass, and tiny windows (``lag`` / cumulative sums) only after aggregation has
reduced the data to a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.operators.commercial import billed_orders, classify_channel, date_range, in_months, price_channel
from lakeops.operators.projection import running_totals


def _d(x):
    return F.lit(x).cast("date")


def dashboard_sales(orders: DataFrame, natures: DataFrame) -> DataFrame:
    """Billed-sales base of the dashboards: financial nature and invoice date only."""
    df = billed_orders(orders, natures, exclude_channels=(), statuses=None)
    return df.withColumn("channel", classify_channel()).withColumn("month", F.trunc("invoice_date", "month"))


def _pct_change(cur, prev):
    return F.try_divide(cur.cast("double") - prev.cast("double"), prev.cast("double")) * F.lit(100.0)


def _months(ref_month: str):
    m0 = _d(ref_month)
    return m0, F.add_months(m0, -1), F.add_months(m0, -12)


def _period_sums(df: DataFrame, ref_month: str):
    m0, m1, m12 = _months(ref_month)
    m = F.col("month")
    amt = F.col("product_amount")
    return in_months(df, "invoice_date", m0, m1, m12), [
        C.money(F.coalesce(F.sum(F.when(m == m0, amt)), F.lit(0))).alias("revenue"),
        C.money(F.coalesce(F.sum(F.when(m == m1, amt)), F.lit(0))).alias("revenue_prev"),
        C.money(F.coalesce(F.sum(F.when(m == m12, amt)), F.lit(0))).alias("revenue_ly"),
        C.count_if(m == m0).alias("transactions"),
    ]


def _derive(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.coalesce(C.safe_div("revenue", "transactions"), F.lit(0.0)).alias("ticket"),
        _pct_change(F.col("revenue"), F.col("revenue_prev")).alias("mom_pct"),
        _pct_change(F.col("revenue"), F.col("revenue_ly")).alias("yoy_pct"),
    )


def sales_month_kpis(sales: DataFrame, ref_month: str, include_marketplace: bool = True) -> DataFrame:
    """A-COM-17: month revenue, MoM, YoY, transactions and ticket in one pass."""
    if not include_marketplace:
        sales = sales.where(F.col("channel") != P.CHANNEL_NULL_GROUP)
    df, aggs = _period_sums(sales, ref_month)
    return _derive(df.agg(*aggs))


def sales_by_channel(sales: DataFrame, ref_month: str, include_marketplace: bool = True) -> DataFrame:
    """A-COM-17: the same KPIs per channel (channels present in the month), with display order."""
    if not include_marketplace:
        sales = sales.where(F.col("channel") != P.CHANNEL_NULL_GROUP)
    df, aggs = _period_sums(sales, ref_month)
    out = _derive(df.groupBy("channel").agg(*aggs).where(F.col("transactions") > 0))
    order = [(c, i) for i, c in enumerate(P.CHANNEL_ORDER)]
    return out.withColumn("channel_order", P.case_lookup(F.col("channel"), order, 99).cast("int"))


def _slug(label: str) -> str:
    """Column name for a channel label: 'Farmácias' -> 'rev_farmacias'."""
    import unicodedata

    s = unicodedata.normalize("NFKD", label).encode("ascii", "ignore").decode().lower()
    return "rev_" + "".join(ch if ch.isalnum() else "_" for ch in s).strip("_")


def sales_evolution(sales: DataFrame, ref_month: str, months: int = 12) -> DataFrame:
    """A-COM-19: revenue per month (last ``months`` months) pivoted over the fixed channel list, total and MoM."""
    m0 = _d(ref_month)
    start = F.add_months(m0, -(months - 1))
    df = date_range(sales, "invoice_date", (start, F.add_months(m0, 1)))
    piv = df.groupBy("month").pivot("channel", P.CHANNEL_ORDER).agg(F.sum("product_amount"))
    cols = [C.money(F.coalesce(F.col(c), F.lit(0))).alias(_slug(c)) for c in P.CHANNEL_ORDER]
    piv = piv.select("month", *cols)
    total = sum((F.col(_slug(c)) for c in P.CHANNEL_ORDER), F.lit(0))
    piv = piv.withColumn("total", C.money(total))
    w = Window.orderBy("month")  # at most `months` rows after aggregation
    return piv.withColumn("mom_pct", _pct_change(F.col("total"), F.lag("total").over(w)))


def sales_weeks(sales: DataFrame, ref_month: str, include_marketplace: bool = True) -> DataFrame:
    """A-COM-19: revenue by week of month x channel for the month."""
    df = in_months(sales, "invoice_date", _d(ref_month))
    if not include_marketplace:
        df = df.where(F.col("channel") != P.CHANNEL_NULL_GROUP)
    return df.groupBy(C.week_of_month("invoice_date").alias("week"), C.week_label("invoice_date").alias("week_label"),
                      "channel").agg(C.money_sum("product_amount").alias("revenue"), F.count("*").alias("transactions"))


def marketplace_detail(sales: DataFrame, ref_month: str, default_label: str = "Outros Marketplaces") -> DataFrame:
    """A-COM-18: marketplace sub-channels in the month with their share of marketplace revenue."""
    df = in_months(sales, "invoice_date", _d(ref_month)).where(F.col("channel") == P.CHANNEL_NULL_GROUP)
    sub = P.case_lookup(F.upper(F.trim("channel_code")), P.PRICE_CHANNEL, default_label)
    agg = df.groupBy(sub.alias("sub_channel")).agg(C.money_sum("product_amount").alias("revenue"),
                                                   F.count("*").alias("transactions"))
    tot = agg.agg(F.sum("revenue").alias("_tot"))
    return agg.crossJoin(F.broadcast(tot)).select(
        "sub_channel", "revenue", "transactions", C.pct("revenue", "_tot").alias("share_pct"))


def sales_period(orders: DataFrame, natures: DataFrame, start: str, end: str) -> DataFrame:
    """A-COM-20: per channel, orders placed (by order date) vs invoiced (by invoice date) in [start, end]."""
    fin = F.broadcast(natures.where(F.col("financial_flag") != "N").select("nature_code"))
    od, inv = F.col("order_date"), F.col("invoice_date")
    in_o = od.between(_d(start), _d(end))
    in_i = inv.between(_d(start), _d(end))
    df = orders.join(fin, "nature_code").where(in_o | in_i).withColumn("channel", classify_channel())
    return df.groupBy("channel").agg(
        C.count_if(in_o).alias("orders_placed"),
        C.money(F.coalesce(F.sum(F.when(in_o, F.col("product_amount"))), F.lit(0))).alias("value_placed"),
        C.count_if(in_i).alias("orders_invoiced"),
        C.money(F.coalesce(F.sum(F.when(in_i, F.col("product_amount"))), F.lit(0))).alias("value_invoiced"),
    )


def available_months(orders: DataFrame) -> DataFrame:
    """A-COM-20: distinct invoice months."""
    return orders.where(F.col("invoice_date").isNotNull()).select(F.trunc("invoice_date", "month").alias("month")).distinct()


# -- ABC ranking (A-COM-21) ------------------------------------------------------

def _abc_clients(orders: DataFrame, natures: DataFrame, partners: DataFrame, ref: str) -> DataFrame:
    """Revenue, orders and place of each client (by normalised name) over the rolling year."""
    from lakeops.operators.commercial import rolling_window

    b = rolling_window(billed_orders(orders, natures), "invoice_date", ref, 12)
    p = partners.select("partner_code", "partner_name", "city", "state")
    df = b.join(p, "partner_code").withColumn("name_norm", C.norm_name("partner_name"))
    return df.groupBy("name_norm").agg(
        F.min("partner_name").alias("client"),
        C.value_at_max("city", "product_amount").alias("city"),
        C.value_at_max("state", "product_amount").alias("state"),
        F.countDistinct("order_number").alias("n_orders"),
        C.money_sum("product_amount").alias("revenue"),
    )


def abc_ranking(orders: DataFrame, natures: DataFrame, partners: DataFrame, ref: str, top: int = 100,
                bounds=P.ABC_BOUNDS, fallback=P.ABC_FALLBACK) -> DataFrame:
    """Top clients by revenue (by normalised name), with cumulative % and A/B/C class.

    The window for the cumulative share runs on the ``top`` rows only.
    """
    topn = _abc_clients(orders, natures, partners, ref).orderBy(F.col("revenue").desc(), F.col("name_norm")).limit(top)
    w = Window.orderBy(F.col("revenue").desc(), F.col("name_norm"))
    wall = Window.partitionBy(F.lit(1))
    out = (topn.withColumn("position", F.row_number().over(w))
           .withColumn("cum_pct", C.pct(F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                                        F.sum("revenue").over(wall))))
    return out.withColumn("abc_class", P.bands(F.col("cum_pct"), bounds, fallback, "<=")).drop("name_norm")


def abc_curve(orders: DataFrame, natures: DataFrame, partners: DataFrame, ref: str, bounds=P.ABC_BOUNDS, fallback=P.ABC_FALLBACK) -> DataFrame:
    """A-COM-21 / WIN-6 over all clients: place, running revenue, its share of the whole and the A/B/C class, by distributed prefix sums."""
    c = _abc_clients(orders, natures, partners, ref).select("name_norm", "client", "n_orders", "revenue")
    out = running_totals(c, "revenue", [F.col("revenue").desc(), F.col("name_norm")], total="cum_revenue", overall="_all")
    return (out.withColumns({"cum_pct": C.pct("cum_revenue", "_all"), "cum_revenue": C.money("cum_revenue")})
            .withColumn("abc_class", P.bands(F.col("cum_pct"), bounds, fallback, "<=")).drop("name_norm", "_all"))


def abc_kpis(ranking: DataFrame, top_share: float = P.ABC_TOP_SHARE) -> DataFrame:
    """Total of the ranking, count of class A, revenue share of the top 20 % rows (at least one).

    ``ranking`` is the bounded top-N output of ``abc_ranking``.
    """
    n = F.count("*").over(Window.partitionBy(F.lit(1)))
    r = ranking.withColumn("_k", F.greatest(F.lit(1), F.floor(n * F.lit(top_share))))
    return r.agg(
        C.money_sum("revenue").alias("top_revenue"),
        C.count_if(F.col("abc_class") == "A").alias("class_a"),
        C.pct(F.sum(F.when(F.col("position") <= F.col("_k"), F.col("revenue"))), F.sum("revenue")).alias("top_share_pct"),
    )


# -- purchases (A-COM-22) --------------------------------------------------------

def _since_months(col, ref, months):
    return F.col(col) >= F.add_months(_d(ref), -months)


def purchases_kpis(purchases: DataFrame, imports: DataFrame, sales: DataFrame, natures: DataFrame, ref: str) -> DataFrame:
    """Domestic purchases (12 m), imports BRL/USD, top import supplier and concentration, purchase/sales ratio."""
    fin = F.broadcast(natures.where(F.col("financial_flag") != "N").select("nature_code"))
    dom = (purchases.join(fin, "nature_code")
           .where(_since_months("invoice_date", ref, 12) & F.col("excluded_at").isNull())
           .agg(F.count("*").alias("dom_orders"), C.money_sum0("product_amount").alias("dom_value")))
    imp = imports.where(F.col("excluded_at").isNull())
    # one pass over imports: per-supplier sums, then the total and the top supplier from that small result
    by_sup = imp.groupBy("supplier_name").agg(F.sum("total_brl").alias("v"), F.sum("total_usd").alias("u"))
    top = by_sup.agg(F.max_by(F.struct("v", "supplier_name"), F.struct("v", "supplier_name")).alias("t"))
    imp_tot = by_sup.agg(C.money_sum0("v").alias("import_brl"), C.money_sum0("u").alias("import_usd"))
    ven = (sales.join(fin, "nature_code").where(_since_months("invoice_date", ref, 12))
           .agg(C.money_sum0("product_amount").alias("sales_value")))
    one = dom.crossJoin(imp_tot).crossJoin(top).crossJoin(ven)  # four 1-row aggregates
    return one.select(
        "dom_orders", "dom_value", "import_brl", "import_usd", "sales_value",
        F.col("t.supplier_name").alias("top_import_supplier"),
        C.money(F.col("t.v")).alias("top_import_value"),
        F.coalesce(C.pct("dom_value", "sales_value"), F.lit(0.0)).alias("purchase_sales_pct"),
        F.coalesce(C.pct(F.col("t.v"), F.col("import_brl")), F.lit(0.0)).alias("import_concentration_pct"),
    )


def purchases_series(sales: DataFrame, purchases: DataFrame, natures: DataFrame, ref: str, months: int = 12) -> DataFrame:
    """Monthly sales vs purchases over the last complete months (month-aligned left join, JON-12)."""
    fin = F.broadcast(natures.where(F.col("financial_flag") != "N").select("nature_code"))
    m0 = F.trunc(_d(ref), "month")
    win = (F.col("invoice_date") >= F.add_months(m0, -months)) & (F.col("invoice_date") < m0)
    v = (sales.join(fin, "nature_code").where(win).groupBy(F.trunc("invoice_date", "month").alias("month"))
         .agg(C.money_sum("product_amount").alias("sales")))
    c = (purchases.join(fin, "nature_code").where(win & F.col("excluded_at").isNull())
         .groupBy(F.trunc("invoice_date", "month").alias("month")).agg(F.sum("product_amount").alias("_p")))
    return v.join(c, "month", "left").select("month", "sales", C.money(F.coalesce("_p", F.lit(0))).alias("purchases"))


def top_suppliers(purchases: DataFrame, natures: DataFrame, ref: str, n: int = 10) -> DataFrame:
    """Top-N domestic suppliers by value in 12 months (limit is the report's feature)."""
    fin = F.broadcast(natures.where(F.col("financial_flag") != "N").select("nature_code"))
    df = purchases.join(fin, "nature_code").where(_since_months("invoice_date", ref, 12) & F.col("excluded_at").isNull())
    agg = df.groupBy(F.col("supplier_name").alias("supplier")).agg(
        F.count("*").alias("orders"), C.money(F.round(F.sum("product_amount"), 2)).alias("value"))
    return agg.orderBy(F.col("value").desc(), F.col("supplier")).limit(n)


def import_suppliers(imports: DataFrame, n: int = 8) -> DataFrame:
    agg = imports.where(F.col("excluded_at").isNull()).groupBy("supplier_name").agg(
        F.round(F.sum("total_brl"), 0).cast("decimal(18,0)").alias("value"))
    return agg.orderBy(F.col("value").desc(), F.col("supplier_name")).limit(n)


# -- quotes (A-COM-23/24) -----------------------------------------------------------

def _ago(now: str, d: int):
    return F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(d))


def quote_kpis(quotes: DataFrame, now: str) -> DataFrame:
    """Live pipeline (open, <= 90 d), stalled (open, > 180 d), conversion among quotes >= 90 d old."""
    q = quotes.where(F.col("excluded_at").isNull() & (F.col("created_at") >= _ago(now, P.QUOTE_WINDOW_DAYS)))
    c, st, v = F.col("created_at"), F.col("detailed_status"), F.col("total_amount")
    live = (st == 1) & (c >= _ago(now, P.QUOTE_LIVE_DAYS))
    stalled = (st == 1) & (c < _ago(now, P.QUOTE_STALLED_DAYS))
    old = c <= _ago(now, P.QUOTE_LIVE_DAYS)
    return q.agg(
        C.money(F.coalesce(F.sum(F.when(live, v)), F.lit(0))).alias("pipeline_value"),
        C.count_if(live).alias("pipeline_n"),
        C.money(F.coalesce(F.sum(F.when(stalled, v)), F.lit(0))).alias("stalled_value"),
        C.count_if(stalled).alias("stalled_n"),
        C.pct(C.count_if(old & (st == 2)), C.count_if(old)).alias("conversion_pct"),
    )


def quote_cycle(quotes: DataFrame, orders: DataFrame, now: str) -> DataFrame:
    """Median days quote -> invoice (sketch-based median: bounded memory at any scale)."""
    q = quotes.where(F.col("created_at") >= _ago(now, P.QUOTE_WINDOW_DAYS)).select("quote_number", "created_at")
    o = orders.where(F.col("invoice_date").isNotNull()).select("quote_number", "invoice_date")
    j = q.join(o, "quote_number").where(F.col("invoice_date") >= F.col("created_at").cast("date"))
    d = F.datediff("invoice_date", F.col("created_at").cast("date"))
    return j.agg(F.percentile_approx(d, 0.5, 100000).cast("bigint").alias("median_cycle_days"))


def quote_cohorts(quotes: DataFrame, now: str) -> DataFrame:
    q = quotes.where(F.col("excluded_at").isNull() & (F.col("created_at") >= _ago(now, P.QUOTE_WINDOW_DAYS)))
    return q.groupBy(F.trunc(F.col("created_at").cast("date"), "month").alias("month")).agg(
        F.count("*").alias("quotes"), C.count_if(F.col("detailed_status") == 2).alias("won"),
        C.pct(C.count_if(F.col("detailed_status") == 2), F.count("*")).alias("conversion_pct"))


def quote_ageing(quotes: DataFrame, now: str) -> DataFrame:
    q = quotes.where(F.col("excluded_at").isNull() & (F.col("created_at") >= _ago(now, P.QUOTE_WINDOW_DAYS)) & (F.col("detailed_status") == 1))
    c = F.col("created_at")
    band = (F.when(c >= _ago(now, 30), "1. ate 30d").when(c >= _ago(now, 90), "2. 31-90d")
            .when(c >= _ago(now, 180), "3. 91-180d").otherwise("4. +180d"))
    return q.groupBy(band.alias("age_band")).agg(C.money_sum("total_amount").alias("value"), F.count("*").alias("quotes"))


def quote_stalled(quotes: DataFrame, partners: DataFrame, now: str, n: int = 20) -> DataFrame:
    c = F.col("created_at")
    q = quotes.where(F.col("excluded_at").isNull() & (F.col("detailed_status") == 1) & (c < _ago(now, P.QUOTE_STALLED_DAYS))
                     & (c >= _ago(now, P.QUOTE_WINDOW_DAYS)))
    j = q.join(partners.select("partner_code", "partner_name"), "partner_code", "left")
    out = j.select(
        "quote_number",
        F.coalesce("partner_name", F.col("partner_code").cast("string")).alias("client"),
        F.datediff(F.lit(now).cast("date"), c.cast("date")).cast("int").alias("days_stalled"),
        F.col("total_amount").alias("value"),
    )
    return out.orderBy(F.col("value").desc(), F.col("quote_number")).limit(n)
