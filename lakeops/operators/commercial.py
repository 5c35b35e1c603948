"""Commercial operators: billed-sales filter, silver sales, RFV base/score/summary/history.

Shape of the plan (at any scale): one scan of orders with pushed-down filters,
broadcast joins only against fixed parameter tables (natures, group->family),
a size-checked (AQE) join to the portfolio, and a single hash aggregation with
map-side partial aggregation per RFV key.  No window over fact-sized data.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C


def billed_orders(orders: DataFrame, natures: DataFrame, *, exclude_channels=tuple(P.EXCLUDED_CHANNELS),
                  statuses=tuple(P.BILLED_STATUSES), groups=None, include_cancelled: bool = True,
                  date_col: str = "invoice_date") -> DataFrame:
    """FLT-1 canonical billing filter.

    Nature must generate a financial movement (flag <> 'N', inner join so a
    missing nature drops the row), channel not excluded, date present,
    optional status / group sets.  Two-valued logic: a NULL channel or flag is
    dropped, as ``x <> 'v'`` does in SQL.
    """
    fin = F.broadcast(natures.where(F.col("financial_flag") != "N").select("nature_code"))
    df = orders.join(fin, "nature_code")
    cond = F.col(date_col).isNotNull()
    for ch in exclude_channels or ():
        cond = cond & (F.col("channel_code") != F.lit(ch))
    if statuses:
        cond = cond & F.col("order_status").isin(*statuses)
    if groups:
        cond = cond & F.col("salesperson_group_code").isin(*groups)
    if not include_cancelled:
        cond = cond & F.col("excluded_at").isNull()
    return df.where(cond)


PARTITION_COL = "ym"


def date_range(df: DataFrame, date_col: str, *ranges: tuple[Column, Column]) -> DataFrame:
    """Rows whose date lies in one of the [start, end) ranges.

    Plain comparisons reach the scan; on a table partitioned by the month of the invoice date they are stated on the
    partition column too, so other months are never listed or read.
    """
    d, hit = F.col(date_col), F.lit(False)
    for start, end in ranges:
        hit = hit | ((d >= start) & (d < end))
    out = df.where(hit)
    if PARTITION_COL in df.columns and date_col == "invoice_date":
        p, month = F.col(PARTITION_COL), F.lit(False)
        for start, end in ranges:
            month = month | ((p >= F.date_format(start, "yyyy-MM")) & (p <= F.date_format(F.date_sub(end, 1), "yyyy-MM")))
        out = out.where(month)
    return out


def in_months(df: DataFrame, date_col: str, *months: Column) -> DataFrame:
    """Rows whose date lies in one of the months, given by their first days."""
    return date_range(df, date_col, *((m, F.add_months(m, 1)) for m in months))


def rolling_window(df: DataFrame, date_col: str, ref, months: int = 12) -> DataFrame:
    """FLT-2: ``date_col`` from the first day of the month ``months`` before ``ref`` up to ``ref``.

    On a month-partitioned table (``ym`` = yyyy-MM of ``date_col``) the same window is also
    stated on the partition column, so whole months outside it are never listed or read.
    """
    d = F.col(date_col)
    start, end = C.lookback_start(ref, months), F.lit(ref).cast("date")
    out = df.where((d >= start) & (d <= end))
    if PARTITION_COL in df.columns:
        p = F.col(PARTITION_COL)
        out = out.where((p >= F.date_format(start, "yyyy-MM")) & (p <= F.date_format(end, "yyyy-MM")))
    return out


def silver_sales(orders: DataFrame, natures: DataFrame, group_family: DataFrame, portfolio: DataFrame, ref=None, *,
                 lookback_months: int = 12, date_col: str = "invoice_date", statuses=tuple(P.BILLED_STATUSES),
                 include_cancelled: bool = True) -> DataFrame:
    """A-COM-1: billed sales with RFV family and portfolio owner (fallback: the sale's salesperson).

    With ``ref=None`` no date window is applied (used by the history rebuild).
    """
    df = billed_orders(orders, natures, statuses=statuses, include_cancelled=include_cancelled, date_col=date_col)
    if ref is not None:
        df = rolling_window(df, date_col, ref, lookback_months)
    gf = F.broadcast(group_family.select("salesperson_group_code", "rfv_familia"))
    df = df.join(gf, "salesperson_group_code")
    pf = portfolio.where(F.col("is_active")).select(
        "partner_code", "rfv_familia", F.col("partner_name").alias("_pf_name"), F.col("salesperson_name").alias("_pf_owner"))
    df = df.join(pf, ["partner_code", "rfv_familia"], "left")
    return df.select(
        "order_number", "order_date", "invoice_date", "partner_code",
        F.coalesce(F.col("_pf_name"), F.col("partner_code").cast("string")).alias("partner_name"),
        "rfv_familia",
        F.coalesce(F.col("_pf_owner"), F.col("salesperson_name")).alias("rfv_salesperson"),
        "salesperson_code", F.col("salesperson_name").alias("sale_salesperson_name"), "salesperson_group_code",
        "nature_code", "company_code", "product_amount", "total_amount", "order_status",
        F.year(date_col).alias("year"), F.month(date_col).alias("month"),
        # the partition column goes along, so that a later window still prunes
        *([PARTITION_COL] if ref is None and PARTITION_COL in orders.columns else []),
    )


RFV_KEYS = ["partner_name", "rfv_familia", "rfv_salesperson"]


def rfv_base(sales: DataFrame, ref=None, date_col: str = "invoice_date") -> DataFrame:
    """A-COM-2: one row per client name x family x owner.

    If ``sales`` carries a ``ref_date`` column (history rebuild) it is part of
    the key and the recency reference; otherwise ``ref`` is the reference date.
    """
    keys = list(RFV_KEYS)
    if "ref_date" in sales.columns:
        keys = ["ref_date"] + keys
        ref_col = F.col("ref_date")
    else:
        ref_col = F.lit(ref).cast("date")
        sales = sales.withColumn("ref_date", ref_col)
        keys = ["ref_date"] + keys
    agg = sales.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set(F.col("partner_code").cast("string"))), ",").alias("partner_codes"),
        F.max(date_col).alias("last_purchase"),
        F.countDistinct("order_number").alias("frequency"),
        C.money(F.round(F.sum("product_amount"), 2)).alias("total_value"),
    )
    return _with_recency(agg)


def _with_recency(agg: DataFrame) -> DataFrame:
    """Columns of the base from its aggregates: days and months since the last purchase at ``ref_date``."""
    rec = F.datediff(F.col("ref_date"), F.col("last_purchase")).cast("int")
    return agg.select(
        *RFV_KEYS, "partner_codes", "last_purchase",
        rec.alias("recency_days"),
        F.round(rec / F.lit(30.0), 6).cast("decimal(12,6)").alias("recency_months"),
        "frequency", "total_value", "ref_date",
    )


def freq_bucket(freq: Column, family: Column, default_bands=P.FREQ_BANDS_DEFAULT, pharmacy_bands=P.FREQ_BANDS_PHARMACY,
                marker: str = P.PHARMACY_MARKER) -> Column:
    d = P.bands(freq, default_bands, P.FREQ_FALLBACK, op=">=")
    ph = P.bands(freq, pharmacy_bands, P.FREQ_FALLBACK, op=">=")
    return F.when(F.coalesce(family, F.lit("")).contains(marker), ph).otherwise(d)


def rec_bucket(days: Column, rec_bands=P.REC_BANDS) -> Column:
    return P.bands(days, rec_bands, P.REC_FALLBACK, op="<=")


def segment_of(cell: Column, matrix=None) -> tuple[Column, Column]:
    """(segment_num, segment label) of a 'FxRy' cell from the matrix parameter."""
    rows = matrix or P.rfv_matrix_rows()
    num = P.case_lookup(cell, [(r[0], r[3]) for r in rows], P.SEGMENT_UNKNOWN).cast("int")
    label = P.case_lookup(cell, [(r[0], r[4]) for r in rows], P.SEGMENT_UNKNOWN_LABEL)
    return num, label


def rfv_score(base: DataFrame, *, default_bands=P.FREQ_BANDS_DEFAULT, pharmacy_bands=P.FREQ_BANDS_PHARMACY,
              rec_bands=P.REC_BANDS, matrix=None) -> DataFrame:
    """A-COM-3: frequency / recency buckets and the 11-segment matrix (99 when unknown)."""
    fb = freq_bucket(F.col("frequency"), F.col("rfv_familia"), default_bands, pharmacy_bands)
    rb = rec_bucket(F.col("recency_days"), rec_bands)
    df = base.withColumn("freq_bucket", fb).withColumn("rec_bucket", rb)
    cell = F.concat("freq_bucket", "rec_bucket")
    num, label = segment_of(cell, matrix)
    return df.withColumn("cell", cell).withColumn("segment", label).withColumn("segment_num", num)


def rfv_summary(score: DataFrame) -> DataFrame:
    """A-COM-4: clients, revenue, mean ticket / frequency / recency per family x owner x segment."""
    return score.groupBy("ref_date", "rfv_familia", "rfv_salesperson", "segment", "segment_num").agg(
        F.countDistinct("partner_name").alias("clients"),
        C.money_sum("total_value").alias("revenue"),
        C.safe_div(F.sum("total_value"), F.count("total_value")).alias("mean_ticket"),
        F.avg("frequency").alias("mean_frequency"),
        F.avg("recency_days").alias("mean_recency_days"),
    )


def month_end_refs(first_month_end: str, n: int) -> list[str]:
    """``n`` consecutive month-end dates starting at ``first_month_end`` (driver-side, tiny)."""
    import datetime as dt

    y, m = int(first_month_end[:4]), int(first_month_end[5:7])
    out = []
    for _ in range(n):
        nxt = dt.date(y + (m // 12), m % 12 + 1, 1)
        out.append((nxt - dt.timedelta(days=1)).isoformat())
        y, m = nxt.year, nxt.month
    return out


def window_slots(refs: list[str], months: int = 12) -> tuple[list[str], dict[str, tuple[int, int]]]:
    """Cut points of the rolling windows of ``refs``, and per reference date its first and last slot.

    Slot ``i`` runs from the ``i``-th cut (from 1) up to the next one, so each window is a run of whole slots,
    whether or not the reference dates are ends of months.
    """
    days = {r: datetime.date.fromisoformat(r) for r in refs}
    back = {r: d.year * 12 + d.month - 1 - months for r, d in days.items()}
    starts = {r: datetime.date(m // 12, m % 12 + 1, 1) for r, m in back.items()}
    ends = {r: d + datetime.timedelta(days=1) for r, d in days.items()}
    cuts = sorted({*starts.values(), *ends.values()})
    return [c.isoformat() for c in cuts], {r: (cuts.index(starts[r]) + 1, cuts.index(ends[r])) for r in refs}


def rfv_slot_states(sales: DataFrame, cuts: list[str], date_col: str = "invoice_date") -> DataFrame:
    """Partial states of the RFV base per client name x family x owner, slot and ``next_slot``: amount, last purchase, codes, orders.

    ``next_slot`` is the next slot in which the same order of the client occurs again (null: none).  A window counts an order
    where its next slot lies beyond the window, that is once, so the counts of distinct orders add up exactly.
    """
    slot = F.size(F.filter(F.array(*(F.lit(c).cast("date") for c in cuts)), lambda c: c <= F.col(date_col)))
    # rows of one order (and those without an order) are merged before the shuffle: at most one row per order and slot goes on
    one = sales.withColumn("slot", slot).groupBy(*RFV_KEYS, "order_number", "slot").agg(
        F.sum("product_amount").alias("amount"), F.max(date_col).alias("last_purchase"),
        F.collect_set(F.col("partner_code").cast("string")).alias("codes"))
    later = F.lead("slot").over(Window.partitionBy(*RFV_KEYS, "order_number").orderBy("slot"))
    return one.withColumn("next_slot", later).groupBy(*RFV_KEYS, "slot", "next_slot").agg(
        F.sum("amount").alias("amount"), F.max("last_purchase").alias("last_purchase"),
        F.array_distinct(F.flatten(F.collect_set("codes"))).alias("codes"), F.count("order_number").alias("orders"))


def rfv_base_of_states(states: DataFrame, slots: dict[str, tuple[int, int]]) -> DataFrame:
    """The RFV base of each reference date from the states of the slots of its window."""
    windows = F.array(*(F.struct(F.lit(r).cast("date").alias("ref_date"), F.lit(a).alias("first"), F.lit(b).alias("last")) for r, (a, b) in slots.items()))
    at = states.withColumn("_w", F.explode(F.filter(windows, lambda w: (w["first"] <= F.col("slot")) & (F.col("slot") <= w["last"]))))
    over = F.col("next_slot").isNull() | (F.col("next_slot") > F.col("_w.last"))
    agg = at.groupBy(F.col("_w.ref_date").alias("ref_date"), *RFV_KEYS).agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("codes")))), ",").alias("partner_codes"),
        F.max("last_purchase").alias("last_purchase"), F.sum(F.when(over, F.col("orders")).otherwise(0)).alias("frequency"),
        C.money(F.round(F.sum("amount"), 2)).alias("total_value"))
    return _with_recency(agg)


def rfv_history(sales_all: DataFrame, refs: list[str], *, months: int = 12, date_col: str = "invoice_date") -> DataFrame:
    """A-COM-5: RFV score for several reference dates in one job (``ref_date`` column).

    Sales are aggregated once, into states per client and slot (a month, for ends of months); windows are put together from
    the states, so what is multiplied by the number of periods is months, not sales.
    """
    refs = sorted(set(refs))
    first, last = refs[0], refs[-1]
    known = date_range(sales_all, date_col, (C.lookback_start(first, months), F.date_add(F.lit(last).cast("date"), 1)))
    cuts, slots = window_slots(refs, months)
    return rfv_score(rfv_base_of_states(rfv_slot_states(known, cuts, date_col), slots))


def classify_channel(group_col="salesperson_group_code") -> Column:
    """A-COM-18 channel by salesperson group (NULL group -> marketplace)."""
    g = C.col(group_col)
    return F.when(g.isNull(), F.lit(P.CHANNEL_NULL_GROUP)).otherwise(
        P.case_lookup(g, P.CHANNEL_BY_GROUP, P.CHANNEL_OTHER))


def price_channel(code_col="channel_code") -> Column:
    """A-COM-18 / A-PRC-1 marketplace sub-channel by channel code."""
    return P.case_lookup(F.upper(F.trim(C.col(code_col))), P.PRICE_CHANNEL, P.PRICE_CHANNEL_DEFAULT)


def name_key(c) -> Column:
    """Name matching key: accents folded, only [A-Za-z0-9 ] kept, upper case."""
    return F.upper(F.regexp_replace(C.strip_accents(F.coalesce(C.col(c), F.lit(""))), "[^A-Za-z0-9 ]", ""))


def dominant(df: DataFrame, key: str, cat: str, val: str) -> DataFrame:
    """WIN-2: the category with the largest summed value per key (ties -> smallest category)."""
    g = df.groupBy(key, cat).agg(F.sum(val).alias("_v"))
    return g.groupBy(key).agg(F.min(F.struct((-F.col("_v")).alias("nv"), F.col(cat).alias("c"))).alias("_b")).select(
        key, F.col("_b.c").alias(cat))


def hybrid_rfv_base(orders: DataFrame, natures: DataFrame, partners: DataFrame, portfolio: DataFrame, ref: str, *,
                    groups=("FA", "FR", "PC"), new_family=P.NEW_CLIENT_FAMILY, new_owner: str = P.NEW_CLIENT_OWNER,
                    months: int = 12) -> DataFrame:
    """JON-3 / A-COM-2 (hybrid form): owner and family by portfolio code, else by normalised name,
    else NOVOS_<family of the client's dominant group> with the new-client owner; clients outside the
    portfolio are kept only for the given groups."""
    pf = portfolio.where(F.col("is_active"))
    cc = one_per_key_min(pf.select("partner_code", "rfv_familia", "salesperson_name"), "partner_code",
                         ["rfv_familia", "salesperson_name"])
    cn = (pf.withColumn("nome_norm", name_key("partner_name")).where(F.col("nome_norm") != "")
          .groupBy("nome_norm").agg(F.min(F.struct("rfv_familia", "salesperson_name")).alias("_n"))
          .select("nome_norm", F.col("_n.rfv_familia").alias("cn_fam"), F.col("_n.salesperson_name").alias("cn_sp")))
    b = rolling_window(billed_orders(orders, natures), "invoice_date", ref, months)
    v = b.join(partners.select("partner_code", F.col("partner_name").alias("partner_name_erp")), "partner_code", "left")
    v = v.withColumn("nome_norm", name_key("partner_name_erp")).withColumn(
        "pkey", F.coalesce(F.col("partner_name_erp"), F.col("partner_code").cast("string")))
    gd = dominant(v.where(F.col("salesperson_group_code").isin(*groups)), "pkey", "salesperson_group_code", "product_amount")
    gd = gd.select("pkey", F.col("salesperson_group_code").alias("dom_grp"))
    j = (v.join(cc.select("partner_code", F.col("rfv_familia").alias("cc_fam"), F.col("salesperson_name").alias("cc_sp")),
                "partner_code", "left")
         .join(cn, "nome_norm", "left").join(gd, "pkey", "left"))
    j = j.where(F.col("cc_fam").isNotNull() | F.col("cn_fam").isNotNull() | F.col("salesperson_group_code").isin(*groups))
    fam = F.coalesce("cc_fam", "cn_fam", P.case_lookup(F.col("dom_grp"), new_family))
    sp = F.coalesce("cc_sp", "cn_sp", F.lit(new_owner))
    sales = j.select("order_number", "invoice_date", "partner_code", "product_amount", F.col("pkey").alias("partner_name"),
                     fam.alias("rfv_familia"), sp.alias("rfv_salesperson"))
    return rfv_base(sales, ref)


def one_per_key_min(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    s = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("_row"))
    return df.groupBy(key).agg(F.min(s).alias("_b")).select(key, "_b._row.*")


def months_in(df: DataFrame, col: str, ref_month: str) -> DataFrame:
    """FLT-3: rows whose month is the reference month, the previous one or the same month last year."""
    m0 = F.lit(ref_month).cast("date")
    return in_months(df, col, m0, F.add_months(m0, -1), F.add_months(m0, -12))


def exclude_prefixes(df: DataFrame, col: str, prefixes) -> DataFrame:
    """FLT-5: drop rows whose ``col`` starts with any prefix (case-insensitive), NULL kept."""
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.upper(F.col(col)).startswith(p.upper())
    return df.where(~F.coalesce(cond, F.lit(False)))


def search(df: DataFrame, term: str, cols) -> DataFrame:
    """FLT-5: case-insensitive contains over several columns."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.col(c).cast("string").ilike(f"%{term}%"), F.lit(False))
    return df.where(cond)


def portfolio_label(portfolio: DataFrame) -> DataFrame:
    """A-COM-16: display label per portfolio (family / owner)."""
    return portfolio.select("rfv_familia", "salesperson_name").distinct().withColumn(
        "label", F.concat_ws(" · ", F.col("rfv_familia"), F.col("salesperson_name")))


def portfolio_revenue(orders: DataFrame, natures: DataFrame, partners: DataFrame, ref: str) -> DataFrame:
    """A-COM-16: exact revenue of each portfolio (the partner's portfolio code) over the rolling year: financial
    natures, no excluded channel, any order status."""
    b = rolling_window(billed_orders(orders, natures, statuses=None), "invoice_date", ref, 12).select(
        "partner_code", "order_number", "product_amount")
    j = b.join(partners.where(F.col("carteira_code").isNotNull()).select("partner_code", "carteira_code"), "partner_code")
    return j.groupBy("carteira_code").agg(
        F.countDistinct("partner_code").alias("codes"), F.countDistinct("order_number").alias("orders"),
        C.money_sum("product_amount").alias("revenue"))
