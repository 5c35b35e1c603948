"""Price facts and net margin (A-PRC-1..6).

``price_facts`` is the one large join of the module (order items x orders on
the order number, a sort-merge join at scale; item dimension joined after the
aggregation, so the dimension join sees one row per item x channel x month).
The margin formula is plain Column arithmetic over the facts and a parameter
table joined on (item, channel, month).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.operators.commercial import billed_orders, price_channel, rolling_window

PARAM_COLS = ["custo_peca", "pct_ads", "pct_comissao", "pct_irpj_csll", "pct_irpj", "pct_csll", "pct_pis", "pct_cofins",
              "pct_credito_icms_ipi", "pct_credito_icms", "pct_credito_ipi", "mao_obra_unit", "pct_custo_fixo", "pct_outras"]


def _billed_items(items: DataFrame, orders: DataFrame, natures: DataFrame, ref: str) -> DataFrame:
    o = rolling_window(billed_orders(orders, natures, statuses=None), "invoice_date", ref, 12)
    o = o.select("order_number", "partner_code", "channel_code", "invoice_date")
    it = items.select("order_number", "item_code", "quantity", "unit_price", "icms_amount", "ipi_amount")
    return it.join(o, "order_number").select(
        "item_code", "order_number", "partner_code", "quantity", "unit_price", "icms_amount", "ipi_amount",
        F.trunc("invoice_date", "month").alias("month"), price_channel("channel_code").alias("channel"))


def _fact_aggs():
    return [
        F.countDistinct("order_number").alias("n_orders"),
        F.sum("quantity").cast("decimal(18,4)").alias("quantity"),
        F.sum(F.col("unit_price") * F.col("quantity")).cast("decimal(18,2)").alias("revenue"),
        C.money_sum("icms_amount").alias("icms"),
        C.money_sum("ipi_amount").alias("ipi"),
    ]


def _finish(agg: DataFrame, products: DataFrame) -> DataFrame:
    prod = products.select("item_code", "item_name", "linked_items_cost")
    out = agg.join(prod, "item_code", "left")
    return out.select(
        *[c for c in agg.columns],
        F.coalesce("item_name", "item_code").alias("item_name"),
        C.safe_div("revenue", "quantity").alias("mean_price"),
        F.nullif(F.col("linked_items_cost"), F.lit(0).cast("decimal(18,2)")).alias("cost_erp"),
    )


def price_facts(items: DataFrame, orders: DataFrame, natures: DataFrame, products: DataFrame, ref: str) -> DataFrame:
    """A-PRC-1: item x channel x month: orders, quantity, revenue, mean price, taxes, ERP unit cost (0 -> NULL)."""
    b = _billed_items(items, orders, natures, ref)
    return _finish(b.groupBy("item_code", "channel", "month").agg(*_fact_aggs()), products)


def price_facts_by_state(items: DataFrame, orders: DataFrame, natures: DataFrame, products: DataFrame,
                         partners: DataFrame, ref: str, blank_label: str = P.BLANK_STATE_LABEL) -> DataFrame:
    """A-PRC-2: same facts split by the client's state (blank -> default label)."""
    b = _billed_items(items, orders, natures, ref)
    pt = partners.select("partner_code", "state")
    b = b.join(pt, "partner_code", "left")
    st = F.when(F.trim(F.coalesce(F.col("state"), F.lit(""))) == "", F.lit(blank_label)).otherwise(F.col("state"))
    agg = b.groupBy("item_code", "channel", "month", st.alias("state")).agg(*_fact_aggs())
    return _finish(agg, products)


def _d(c) -> Column:
    return F.col(c).cast("double")


def _pct(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def margin_exprs() -> dict[str, Column]:
    """Margin formula (fixed operation order) over facts + parameter columns, by output name."""
    fat, qty, icms, ipi = _d("revenue"), _d("quantity"), _d("icms"), _d("ipi")
    unit = F.coalesce(_d("cost_erp"), F.col("custo_peca"), F.lit(0.0))
    parts = unit * qty
    cred_icms = fat * F.coalesce(F.col("pct_credito_icms"), F.col("pct_credito_icms_ipi"), F.lit(0.0)) / F.lit(100.0)
    cred_ipi = fat * _pct("pct_credito_ipi") / F.lit(100.0)
    inv_tax = F.greatest(icms + ipi - (cred_icms + cred_ipi), F.lit(0.0))
    ads = fat * _pct("pct_ads") / F.lit(100.0)
    com = fat * _pct("pct_comissao") / F.lit(100.0)
    oth = fat * _pct("pct_outras") / F.lit(100.0)
    fix = fat * _pct("pct_custo_fixo") / F.lit(100.0)
    labour = _pct("mao_obra_unit") * qty
    irpj = F.coalesce(F.col("pct_irpj"), F.col("pct_irpj_csll"), F.lit(0.0))
    ptax = (fat * _pct("pct_pis") / F.lit(100.0) + fat * _pct("pct_cofins") / F.lit(100.0)
            + fat * irpj / F.lit(100.0) + fat * _pct("pct_csll") / F.lit(100.0))
    total = parts + labour + inv_tax + ads + com + oth + fix + ptax
    margin = fat - total
    return {
        "unit_cost": unit, "parts_cost": parts, "labour": labour, "invoice_tax": inv_tax,
        "expenses": ads + com + oth + fix, "profit_taxes": ptax, "total_cost": total,
        "margin": margin, "margin_pct": F.when(fat != 0, margin / fat * F.lit(100.0)),
        "manual_cost": F.col("custo_peca").isNotNull(), "erp_cost_locked": F.col("cost_erp").isNotNull(),
    }


def margin_columns() -> list[Column]:
    return [c.alias(n) for n, c in margin_exprs().items()]


def _by_fact_keys(params: DataFrame, names: dict[str, str]) -> DataFrame:
    """Parameters under the keys of the facts, their columns renamed.

    They hold a row per item x channel x month, as many as the facts.  Spark does not count the rows that an
    ``explode`` adds, so it would take them for small and collect them on the driver: they are always shuffled.
    """
    cols = [F.col(c).alias(n) for c, n in names.items()]
    return params.select(F.col("canal").alias("channel"), F.col("mes").alias("month"), "item_code", *cols).hint("merge")


def price_margin(facts: DataFrame, params: DataFrame, keys=("item_code", "channel", "month")) -> DataFrame:
    """A-PRC-3: net margin per facts row with the month's parameters (missing params -> 0 / fallbacks)."""
    j = facts.join(_by_fact_keys(params, {c: c for c in PARAM_COLS}), list(keys), "left")
    base = [c for c in facts.columns]
    return j.select(*base, *margin_columns())


def price_totals(margins: DataFrame) -> DataFrame:
    """A-PRC-3 totals per month (double sums rounded to 4 dp: order-independent)."""
    return margins.groupBy("month").agg(
        C.money_sum("revenue").alias("revenue"),
        F.round(F.sum("margin"), 4).alias("margin"),
        F.round(F.try_divide(F.sum("margin") * F.lit(100.0), F.sum(_d("revenue"))), 4).alias("margin_pct"),
        F.count("*").alias("n_items"),
    )


def margin_with_overrides(facts: DataFrame, params: DataFrame, overrides: DataFrame) -> DataFrame:
    """A-PRC-5: margin under overriding parameters (override wins, else current) next to the current margin.

    One pass over the facts: they are joined to the current parameters and to the overrides once, and
    both margins are computed from the same rows.
    """
    keys = ["item_code", "channel", "month"]
    pr = _by_fact_keys(params, {c: c for c in PARAM_COLS})
    ov = _by_fact_keys(overrides, {c: f"_ov_{c}" for c in PARAM_COLS})
    j = facts.join(pr, keys, "left").join(ov, keys, "left")
    j = j.select("*", margin_exprs()["margin"].alias("margin_current"))
    sim = j.select(*facts.columns, "margin_current",
                   *[F.coalesce(F.col(f"_ov_{c}"), F.col(c)).alias(c) for c in PARAM_COLS])
    out = sim.select(*facts.columns, "margin_current", *margin_columns())
    return out.withColumn("margin_delta", F.col("margin") - F.col("margin_current"))


def price_months(facts: DataFrame) -> DataFrame:
    """A-PRC-6: months available."""
    return facts.select("month").distinct()
