"""Operations and engineering: production, components, stock, movements, BOM lines and
explosion, item catalogue, serial numbers (A-OPS-1..8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.session import cut_lineage

# Production status labels and BOM link labels (parameter defaults).
PROD_STATUS = [(0, "Aberta"), (1, "Em produção"), (2, "Suspensa"), (3, "Encerrada")]
LINK_LABELS = [("M", "Matéria-prima"), ("A", "Acessório")]


def live_rows(df: DataFrame) -> DataFrame:
    """FLT-4: rows that are not cancelled, without the stamp."""
    return df.where(F.col("excluded_at").isNull()).drop("excluded_at")


def production_monthly(prod: DataFrame, ref: str, months: int = 13) -> DataFrame:
    """A-OPS-1: per month of the last ``months``: orders, planned, actual, efficiency % (actual / planned)."""
    known = live_rows(prod).where(F.col("order_date") >= F.add_months(F.lit(ref).cast("date"), -months))
    g = known.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.countDistinct("prod_order_number").alias("orders"), F.sum("planned_qty").cast("decimal(18,4)").alias("planned"),
        F.sum("actual_qty").cast("decimal(18,4)").alias("actual"))
    return g.withColumn("efficiency_pct", C.pct("actual", "planned"))


def production_status(prod: DataFrame, labels=PROD_STATUS) -> DataFrame:
    """A-OPS-1: orders by status label."""
    lbl = P.case_lookup(F.col("prod_status"), labels, "Outro")
    return live_rows(prod).groupBy(lbl.alias("status")).agg(F.countDistinct("prod_order_number").alias("orders"),
                                                 F.sum("planned_qty").cast("decimal(18,4)").alias("planned"))


def top_components(comp: DataFrame, items: DataFrame, n: int = 20) -> DataFrame:
    """A-OPS-2: most consumed components (top-n report)."""
    g = live_rows(comp).groupBy("item_code").agg(F.sum("quantity").cast("decimal(18,4)").alias("quantity"),
                                      F.countDistinct("prod_order_number").alias("orders"))
    g = g.orderBy(F.col("quantity").desc(), F.col("item_code")).limit(n)
    return g.join(items.select("item_code", "item_name"), "item_code", "left")


def stock_items(stock: DataFrame, items: DataFrame) -> DataFrame:
    """A-OPS-3: items with a positive balance on the latest snapshot, with name and group."""
    from lakeops.operators.crm import latest_snapshot

    s = latest_snapshot(live_rows(stock), "snapshot_date").where(F.col("general_balance") > 0)
    return s.join(items.select("item_code", "item_name", "group_code"), "item_code", "left")


def stock_by_group(stock_pos: DataFrame) -> DataFrame:
    """A-OPS-3: positive stock by group: items and units."""
    return stock_pos.groupBy("group_code").agg(F.count("*").alias("items"),
                                               F.sum("general_balance").cast("decimal(18,4)").alias("units"))


def stock_movement(mov: DataFrame, ref: str, months: int = 13) -> DataFrame:
    """A-OPS-4: units in (E) / out (S) per month over the last ``months`` up to ``ref``."""
    end = F.lit(ref).cast("date")
    m = live_rows(mov).where(F.col("movement_date").between(F.add_months(end, -months), end))
    t = F.col("operation_type")
    return m.groupBy(F.trunc("movement_date", "month").alias("month")).agg(
        F.coalesce(F.sum(F.when(t == "E", F.col("quantity"))), F.lit(0)).cast("decimal(18,4)").alias("units_in"),
        F.coalesce(F.sum(F.when(t == "S", F.col("quantity"))), F.lit(0)).cast("decimal(18,4)").alias("units_out"))


def bom_lines(bom: DataFrame, items: DataFrame, labels=LINK_LABELS) -> DataFrame:
    """A-OPS-5 / JON-9: BOM lines with parent and child names (the item dimension in two roles) and link label."""
    it = items.select("item_code", "item_name")
    par = it.select(F.col("item_code").alias("parent_item_code"), F.col("item_name").alias("parent_name"))
    chi = it.select(F.col("item_code").alias("child_item_code"), F.col("item_name").alias("child_name"))
    out = live_rows(bom).join(par, "parent_item_code", "left").join(chi, "child_item_code", "left")
    return out.withColumn("link_label", P.case_lookup(F.col("link_type"), labels, "Outro"))


def bom_kpis(bom: DataFrame) -> DataFrame:
    """A-OPS-5: lines, distinct parents and children, mean children per parent."""
    return live_rows(bom).agg(F.count("*").alias("lines"), F.countDistinct("parent_item_code").alias("parents"),
                   F.countDistinct("child_item_code").alias("children")).withColumn(
        "children_per_parent", C.safe_div("lines", "parents"))


def bom_explode(bom: DataFrame, roots: DataFrame | None = None, max_depth: int = P.BOM_MAX_DEPTH,
                sep: str = P.BOM_PATH_SEP, checkpoint_every: int = 1) -> DataFrame:
    """A-OPS-6: multi-level explosion for every root (or the given roots): level, quantity product, path.

    Breadth-first iterative join, one level per iteration, bounded by ``max_depth``
    (a cycle therefore stops at the bound).  The loop runs on the driver over
    *levels* only; each level is a distributed join of the frontier with the edge
    table.  Lineage is cut every ``checkpoint_every`` levels into the shared
    checkpoint folder, so a lost executor recomputes at most a few levels.
    """
    e = live_rows(bom).select("parent_item_code", "child_item_code", F.col("quantity").cast("decimal(38,6)").alias("quantity"))
    start = e if roots is None else e.join(roots.select(F.col("item_code").alias("parent_item_code")), "parent_item_code")
    frontier = start.select(F.col("parent_item_code").alias("root_item_code"), F.col("child_item_code").alias("item_code"),
                            F.lit(1).alias("level"), F.col("quantity").alias("total_quantity"),
                            F.concat(F.col("parent_item_code"), F.lit(sep), F.col("child_item_code")).alias("path"))
    levels = [frontier]
    for depth in range(2, max_depth + 1):
        nxt = frontier.join(e, frontier.item_code == e.parent_item_code).select(
            "root_item_code", F.col("child_item_code").alias("item_code"), F.lit(depth).alias("level"),
            (F.col("total_quantity") * F.col("quantity")).cast("decimal(38,6)").alias("total_quantity"),
            F.concat(F.col("path"), F.lit(sep), F.col("child_item_code")).alias("path"))
        if depth % checkpoint_every == 0:
            nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        levels.append(nxt)
        frontier = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def catalog_kpis(items: DataFrame) -> DataFrame:
    """A-OPS-7: items, active items, groups, families."""
    return items.agg(F.count("*").alias("items"), C.count_if(F.col("is_active")).alias("active"),
                     F.countDistinct("group_code").alias("groups"), F.countDistinct("family_code").alias("families"))


def catalog_mix(items: DataFrame, n: int = 10) -> DataFrame:
    """A-OPS-7: top groups by number of items."""
    g = items.groupBy("group_code").agg(F.count("*").alias("items"))
    return g.orderBy(F.col("items").desc(), F.col("group_code")).limit(n)


def catalog_search(items: DataFrame, term: str, page: int = 1, size: int = 50) -> DataFrame:
    """A-OPS-7 / FLT-5 / FLT-7: case-insensitive search over code and name, ordered page with the total count."""
    pat = f"%{term}%"
    hit = items.where(F.col("item_code").ilike(pat) | F.col("item_name").ilike(pat))
    total = hit.agg(F.count("*").alias("total"))
    pg = hit.orderBy("item_code").offset((page - 1) * size).limit(size)
    return pg.crossJoin(F.broadcast(total))


def serials(ser: DataFrame, items: DataFrame) -> DataFrame:
    """A-OPS-8: per item: serials, in use ('X'), lots."""
    g = live_rows(ser).groupBy("item_code").agg(F.countDistinct("serial_number").alias("serials"),
                                     C.count_if(F.col("is_in_use") == "X").alias("in_use"),
                                     F.countDistinct("batch_number").alias("lots"))
    return g.join(items.select("item_code", "item_name"), "item_code", "left")
