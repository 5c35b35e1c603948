"""Materialised layer: same results as the on-the-fly views, and the window reaches the scan."""
import re
import tempfile

from pyspark.sql import functions as F

from lakeops.operators import commercial as com
from lakeops.sources.driver import DriverTables
from lakeops.sources.layers import LayerTables, materialize

from conftest import SF_SMALL


def _summary(T):
    s = com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, "2001-08-01")
    return com.rfv_summary(com.rfv_score(com.rfv_base(s, "2001-08-01")))


def test_layer_matches_views_and_prunes(spark):
    root = tempfile.mkdtemp(prefix="lakeops-layer-")
    materialize(spark, SF_SMALL, root, ["sales_order", "nature", "group_family", "portfolio"])
    L = LayerTables(spark, root)
    a = sorted(tuple(r) for r in _summary(L).collect())
    b = sorted(tuple(r) for r in _summary(DriverTables(spark, SF_SMALL)).collect())
    assert a == b
    w = com.rolling_window(L.sales_order, "invoice_date", "2001-08-01", 12)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "GreaterThanOrEqual(invoice_date" in plan
    months = {r.ym for r in w.select("ym").distinct().collect()}
    assert months <= {f"{y}-{m:02d}" for y in (2000, 2001) for m in range(1, 13)}


def test_month_panels_prune(spark):
    """Every month panel reads its months only: partition filters on the month, pushed filters on the date."""
    from lakeops.operators import sales, targets

    root = tempfile.mkdtemp(prefix="lakeops-layer-")
    materialize(spark, SF_SMALL, root, ["sales_order", "nature", "group_family", "portfolio"])
    L = LayerTables(spark, root)
    ds = sales.dashboard_sales(L.sales_order, L.nature)
    goals = spark.createDataFrame([("GERAL", None)], "view_key string, target decimal(18,2)").selectExpr("DATE '2001-07-01' AS month", "*")
    hol = spark.createDataFrame([("2001-07-04",)], "holiday string")
    everything = com.silver_sales(L.sales_order, L.nature, L.group_family, L.portfolio, None)
    panels = {
        "kpis": sales.sales_month_kpis(ds, "2001-07-01"), "channels": sales.sales_by_channel(ds, "2001-07-01"),
        "evolution": sales.sales_evolution(ds, "2001-07-01"), "weeks": sales.sales_weeks(ds, "2001-07-01"),
        "marketplace": sales.marketplace_detail(ds, "2001-07-01"), "three": com.months_in(ds, "invoice_date", "2001-07-01"),
        "target": targets.target_vs_actual(ds, goals, "2001-07-01"), "matrix": targets.revenue_matrix(ds, [2000, 2001], "2001-08-01"),
        "history": com.rfv_history(everything, ["2001-06-30", "2001-07-31"]),
        "totals": targets.sales_calendar_totals(L.sales_order, L.nature, hol, "2001-07-01", goals, "2001-07-06"),
    }
    for name, df in panels.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*ym#", plan), (name, plan)
        assert name == "history" or "GreaterThanOrEqual(invoice_date" in plan, name
