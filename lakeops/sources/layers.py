"""Medallion layer: materialise the logical tables once, then read them with pruning.

``materialize`` writes each logical table of ``DriverTables`` as parquet; facts are
month-partitioned on their business date (``ym`` = yyyy-MM) and clustered by key, so the
analytics read them with partition pruning and row-group filter pushdown instead of
recomputing derived columns.  ``LayerTables`` exposes the same table names as
``DriverTables`` over the written files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.operators.commercial import PARTITION_COL
from lakeops.sources import sinks
from lakeops.sources.driver import DriverTables

# table -> (date column for month partitions or None, clustering columns)
LAYOUT = {
    "sales_order": ("invoice_date", ["partner_code"]),
    "order_item": (None, ["order_number"]),
    "partner": (None, []), "item": (None, []), "portfolio": (None, []),
    "nature": (None, []), "group_family": (None, []),
    "settled_title": ("payment_date", ["order_number"]), "payable": ("due_date", []), "receivable": ("due_date", []),
    "deals": ("add_time", ["org_id"]), "bom": (None, []),
}


def materialize(spark: SparkSession, sf_dir: str, root: str, tables=None) -> dict[str, str]:
    """Write the logical tables under ``root`` (one directory per table); returns the paths."""
    T = DriverTables(spark, sf_dir)
    out = {}
    for name in tables or LAYOUT:
        date_col, cluster = LAYOUT[name]
        df = getattr(T, name)
        path = f"{root.rstrip('/')}/{name}"
        if date_col:
            sinks.write_partitioned(df, path, date_col, cluster, partition_col=PARTITION_COL)
        else:
            sinks.write_full(df, path)
        out[name] = path
    return out


class LayerTables:
    """Same attribute names as ``DriverTables``, read from a materialised layer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in LAYOUT:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}")
