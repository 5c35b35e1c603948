"""Validation and reconciliation (A-QA-1..7).

Metrics are unpivoted to (scope, metric, value) rows so the three layers join on
keys instead of being compared column by column on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C


def metrics_long(df: DataFrame, keys: list[str], metrics: list[str], value_name: str = "value") -> DataFrame:
    """Wide metric columns -> (keys..., metric, value) rows (DOUBLE)."""
    return df.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value_name))
                                                   for m in metrics])).alias("_m")).select(*keys, "_m.metric", f"_m.{value_name}")


def qa_status(delta_pct, bands=P.QA_BANDS, fallback=P.QA_FALLBACK):
    a = F.abs(delta_pct)
    expr = None
    for bound, label in bands:
        expr = F.when(a < bound, label) if expr is None else expr.when(a < bound, label)
    return expr.otherwise(fallback)


def qa_cascade(declared: DataFrame, source: DataFrame, warehouse: DataFrame, keys=("ref_date", "scope", "metric")) -> DataFrame:
    """A-QA-1: declared -> source -> warehouse per scope x metric x date.

    Each step has its difference and its % of the layer before (0 when that is 0); the traffic light goes by the
    whole way, warehouse against declared.  Inputs are long (keys..., value); a missing value counts as 0.
    """
    keys = list(keys)
    d = declared.select(*keys, F.col("value").alias("declared"))
    s = source.select(*keys, F.col("value").alias("source"))
    w = warehouse.select(*keys, F.col("value").alias("warehouse"))
    j = d.join(s, keys, "full_outer").join(w, keys, "full_outer")
    dec_, src, wh = (F.coalesce(c, F.lit(0.0)) for c in ("declared", "source", "warehouse"))

    def step(cur, prev):
        return F.when(prev == 0, F.lit(0.0)).otherwise((cur - prev) / prev * F.lit(100.0))

    total = step(wh, dec_)
    return j.select(*keys, "declared", "source", "warehouse", (src - dec_).alias("delta_source"), step(src, dec_).alias("source_pct"),
                    (wh - src).alias("delta_warehouse"), step(wh, src).alias("warehouse_pct"),
                    total.alias("delta_pct"), qa_status(total).alias("status"))


def qa_latest_status(qa: DataFrame, order=P.QA_SCOPE_ORDER, metric: str = "revenue") -> DataFrame:
    """A-QA-2: latest date's status of the revenue metric per scope, with the custom scope order."""
    from lakeops.operators.crm import latest_snapshot

    last = latest_snapshot(qa, "ref_date").where(F.col("metric") == metric)
    rank = P.case_lookup(F.col("scope"), [(s, i) for i, s in enumerate(order, 1)], 9).cast("int")
    return last.select("ref_date", "scope", "status", "delta_pct", rank.alias("scope_order"))


def compare_declared(actual: DataFrame, declared: DataFrame, keys: list[str], value: str = "clients",
                     abs_tol: float = 3, pct_tol: float = 10) -> DataFrame:
    """A-QA-3: cell-by-cell actual vs declared with tolerance flags (|diff| <= 3 and |diff %| <= 10)."""
    a = actual.select(*keys, F.col(value).alias("actual"))
    d = declared.select(*keys, F.col(value).alias("declared"))
    j = a.join(d, keys, "full_outer")
    av, dv = F.coalesce("actual", F.lit(0)), F.coalesce("declared", F.lit(0))
    diff = av - dv
    pct = F.try_divide(diff.cast("double") * F.lit(100.0), dv.cast("double"))
    return j.select(*keys, av.alias("actual"), dv.alias("declared"), diff.alias("diff"), pct.alias("diff_pct"),
                    (F.abs(diff) <= abs_tol).alias("within_abs"), (F.coalesce(F.abs(pct), F.lit(0.0)) <= pct_tol).alias("within_pct"))


def grain_reconcile(sales: DataFrame, value: str = "product_amount") -> DataFrame:
    """A-QA-4: the same revenue at total / family / family x salesperson grains (ROLLUP) and whether each level adds up."""
    r = sales.rollup("rfv_familia", "rfv_salesperson").agg(
        C.money_sum(value).alias("revenue"), F.countDistinct("partner_name").alias("clients"),
        F.grouping_id().alias("gid"))
    total = r.where(F.col("gid") == 3).select(F.col("revenue").alias("_total"))
    lvl = r.groupBy("gid").agg(F.sum("revenue").alias("level_sum"), F.count("*").alias("groups"))
    chk = lvl.crossJoin(F.broadcast(total)).select("gid", "groups", C.money("level_sum").alias("level_sum"),
                                                   (F.col("level_sum") == F.col("_total")).alias("adds_up"))
    grain = (F.when(F.col("gid") == 3, "total").when(F.col("gid") == 1, "family").otherwise("family_x_salesperson"))
    return chk.select(grain.alias("grain"), "groups", "level_sum", "adds_up")


def validate_totals(orders: DataFrame, start: str, end: str, codes=("1", "2", "3", "4")) -> DataFrame:
    """A-QA-5: totals for a fixed period and conditional sums by operation (nature) code."""
    o = orders.where(F.col("invoice_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    aggs = [F.count("*").alias("orders"), C.money_sum("product_amount").alias("total")]
    aggs += [C.money(F.coalesce(F.sum(F.when(F.col("nature_code") == c, F.col("product_amount"))), F.lit(0))).alias(f"total_op_{c}")
             for c in codes]
    return o.agg(*aggs)


def executive_summary(c360: DataFrame, alert_rows: DataFrame) -> DataFrame:
    """A-QA-6: per family: clients, revenue, clients at risk (segments 9-11), alerts by priority."""
    g = c360.groupBy("rfv_familia").agg(F.countDistinct("partner_code").alias("clients"), C.money_sum("revenue").alias("revenue"),
                                        C.count_if(F.col("segment_num").isin(9, 10, 11)).alias("at_risk"))
    a = alert_rows.groupBy("rfv_familia").agg(
        *[C.count_if(F.col("priority") == p).alias(f"alerts_p{p}") for p in range(1, 6)])
    j = g.join(a, "rfv_familia", "left")
    return j.select("rfv_familia", "clients", "revenue", "at_risk",
                    *[F.coalesce(F.col(f"alerts_p{p}"), F.lit(0).cast("bigint")).alias(f"alerts_p{p}") for p in range(1, 6)])


def read_layer(spark: SparkSession, gold_path: str, bronze_fn: Callable[[], DataFrame], fmt: str = "parquet") -> DataFrame:
    """A-QA-7: read the gold table when it exists, else compute from bronze."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(gold_path)
    if path.getFileSystem(conf).exists(path):
        return spark.read.format(fmt).load(gold_path)
    return bronze_fn()
