"""A key holding a third of the rows: the per-key operators stay exact and never use a window on that key."""
from pyspark.sql import functions as F

from lakeops.operators import cdc
from lakeops.operators.finance import share_of


def _hot(spark, n=30000):
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               (F.col("id") % 97 + 1).cast("decimal(18,2)").alias("v"), F.col("id").alias("ts"))
    return df


def test_share_of_hot_key(spark):
    df = _hot(spark)
    out = share_of(df, "v", "k", "share")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    tot = out.groupBy("k").agg(F.sum("share").alias("s")).where(F.abs(F.col("s") - 1) > 1e-9)
    assert tot.count() == 0


def test_one_per_key_hot_key(spark):
    df = _hot(spark)
    out = cdc.one_per_key(df, "k", ["ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan  # map-side partial aggregation before the shuffle
    row = out.where("k = 0").collect()
    assert len(row) == 1 and row[0].ts == max(i for i in range(30000) if i % 3 == 0)
    assert out.count() == df.select("k").distinct().count()
