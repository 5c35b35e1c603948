"""Price parameters are as many as the facts: they are shuffled, however small Spark takes them for."""
from pyspark.sql import functions as F

from lakeops.operators import price as PR


def _frames(spark, tmp_path):
    spark.createDataFrame([(str(i),) for i in range(40)], "item_code string").write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    facts = items.select("item_code", F.lit("Amazon").alias("channel"), F.to_date(F.lit("2001-06-01")).alias("month"),
                         F.lit(10).cast("decimal(18,4)").alias("quantity"), F.lit(100).cast("decimal(18,2)").alias("revenue"),
                         F.lit(1).cast("decimal(18,2)").alias("icms"), F.lit(1).cast("decimal(18,2)").alias("ipi"),
                         F.lit(None).cast("decimal(18,2)").alias("cost_erp"))
    params = items.where("cast(item_code as int) % 2 = 0").select(
        "item_code", F.explode(F.array(F.lit("Amazon"), F.lit("Other"))).alias("canal"),
        F.to_date(F.lit("2001-06-01")).alias("mes"), *[F.lit(5.0).alias(c) for c in PR.PARAM_COLS])
    return facts, params


def _broadcasts(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") + df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_price_margin_shuffles_the_parameters(spark, tmp_path):
    facts, params = _frames(spark, tmp_path)
    got = PR.price_margin(facts, params)
    assert _broadcasts(got) == 0
    rows = {r.item_code: r for r in got.collect()}
    assert len(rows) == 40 and rows["2"].manual_cost and not rows["3"].manual_cost
    assert rows["3"].margin == 98.0 and rows["2"].unit_cost == 5.0


def test_margin_with_overrides_shuffles_parameters_and_overrides(spark, tmp_path):
    facts, params = _frames(spark, tmp_path)
    over = params.where("item_code = '2'").select("item_code", "canal", "mes", *[F.lit(8.0 if c == "pct_comissao" else None).cast("double").alias(c) for c in PR.PARAM_COLS])
    got = PR.margin_with_overrides(facts, params, over)
    assert _broadcasts(got) == 0
    rows = {r.item_code: r for r in got.collect()}
    assert len(rows) == 40 and round(rows["2"].margin_delta, 9) == -3.0 and rows["4"].margin_delta == 0.0
