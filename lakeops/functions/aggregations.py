"""Generic aggregation helpers: numeric auto-summary, tagged unions, approximate top value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_HINTS = ("valor", "value", "amount", "revenue", "total", "faturamento")


def auto_summary(df: DataFrame, hints=MONEY_HINTS) -> DataFrame:
    """AGG-14: row count plus the sum of every numeric column whose name contains a money hint (one pass, unpivoted)."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("decimal", "double", "float", "long", "integer")
           and any(h in f.name.lower() for h in hints)]
    aggs = [F.count("*").alias("__rows")] + [F.sum(c).cast("decimal(38,2)").alias(c) for c in num]
    one = df.agg(*aggs)
    items = [F.struct(F.lit("rows").alias("measure"), F.col("__rows").cast("decimal(38,2)").alias("value"))]
    items += [F.struct(F.lit(f"sum_{c}").alias("measure"), F.col(c).alias("value")) for c in num]
    return one.select(F.explode(F.array(*items)).alias("x")).select("x.*")


def union_tagged(parts: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """SET-1: UNION ALL of same-shape tables with a literal tag column."""
    out = None
    for name, df in parts.items():
        t = df.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SET-3."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def approx_top_value(c) -> Column:
    """AGG-4 (approximate variant): most frequent value by the ``approx_top_k`` sketch (NULL counts as a value)."""
    return F.expr(f"approx_top_k({c}, 1)")[0]["item"]
