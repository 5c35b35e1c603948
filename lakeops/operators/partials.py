"""Mergeable states per month, from which any window of months is put together without reading the facts again.

A state holds the row count, the exact sum of a measure, and three sketches of bounded size: distinct values (HLL), the
distribution of the measure (KLL) and the most frequent values.  States are a few KB per month and key whatever the
number of rows, so a dashboard reads as many rows as its window has months, and a load recomputes the states of
the months it touched only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_states(df: DataFrame, keys: list[str], date_col: str, *, measure: str, distinct: str, item: str, lg_k: int = 12, quantile_k: int = 200, tracked: int = 1000) -> DataFrame:
    """AGG-2, AGG-4, AGG-5 as partial states: one row per month of ``date_col`` and keys (null keys are a group, rows without a date go).

    ``distinct`` is an integer, string or binary column; its nulls and those of ``measure`` count nowhere, a null ``item`` is a value.
    One aggregation with partial sketches on the map side, so a key that holds most of the rows sends one state per task.
    """
    month = F.trunc(date_col, "month")
    return df.where(F.col(date_col).isNotNull()).groupBy(month.alias("month"), *keys).agg(
        F.count("*").alias("n_rows"), F.sum(measure).alias("amount"), F.hll_sketch_agg(distinct, F.lit(lg_k)).alias("distinct_state"),
        F.kll_sketch_agg_double(F.col(measure).cast("double"), F.lit(quantile_k)).alias("quantile_state"),
        F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("top_state"))


def over_months(states: DataFrame, keys: list[str], first, last, *, quantile: float = 0.5, top: int = 1, tracked: int = 1000) -> DataFrame:
    """One row per keys for the months from ``first`` to ``last`` (first days): n_rows, amount, distinct, quantile, top (array of item and count).

    Rows and sums are exact.  The standard error of ``distinct`` is 1.04 / 2^(lg_k / 2) (1.6 % for 12); the rank of ``quantile`` is off by
    some 1.3 % (k = 200); counts in ``top`` are exact while a group has at most 3/4 of ``tracked`` values.  A group without a measure has a null quantile.
    """
    month = F.col("month")
    g = states.where((month >= F.lit(first).cast("date")) & (month <= F.lit(last).cast("date"))).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("amount"), F.hll_union_agg("distinct_state").alias("_d"),
        F.kll_merge_agg_double("quantile_state").alias("_q"), F.expr(f"approx_top_k_combine(top_state, {tracked})").alias("_t"))
    some = F.kll_sketch_get_n_double("_q") > 0
    return g.select(*keys, "n_rows", "amount", F.hll_sketch_estimate("_d").alias("distinct"),
                    F.when(some, F.kll_sketch_get_quantile_double("_q", F.lit(quantile))).alias("quantile"), F.expr(f"approx_top_k_estimate(_t, {top})").alias("top"))
