"""Registry of named queries (Spark builder + DuckDB oracle SQL).

A plan module registers ``name -> fn(spark, sf_dir) -> DataFrame`` and,
when the operator is SQL-expressible, the equivalent DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module (they register on import)."""
    from lakeops.plans import (  # noqa: F401
        commercial_q,
        sales_q,
        price_q,
        finance_q,
        cdc_q,
        platform_q,
        crm_q,
        ops_q,
        targets_q,
        qa_q,
        extra_q,
        loads_q,
    )
