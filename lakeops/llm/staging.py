"""Tables written once in the cluster's shared folder (``spark.checkpoint.dir``) and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakeops.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, rows: int | None = None, per_file: int = 250_000) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors.

    ``rows``: about how many there are, where that is known; the table then has a file for each ``per_file`` of them
    and not one for each shuffle partition.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // per_file)))
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
