"""SNK-4: files of a clustered table hold narrow ranges of every cluster column."""
import glob
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeops.sources import sinks as SK


def _ranges(path, col):
    out = []
    for f in glob.glob(f"{path}/month=*/*.parquet"):
        values = pq.read_table(f, columns=[col]).column(col).drop_null()
        if len(values):
            v = sorted(values.to_pylist())
            out.append((v[0], v[-1]))
    return out


def _rows(spark, n=40_000):
    i = F.col("id")
    return spark.range(n).select(
        "id", F.expr("date_add(DATE '2024-03-01', CAST(id % 31 AS INT))").alias("day"),
        F.when(i % 50 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("a"),
        F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)), 3.0).cast("decimal(18,2)").alias("b"),
        F.md5(i.cast("string")).alias("c"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id % 997 AS INT))").alias("t"))


@pytest.mark.parametrize("cluster", [["a"], ["a", "b"], ["b", "c"], ["a", "t"]])
def test_predicates_on_each_cluster_column_skip_files(spark, cluster):
    path, df = tempfile.mkdtemp(prefix="lakeops-z-"), _rows(spark)
    SK.write_partitioned(df, path, "day", cluster=cluster, files=256)  # with 64 the worst value of two columns is in a quarter of them
    back = spark.read.parquet(path)
    assert back.drop("month").exceptAll(df.select(*back.drop("month").columns)).isEmpty() and back.count() == 40_000
    for c in cluster:
        ranges = _ranges(path, c)
        assert len(ranges) >= 240
        for wanted in [r[c] for r in df.where(F.col(c).isNotNull()).orderBy(F.xxhash64("id")).limit(10).collect()]:
            assert sum(lo <= wanted <= hi for lo, hi in ranges) < len(ranges) / 4, (c, wanted)


def test_a_hot_value_is_divided(spark):
    """A third of the rows share one value of each column; no file holds more than a few shares of them."""
    hot = F.col("id") % 3 == 0
    df = _rows(spark, 30_000).withColumns({"a": F.when(hot, F.lit(5)).otherwise(F.col("a")), "b": F.when(hot, F.lit(7).cast("decimal(18,2)")).otherwise(F.col("b"))})
    for cluster in (["a"], ["a", "b"]):
        path = tempfile.mkdtemp(prefix="lakeops-z-")
        SK.write_partitioned(df, path, "day", cluster=cluster, files=32)
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 3 * 30_000 / 32


def test_months_empty_tables_and_refusals(spark):
    path, df = tempfile.mkdtemp(prefix="lakeops-z-"), _rows(spark, 500)
    two = df.unionByName(df.withColumn("day", F.add_months("day", 1)))
    SK.write_partitioned(two, path, "day", cluster=["a", "b"])
    SK.write_partitioned(df.limit(3), path, "day", cluster=["a", "b"])  # replaces its month alone
    got = {r["month"]: r["count"] for r in spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).count().collect()}
    assert got["2024-03"] == 3 and sum(got.values()) == 503
    SK.write_partitioned(df.limit(0), f"{path}-empty", "day", cluster=["a", "b"])
    nulls = df.withColumns({"a": F.lit(None).cast("long"), "b": F.lit(None).cast("decimal(18,2)")})
    SK.write_partitioned(nulls, f"{path}-nulls", "day", cluster=["a", "b"])
    assert spark.read.parquet(f"{path}-nulls").count() == 500
    with pytest.raises(ValueError):
        SK.write_partitioned(df.withColumnRenamed("c", "_salt"), path, "day", cluster=["a"])
    with pytest.raises(TypeError):
        SK.write_partitioned(df.withColumn("c", F.array("a")), path, "day", cluster=["a", "c"])
