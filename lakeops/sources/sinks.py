"""Sinks: full reload, empty guard, append, month-partitioned layout, row-count validation.

A reload is written beside the table and swapped in when it is whole, so it may read what it replaces, a failed or
partial job leaves the table as it was, and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACE, _SALT = "_place", "_salt"


def _ordered(df: DataFrame, schema: dict[str, str] | None) -> DataFrame:
    if not schema:
        return df
    cols = []
    for name, typ in schema.items():
        cols.append((F.col(name) if name in df.columns else F.lit(None)).cast(typ).alias(name))
    return df.select(*cols)


def write_full(df: DataFrame, path: str, schema: dict[str, str] | None = None, fmt: str = "parquet") -> str:
    """SNK-1: truncate-and-load into ``path`` in schema order (missing columns -> typed NULL, extras dropped).

    The new content is written beside ``path`` and takes its place when it is whole, so ``df`` may read ``path``
    and a failed job leaves the table as it was.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tag = uuid.uuid4().hex
    new, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{kind}-{tag}") for kind in ("new", "old"))
    _ordered(df, schema).write.mode("error").format(fmt).save(str(new))
    if fs.exists(place):
        fs.rename(place, old)
    if not fs.rename(new, place):
        if fs.exists(old):
            fs.rename(old, place)
        raise OSError(f"{new} could not take the place of {path}")
    fs.delete(old, True)
    return path


def write_full_guarded(df: DataFrame, path: str, schema: dict[str, str] | None = None) -> dict:
    """SNK-2: never replace a table with an empty extract; returns a status record."""
    if df.isEmpty():  # a 1-row probe job, not a count
        return {"path": path, "status": "skipped", "reason": "empty extract"}
    write_full(df, path, schema)
    return {"path": path, "status": "ok"}


def write_append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """SNK-3."""
    df.write.mode("append").format(fmt).save(path)
    return path


def _measure(col: str, kind: T.DataType) -> Column:
    """A column's values as doubles in their order: numbers, dates and times themselves, strings by their first six bytes."""
    c = F.col(col)
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), c).cast("timestamp"))
    elif isinstance(kind, T.StringType):
        c = F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10)
    elif not isinstance(kind, (T.NumericType, T.BooleanType)):
        raise TypeError(f"{col} ({kind.simpleString()}) has no order to cluster by")
    return c.cast("double")


def _part(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts the value has reached; nulls none."""
    reached = F.size(F.filter(F.array(*(F.lit(x) for x in cuts)), lambda x: x <= value)) if cuts else F.lit(0)
    return F.when(value.isNull(), F.lit(0)).otherwise(reached).cast("long")


def z_value(df: DataFrame, cluster: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on the Z-order curve over its ``cluster`` columns, each cut at its own quantiles into 2^bits parts.

    The cuts come from one aggregate (a sketch a column; 2^bits - 1 numbers each reach the driver).  Skewed columns are cut
    where their rows lie; nulls are in the first part.
    """
    if bits * len(cluster) > 62:
        raise ValueError(f"{len(cluster)} columns of {bits} bits do not fit a long")
    values = [_measure(c, df.schema[c].dataType) for c in cluster]
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*(F.percentile_approx(v, shares, 10_000).alias(f"c{i}") for i, v in enumerate(values))).first()
    z = F.lit(0).cast("long")
    for i, v in enumerate(values):
        part = _part(v, sorted(set(found[i] or [])))
        for bit in range(bits):
            z = z + F.shiftleft(F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(values) + i)
    return z


def write_partitioned(df: DataFrame, path: str, date_col: str, cluster: Sequence[str] = (), mode: str = "overwrite",
                      dynamic: bool = True, partition_col: str = "month", files: int | None = None) -> str:
    """SNK-4: month partitions (``yyyy-MM`` text in ``partition_col``), clustered by ``cluster`` across files and in them.

    ``dynamic`` overwrite replaces only the months present in ``df`` (CDC-6).  Without ``cluster`` the rows are rebalanced
    by month: AQE splits what is large over more writers and joins what is small.  With it they are dealt by ranges of month and
    cluster column (several columns: of their Z-order place), so each file holds a narrow range of every one and scans skip
    files by their minima and maxima.  Ranges are cut at sampled quantiles, which reads ``df`` once more; a last random
    column divides a value that many rows share.  ``files`` is the number of ranges (default: the shuffle
    partitions, of which AQE joins small neighbours).
    """
    pc, cluster = partition_col, list(cluster)
    out = df.withColumn(pc, F.date_format(F.col(date_col), "yyyy-MM"))
    if not cluster:
        out = out.hint("rebalance", pc)
    else:
        own = {_PLACE, _SALT} & set(df.columns)
        if own:
            raise ValueError(f"columns {sorted(own)} are the writer's own")
        place = z_value(df, cluster) if len(cluster) > 1 else F.lit(0).cast("long")
        by = [pc, _PLACE, *cluster]
        out = out.withColumns({_PLACE: place, _SALT: F.rand(17)})
        out = out.repartitionByRange(*((files,) if files else ()), *by, _SALT).sortWithinPartitions(*by).drop(_PLACE, _SALT)
    w = out.write.mode(mode).partitionBy(pc)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables as one DataFrame (entity, rows) — one job per table, no collect."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("entity"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """SNK-5: expected vs actual rows per entity; an entity missing on either side counts -1."""
    e = expected.select("entity", F.col("rows").alias("expected"))
    a = actual.select("entity", F.col("rows").alias("actual"))
    j = e.join(a, "entity", "full_outer")
    j = j.select("entity", F.coalesce("expected", F.lit(-1)).cast("bigint").alias("expected"),
                 F.coalesce("actual", F.lit(-1)).cast("bigint").alias("actual"))
    return j.withColumn("diff", F.col("actual") - F.col("expected")).withColumn("ok", F.col("diff") == 0)
