"""A copy-on-write table in buckets of a key hash: a batch rewrites the buckets it touches and no others.

``data/<write>/_bucket=<b>`` holds what one write made of bucket ``b``.  ``_manifests/v=<number>`` names, for one version of
the table, the write that each bucket is read from; it holds a line per bucket and none per row.  A version is
committed by one rename of its manifest to a name that must be free, so readers see whole versions only, a job that fails
leaves the table as it was, and of two writers of the same version one merges again on top of the other.

A merge shuffles the touched buckets once, by bucket; keys are unique in a bucket, so hot keys end with the
delta's own partial aggregate.  ``n_buckets`` is fixed when the table is made: take it so that a bucket fits a task
(a few hundred MB; 2^16 buckets for tens of TB).  Null keys count as equal to one another.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import cdc

N_BUCKETS = 64
BUCKET, NEW = "_bucket", "_new"
ATTEMPTS = 5  # merges of one delta, each on top of the version that another writer has put in between


class VersionTaken(RuntimeError):
    """Another writer has committed this version."""


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _root(root: str) -> str:
    return root.rstrip("/")


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed versions (``v=<number>``), oldest first (metadata only)."""
    fs, p, _ = filesystem(spark, f"{_root(root)}/_manifests")
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith("v="))


def manifest(spark: SparkSession, root: str, version: str | None = None) -> dict | None:
    """The manifest of a version (the last one by default): ``n_buckets``, ``keys`` with their types and ``writes``, the
    buckets that are read from each write.  None if the table has no version."""
    if version is None:
        there = versions(spark, root)
        if not there:
            return None
        version = there[-1]
    fs, p, jvm = filesystem(spark, f"{_root(root)}/_manifests/{version}")
    stream = fs.open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, number: int, content: dict) -> str:
    """Write the manifest beside its place and rename it there; VersionTaken if the place is not free."""
    version, sc = f"v={number:012d}", spark.sparkContext
    fs, made, jvm = filesystem(spark, f"{_root(root)}/_manifests/_{uuid.uuid4().hex}")
    out = fs.create(made, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    no_options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    place = jvm.org.apache.hadoop.fs.Path(f"{_root(root)}/_manifests/{version}")
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), sc._jsc.hadoopConfiguration()).rename(made, place, no_options)
    except Exception:
        taken = fs.exists(place)
        fs.delete(made, False)
        if taken:
            raise VersionTaken(version) from None
        raise
    return version


def _paths(root: str, content: dict, only: set[int] | None = None) -> list[str]:
    return [f"{_root(root)}/data/{w}/{BUCKET}={b}" for w, buckets in content["writes"].items() for b in buckets if only is None or b in only]


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, schema: T.StructType, version: str | None = None) -> DataFrame:
    """The rows of a version (the last one by default); no rows if the table has no version."""
    content = manifest(spark, root, version)
    return _read(spark, _paths(root, content) if content else [], schema)


def _buckets_in(df: DataFrame) -> set[int]:
    """The buckets of the rows: at most as many numbers as the table has buckets."""
    return {r[0] for r in df.select(BUCKET).distinct().collect()}


def read_keys(spark: SparkSession, root: str, schema: T.StructType, wanted: DataFrame) -> DataFrame:
    """The rows whose keys are in ``wanted``; only the buckets of these keys are read."""
    content = manifest(spark, root)
    if content is None:
        return spark.createDataFrame([], schema)
    keys = list(content["keys"])
    typed = wanted.select(*(F.col(k).cast(schema[k].dataType).alias(k) for k in keys)).distinct()
    touched = _buckets_in(typed.select(bucket_of(keys, content["n_buckets"]).alias(BUCKET)))
    rows, w = _read(spark, _paths(root, content, touched), schema).alias("t"), typed.alias("w")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    return rows.join(w, same, "left_semi")


def _write(rows: DataFrame, root: str) -> tuple[str, list[int]]:
    """Write rows that have a bucket; (name of the write, buckets it has made)."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    rows.write.partitionBy(BUCKET).parquet(f"{_root(root)}/data/{name}")
    fs, p, _ = filesystem(spark, f"{_root(root)}/data/{name}")
    names = (st.getPath().getName() for st in fs.listStatus(p))
    return name, sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    taken = {BUCKET, NEW} & set(schema.fieldNames())
    if taken:
        raise ValueError(f"columns {sorted(taken)} are the table's own")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def _key_types(schema: T.StructType, keys: Sequence[str]) -> dict[str, str]:
    return {k: schema[k].dataType.simpleString() for k in keys}


def _number(spark: SparkSession, root: str) -> int:
    there = versions(spark, root)
    return int(there[-1].split("=")[1]) + 1 if there else 0


def overwrite(df: DataFrame, root: str, keys: Sequence[str], order_by: Sequence[str], n_buckets: int = N_BUCKETS) -> str:
    """A version made of ``df`` alone (one row per key, the last by ``order_by``), in buckets of its own number."""
    spark, keys = df.sparkSession, list(keys)
    one = cdc.one_per_key(_typed(df, df.schema), keys, list(order_by))
    name, made = _write(one.withColumn(BUCKET, bucket_of(keys, n_buckets)).repartition(BUCKET), root)
    content = {"n_buckets": n_buckets, "keys": _key_types(df.schema, keys), "writes": {name: made} if made else {}}
    return _commit(spark, root, _number(spark, root), content)


def merge(delta: DataFrame, root: str, keys: Sequence[str], order_by: Sequence[str], schema: T.StructType, *,
          newest: bool = False, n_buckets: int = N_BUCKETS) -> str | None:
    """Upsert ``delta`` (one row per key, the last by ``order_by``) and commit a version; None if it has no rows.

    A matched row is replaced whole.  With ``newest`` the row with the higher ``order_by`` stays (the delta's, if
    equal), so batches may come in any order.  ``n_buckets`` counts only for the first version.
    """
    spark, keys, order_by = delta.sparkSession, list(keys), list(order_by)
    at = f"{_root(root)}/_delta/{uuid.uuid4().hex}"
    cdc.one_per_key(_typed(delta, schema), keys, order_by).write.parquet(at)
    fs, staged, _ = filesystem(spark, at)
    try:
        for _attempt in range(ATTEMPTS):
            there = versions(spark, root)
            content = manifest(spark, root, there[-1]) if there else {"n_buckets": n_buckets, "keys": _key_types(schema, keys), "writes": {}}
            if content["keys"] != _key_types(schema, keys):
                raise ValueError(f"the table's keys are {content['keys']}")
            number = bucket_of(keys, content["n_buckets"])
            new = spark.read.schema(schema).parquet(at)
            touched = _buckets_in(new.select(number.alias(BUCKET)))
            if not touched:
                return None
            old = _read(spark, _paths(root, content, touched), schema)
            rows = old.withColumn(NEW, F.lit(0)).unionByName(new.withColumn(NEW, F.lit(1))).withColumn(BUCKET, number).repartition(BUCKET)
            best = cdc.one_per_key(rows, [BUCKET, *keys], [*order_by, NEW] if newest else [NEW, *order_by]).drop(NEW)
            name, made = _write(best, root)
            kept = {w: [b for b in buckets if b not in touched] for w, buckets in content["writes"].items()}
            writes = {w: buckets for w, buckets in kept.items() if buckets} | {name: made}
            try:
                return _commit(spark, root, int(there[-1].split("=")[1]) + 1 if there else 0, content | {"writes": writes})
            except VersionTaken:
                fs.delete(filesystem(spark, f"{_root(root)}/data/{name}")[1], True)
        raise VersionTaken(f"{ATTEMPTS} merges were overtaken by other writers")
    finally:
        fs.delete(staged, True)


def drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the last ``keep`` versions, and the buckets that none of the kept ones reads."""
    there = versions(spark, root)
    gone, kept = there[:-keep], there[-keep:]
    if not gone:
        return
    used = {p for v in kept for p in _paths(root, manifest(spark, root, v))}
    for v in gone:
        paths = _paths(root, manifest(spark, root, v))
        fs, p, jvm = filesystem(spark, f"{_root(root)}/_manifests/{v}")
        fs.delete(p, False)
        for path in paths:
            if path not in used:
                fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
