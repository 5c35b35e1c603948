"""Source readers: entity scans with alias projection and domain predicate, delta scans,
header/line extracts, role lookups, wide->long code lists, lifecycle columns,
tolerant JSON record roots and parent->child fan-out.

Everything is a lazy DataFrame over a columnar scan, so the predicates become
``PushedFilters`` and the projections become the ``ReadSchema``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class EntitySpec:
    """One source entity: where it lives, how columns are renamed, its domain predicate and schema."""

    name: str
    path: str
    columns: dict[str, str]  # target name -> source column / SQL expression
    predicate: str | None = None  # domain partition, e.g. "l_returnflag = 'R'"
    key: tuple[str, ...] = ()
    kind: str = "FACT"  # DIM / FACT / BRIDGE / SNAPSHOT
    watermark: str | None = None
    exclusion: str | None = None
    schema: dict[str, str] = field(default_factory=dict)  # target name -> Spark type
    fmt: str = "parquet"


def read_entity(spark: SparkSession, spec: EntitySpec) -> DataFrame:
    """SRC-1: full scan with the domain predicate and alias projection."""
    df = spark.read.format(spec.fmt).load(spec.path)
    if spec.predicate:
        df = df.where(F.expr(spec.predicate))
    return df.select(*[F.expr(src).alias(dst) for dst, src in spec.columns.items()])


def read_delta(df: DataFrame, watermark_col: str, since, exclusion_col: str | None = None) -> DataFrame:
    """SRC-2: rows changed (or excluded) since the lower bound."""
    s = F.lit(since).cast("timestamp_ntz")
    cond = F.col(watermark_col) >= s
    if exclusion_col:
        cond = cond | (F.col(exclusion_col) >= s)
    return df.where(cond)


def header_lines(header: DataFrame, lines: DataFrame, key: str | Sequence[str], inherit: Sequence[str] = (),
                 header_cols: Sequence[str] = ()) -> DataFrame:
    """SRC-3: header x lines (inner), lines inherit header columns when their own value is NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    hsel = header.select(*keys, *[F.col(c).alias(f"_h_{c}") for c in inherit], *header_cols)
    j = lines.join(hsel, keys)
    for c in inherit:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"_h_{c}"))).drop(f"_h_{c}")
    return j


def role_lookup(fact: DataFrame, dim: DataFrame, dim_key: str, dim_value: str, roles: dict[str, str]) -> DataFrame:
    """SRC-4: the same dimension joined once per role (fact column -> output name)."""
    out = fact
    for fact_col, out_name in roles.items():
        d = dim.select(F.col(dim_key).alias(f"_k_{out_name}"), F.col(dim_value).alias(out_name))
        out = out.join(d, F.col(fact_col) == F.col(f"_k_{out_name}"), "left").drop(f"_k_{out_name}")
    return out


def distinct_codes(df: DataFrame, cols: Sequence[str], name: str = "code") -> DataFrame:
    """SRC-5: several code columns -> one distinct list, blanks dropped."""
    long = df.select(F.explode(F.array(*[F.trim(F.col(c).cast("string")) for c in cols])).alias(name))
    return long.where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def derive_lifecycle(df: DataFrame, excluded_col: str = "excluded_at", changed: str | None = None,
                     created: str | None = None, blank_to_null: Sequence[str] = ()) -> DataFrame:
    """SRC-6: ``is_active`` from the soft-delete stamp, ``updated_at = coalesce(changed, created)``, ``nullif(x, '')``."""
    out = df.withColumn("is_active", F.col(excluded_col).isNull())
    if changed and created:
        out = out.withColumn("updated_at", F.coalesce(F.col(changed), F.col(created)))
    for c in blank_to_null:
        out = out.withColumn(c, F.nullif(F.col(c), F.lit("")))
    return out


def json_records(df: DataFrame, payload_col: str, record_schema: T.StructType, data_path: str | None = None) -> DataFrame:
    """SRC-7: records of a JSON document with a tolerant root.

    The root is ``data_path`` when given, else the first of ``items`` / ``data`` /
    ``results`` that is an array, else the document itself.
    """
    arr = T.ArrayType(record_schema)
    doc = F.col(payload_col)
    if data_path:
        recs = F.from_json(F.get_json_object(doc, f"$.{data_path}"), arr)
    else:
        recs = F.coalesce(*[F.from_json(F.get_json_object(doc, f"$.{k}"), arr) for k in ("items", "data", "results")],
                          F.array(F.from_json(doc, record_schema)))
    keep = [c for c in df.columns if c != payload_col]
    return df.select(*keep, F.explode_outer(recs).alias("_r")).select(*keep, "_r.*")


def read_json_records(spark: SparkSession, path: str, record_schema: T.StructType, data_path: str | None = None) -> DataFrame:
    """SRC-7 over files: one JSON document per file."""
    raw = spark.read.text(path, wholetext=True).withColumnRenamed("value", "_doc")
    return json_records(raw, "_doc", record_schema, data_path)


def explode_children(df: DataFrame, child_col: str, parent_id: str, as_name: str, position: bool = True) -> DataFrame:
    """SRC-8: one row per child element, stamped with the parent id (and its position)."""
    if position:
        return df.select(F.col(parent_id), F.posexplode_outer(child_col).alias("position", as_name))
    return df.select(F.col(parent_id), F.explode_outer(child_col).alias(as_name))
