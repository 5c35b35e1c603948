"""Change-data operators: dedup, upsert, version archive, soft delete, windows, periods, catalogue mirror.

All of them are set operations expressed with joins and aggregations:

* "latest row per key" is ``max(struct(order..., row))`` — a partial
  (map-side) aggregate, so a hot key never gathers its rows in one task, and
  ties are broken by the row content (deterministic);
* upsert = ``target LEFT ANTI delta  UNION ALL  delta`` (no v2 MERGE needed);
* soft delete / preserve / archive are left or inner joins on the key.

Results are new DataFrames; writers (``lakeops.sources.sinks``) always write to
a new path/version, never over the path being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import columns as C


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def one_per_key(df: DataFrame, keys, order: Sequence[str] | str, latest: bool = True) -> DataFrame:
    """JON-4 / WIN-4 / WIN-5: keep one row per key — the one with the largest (``latest``) or smallest ``order``.

    Implemented as an aggregate of ``struct(order..., row...)``; equal orders are
    decided by the remaining row values, so the result is deterministic.
    """
    keys, order = _cols(keys), _cols(order)
    rest = [c for c in df.columns if c not in keys]
    s = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("_row"))
    agg = F.max(s) if latest else F.min(s)
    return df.groupBy(*keys).agg(agg.alias("_best")).select(*keys, "_best._row.*").select(*df.columns)


def dedup(df: DataFrame, subset=None) -> DataFrame:
    """PRJ-3: drop duplicate rows (whole row, or first row per ``subset`` by the remaining columns)."""
    if subset is None:
        return df.dropDuplicates()
    return one_per_key(df, subset, [c for c in df.columns if c not in _cols(subset)], latest=False)


def upsert(target: DataFrame, delta: DataFrame, keys, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """CDC-1: matched keys take the delta row (all non-key columns), new keys are inserted.

    The delta is first reduced to one row per key (latest by ``order_by``).
    """
    keys = _cols(keys)
    d = one_per_key(delta, keys, order_by) if order_by else delta
    d = d.select(*target.columns)
    return target.join(d.select(*keys), keys, "left_anti").unionByName(d)


def row_hash(cols: Sequence[str]) -> Column:
    """Content hash of the given columns (md5 over the '|'-joined text, NULL as empty)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def archive_changed(target: DataFrame, delta: DataFrame, keys, version_col: str, ts) -> DataFrame:
    """CDC-2: target rows whose version changes in the delta, stamped ``archived_at`` (insert-only history)."""
    keys = _cols(keys)
    d = delta.select(*keys, F.col(version_col).alias("_new_version")).dropDuplicates(keys)
    j = target.join(d, keys).where(~F.col(version_col).eqNullSafe(F.col("_new_version")))
    return j.drop("_new_version").withColumn("archived_at", F.lit(ts).cast("timestamp_ntz"))


def soft_delete_missing(target: DataFrame, present: DataFrame, keys, ts, col: str = "excluded_at") -> DataFrame:
    """CDC-3: keys absent from ``present`` get ``excluded_at = ts`` unless already excluded; ``is_active`` derived."""
    keys = _cols(keys)
    p = present.select(*keys).distinct().withColumn("_present", F.lit(True))
    j = target.join(p, keys, "left")
    stamp = F.when(F.col("_present").isNull() & F.col(col).isNull(), F.lit(ts).cast("timestamp_ntz")).otherwise(F.col(col))
    out = j.withColumn(col, stamp).drop("_present")
    return out.withColumn("is_active", F.col(col).isNull()).select(*target.columns, *(["is_active"] if "is_active" not in target.columns else []))


def preserve_columns(delta: DataFrame, target: DataFrame, keys, cols) -> DataFrame:
    """CDC-4: keep the target's value of ``cols`` (e.g. first_seen_at) for keys that already exist."""
    keys, cols = _cols(keys), _cols(cols)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols])
    j = delta.join(t, keys, "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"_t_{c}"), F.col(c)))
    return j.select(*delta.columns)


def replace_window(target: DataFrame, delta: DataFrame, col: str, since) -> DataFrame:
    """CDC-5: delete target rows with ``col >= since`` and append the delta (idempotent re-extract)."""
    keep = target.where((F.col(col) < F.lit(since)) | F.col(col).isNull())
    return keep.unionByName(delta.select(*target.columns))


def replace_period(target: DataFrame, df: DataFrame, period_col: str) -> DataFrame:
    """CDC-6: periods present in ``df`` are replaced wholesale, other periods kept."""
    periods = df.select(period_col).distinct()
    return target.join(periods, period_col, "left_anti").unionByName(df.select(*target.columns))


def mirror_catalog(target: DataFrame, snapshot: DataFrame, key: str, version_col: str, ts,
                   preserve=("first_seen_at",)) -> dict[str, DataFrame]:
    """CDC-7: preserve -> archive -> merge -> soft delete, in that order.

    Returns ``{"target": new target, "history": rows to append to the history}``.
    """
    snap = preserve_columns(snapshot, target, key, list(preserve)) if preserve else snapshot
    history = archive_changed(target, snap, key, version_col, ts)
    merged = upsert(target, snap.select(*target.columns), key)
    final = soft_delete_missing(merged, snapshot, key, ts)
    return {"target": final, "history": history}


def build_catalog(files: DataFrame, extensions: Sequence[str], official_folders: DataFrame | None = None) -> DataFrame:
    """CDC-8: file catalogue — extension filter, name/extension split, size, SHA-256, curated official flag.

    ``files`` has ``file_path`` and ``content`` (text or binary); ``official_folders``
    has ``directory`` rows; anything unmatched is not official (fail-safe false).
    """
    name = F.substring_index("file_path", "/", -1)
    ext = F.lower(F.substring_index(name, ".", -1))
    df = files.select(
        "file_path",
        F.regexp_replace("file_path", "/[^/]*$", "").alias("directory"),
        name.alias("file_name"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("name"),
        ext.alias("extension"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.sha2(F.col("content").cast("binary"), 256).alias("content_hash"),
    ).where(F.col("extension").isin(*[e.lower() for e in extensions]))
    if official_folders is None:
        return df.withColumn("is_official", F.lit(False))
    off = official_folders.select("directory").distinct().withColumn("_off", F.lit(True))
    return df.join(off, "directory", "left").withColumn(
        "is_official", F.coalesce("_off", F.lit(False))).drop("_off")


def sync_portfolio(new: DataFrame, current: DataFrame, key=("partner_code", "rfv_familia")) -> DataFrame:
    """CDC-9: the new list is active (first row per key wins); keys only in the current list are kept inactive."""
    key = list(key)
    n = one_per_key(new, key, ["_pos"], latest=False).drop("_pos") if "_pos" in new.columns else new.dropDuplicates(key)
    n = n.withColumn("is_active", F.lit(True))
    old = current.join(n.select(*key), key, "left_anti").withColumn("is_active", F.lit(False))
    return n.unionByName(old.select(*n.columns))


def assign_first(clients: DataFrame, assignments: DataFrame, key: str, value: str, priority: str,
                 default: str) -> DataFrame:
    """CDC-10: first-wins assignment (lowest priority) per key; default label when unassigned."""
    best = one_per_key(assignments.select(key, priority, value), key, [priority, value], latest=False)
    j = clients.join(best.select(key, F.col(value).alias("_assigned")), key, "left")
    return j.withColumn(value, F.coalesce("_assigned", F.lit(default))).drop("_assigned")


def redirect_owner(df: DataFrame, owner_col: str, from_owner: str, by_id: DataFrame | None, key: str,
                   default: str | None) -> DataFrame:
    """CDC-11: rows owned by ``from_owner`` move to the owner mapped for their id, else ``default``, else unchanged."""
    moved = F.col(owner_col) == F.lit(from_owner)
    if by_id is not None:
        df = df.join(by_id.select(key, F.col("new_owner").alias("_to")), key, "left")
    else:
        df = df.withColumn("_to", F.lit(None).cast("string"))
    target = F.coalesce(F.col("_to"), F.lit(default), F.col(owner_col))
    return df.withColumn("redirected", moved & (target != F.col(owner_col))).withColumn(
        owner_col, F.when(moved, target).otherwise(F.col(owner_col))).drop("_to")


def compare_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """SET-4: counts of keys only in a, only in b, and in both (one full outer join)."""
    x = a.select(key).distinct().withColumn("_a", F.lit(1))
    y = b.select(key).distinct().withColumn("_b", F.lit(1))
    j = x.join(y, key, "full_outer")
    return j.agg(C.count_if(F.col("_b").isNull()).alias("only_a"), C.count_if(F.col("_a").isNull()).alias("only_b"),
                 C.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"))
