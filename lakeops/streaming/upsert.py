"""INC-12: incremental upsert as a Structured Streaming job, and INC-4 as a batch cycle.

A file stream of delta extracts drives ``foreachBatch``:

1. dedup inside the micro-batch (latest row per key, partial aggregate);
2. merge it into the buckets of the target that its keys fall in, and commit a new version (``streaming/bucketed.py``);
   of a key the row with the highest order stays, so rows that come late do not overwrite newer ones;
3. stamp the watermark (max event time of the batch) after the write;
4. mark the batch as done, under the id of its stream and its epoch.

Only a marked batch is skipped when it comes again.  A batch that was cut off before its mark is merged once
more: an upsert of the same rows changes nothing, and the stamp is not lost.  Epochs start at 0 again with a new
checkpoint folder; the stream's id differs then, so no batch of another stream is taken for this one.
Versions are numbered on their own; the last few are kept.  The checkpoint lives in the shared folder named by
``spark.checkpoint.dir``.  ``trigger(availableNow=True)`` processes what has landed and stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import ensure_checkpoint_dir
from lakeops.streaming import bucketed


def list_versions(spark: SparkSession, root: str) -> list[str]:
    """Committed versions of the target (``v=...``), oldest first (metadata only)."""
    return bucketed.versions(spark, root)


def read_target(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return bucketed.read(spark, root, schema)


def _stamp(rows: DataFrame, watermark_col: str, control_path: str, entity: str, epoch: int) -> None:
    rows.agg(F.max(watermark_col).cast("timestamp_ntz").alias("watermark")).select(
        F.lit(entity).alias("entity"), F.lit(watermark_col).alias("column"), "watermark",
        F.lit(epoch).cast("bigint").alias("epoch"), F.current_timestamp().alias("run_time")).write.mode("append").parquet(control_path)


def upsert_batch(batch: DataFrame, epoch_id: int, *, root: str, keys: Sequence[str], order_by: Sequence[str],
                 schema: T.StructType, watermark_col: str | None = None, control_path: str | None = None,
                 entity: str = "entity", run_id: str | None = None, keep_versions: int = 3, newest: bool = True,
                 n_buckets: int = bucketed.N_BUCKETS) -> str | None:
    """The ``foreachBatch`` body (also callable directly for a batch run): the version written, None if the batch is done
    or empty.

    ``run_id`` and the epoch name the batch; inside a stream the id is that of the query, which its checkpoint keeps.
    Without ``newest`` the batch's row replaces the target's whatever their order.
    """
    spark = batch.sparkSession
    run = run_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or uuid.uuid4().hex
    fs, mark, _ = bucketed.filesystem(spark, f"{root.rstrip('/')}/_batches/{run}-{epoch_id}")
    if fs.exists(mark):
        return None
    version = bucketed.merge(batch, root, keys, order_by, schema, newest=newest, n_buckets=n_buckets)
    if version and watermark_col and control_path:
        _stamp(batch, watermark_col, control_path, entity, epoch_id)
    fs.mkdirs(mark)
    bucketed.drop_old(spark, root, keep_versions)
    return version


def stream_upsert(spark: SparkSession, source_path: str, schema: T.StructType, root: str, keys: Sequence[str],
                  order_by: Sequence[str], *, name: str = "upsert", watermark_col: str | None = None,
                  control_path: str | None = None, max_files_per_trigger: int | None = None, n_buckets: int = bucketed.N_BUCKETS):
    """Start the stream (``availableNow``) and return the ``StreamingQuery``."""
    ckpt_root = ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_path)

    def body(df, epoch_id):
        upsert_batch(df, epoch_id, root=root, keys=keys, order_by=order_by, schema=schema, watermark_col=watermark_col,
                     control_path=control_path, entity=name, n_buckets=n_buckets)

    return (src.writeStream.foreachBatch(body).option("checkpointLocation", f"{ckpt_root.rstrip('/')}/stream-{name}")
            .trigger(availableNow=True).queryName(name).start())


def read_control(spark: SparkSession, control_path: str, entity: str):
    """INC-1 on the control table: the last stamped watermark of an entity (None if never stamped)."""
    fs, p, _ = bucketed.filesystem(spark, control_path)
    if not fs.exists(p):
        return None
    row = spark.read.parquet(control_path).where(F.col("entity") == entity).agg(F.max("watermark").alias("w")).first()
    return row["w"] if row else None


def run_entity(spark: SparkSession, extract: DataFrame, *, root: str, keys: Sequence[str], order_by: Sequence[str],
               watermark_col: str, control_path: str, entity: str, incremental: bool = True,
               overlap_days: int = 1, exclusion_col: str | None = None, n_buckets: int = bucketed.N_BUCKETS) -> dict:
    """INC-4: one incremental cycle of an entity.

    lower bound = last watermark - overlap (none => backfill) -> delta -> upsert into a new
    version -> stamp the watermark after success.  A full reload writes the whole extract
    (an empty extract never replaces the table).
    """
    from lakeops.sources.readers import read_delta

    schema = extract.schema
    wm = read_control(spark, control_path, entity) if incremental else None
    if incremental and wm is not None:
        import datetime as dt

        since = wm - dt.timedelta(days=overlap_days)
        delta = read_delta(extract, watermark_col, since, exclusion_col)
        mode = "incremental"
    else:
        delta = extract
        mode = "full"
    if delta.isEmpty():
        return {"entity": entity, "status": "skipped", "mode": mode, "version": None}
    if mode == "full":
        version = bucketed.overwrite(delta, root, keys, order_by, n_buckets)
        _stamp(delta, watermark_col, control_path, entity, int(version.rsplit("=", 1)[1]))
    else:
        version = upsert_batch(delta, 0, root=root, keys=keys, order_by=order_by, schema=schema, watermark_col=watermark_col,
                               control_path=control_path, entity=entity, run_id=uuid.uuid4().hex, newest=False)
    return {"entity": entity, "status": "ok", "mode": mode, "version": version}
