"""Incremental runs: high-water marks, watermark control, run log, freshness.

The run log and the watermark control table are ordinary DataFrames (append /
upsert).  Latest-per-key uses the partial ``max(struct)`` aggregate of
``cdc.one_per_key``; nothing is collected to the driver except the single
scalar a caller asks for (``max_watermark(...).first()``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.operators import cdc

LOCAL_OFFSET_HOURS = -3  # display timezone: fixed UTC-3


def _ts(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def max_watermark(df: DataFrame, col: str) -> DataFrame:
    """INC-1: one row ``watermark`` = MAX(col) as a timestamp (DATE -> midnight); NULL on an empty table."""
    return df.agg(_ts(F.max(col)).alias("watermark"))


def set_watermarks(control: DataFrame, marks: DataFrame) -> DataFrame:
    """INC-2: upsert (entity) rows of the control table with the marks of successful runs only."""
    ok = marks.where(F.col("status") == "ok").drop("status") if "status" in marks.columns else marks
    return cdc.upsert(control, ok.select(*control.columns), ["source", "entity"], "run_time")


def read_watermarks(runs: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """INC-5: per (source, entity) the max_event_at of the last OK run; else the seed value."""
    ok = runs.where((F.col("status") == "ok") & F.col("max_event_at").isNotNull())
    last = cdc.one_per_key(ok.select("source", "entity", "started_at", "max_event_at"), ["source", "entity"],
                           ["started_at"]).select("source", "entity", F.col("max_event_at").alias("watermark"))
    if seeds is None:
        return last.withColumn("origin", F.lit("run_log"))
    s = seeds.select("source", "entity", F.col("watermark").alias("_seed"))
    j = last.join(s, ["source", "entity"], "full_outer")
    return j.select("source", "entity", F.coalesce("watermark", "_seed").alias("watermark"),
                    F.when(F.col("watermark").isNotNull(), "run_log").otherwise("seed").alias("origin"))


def batch_max_event(df: DataFrame, col: str | None = None) -> DataFrame:
    """INC-6: max event time of a batch (declared watermark column, else ``record_event_at``)."""
    return df.agg(_ts(F.max(col or "record_event_at")).alias("max_event_at"))


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("entity", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("rows_extracted", T.LongType()), T.StructField("rows_loaded", T.LongType()),
    T.StructField("max_event_at", T.TimestampNTZType()), T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("mode", T.StringType()),
    T.StructField("error", T.StringType()),
])


def record_run(spark, run_id, source, entity, status, rows_extracted, rows_loaded, max_event_at, started_at, seconds,
               mode="incremental", error=None) -> DataFrame:
    """INC-7: one run-log row (error text capped at 1000 characters) to append to the log."""
    err = None if error is None else str(error)[:1000]
    return spark.createDataFrame([(run_id, source, entity, status, rows_extracted, rows_loaded, max_event_at, started_at,
                                   float(seconds), mode, err)], RUN_SCHEMA)


def run_summary(runs: DataFrame) -> DataFrame:
    """INC-8: totals by status."""
    return runs.groupBy("status").agg(F.count("*").alias("runs"), F.sum("rows_extracted").alias("rows_extracted"),
                                      F.sum("rows_loaded").alias("rows_loaded"), F.round(F.sum("seconds"), 3).alias("seconds"))


def slowest_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """INC-8: the ``n`` slowest runs (a top-n report)."""
    return runs.orderBy(F.col("seconds").desc(), F.col("run_id")).limit(n).select(
        "run_id", "source", "entity", "status", "seconds")


def freshness(runs: DataFrame) -> DataFrame:
    """INC-9 / WIN-5: the latest run per (source, entity)."""
    cols = ["source", "entity", "started_at", "status", "rows_loaded", "run_id"]
    return cdc.one_per_key(runs.select(*cols), ["source", "entity"], ["started_at", "run_id"])


def freshness_status(last: DataFrame, thresholds: DataFrame, now: str, ts_col: str = "last_ok_at") -> DataFrame:
    """INC-10: age in minutes and a traffic light: green <= threshold, amber <= 2x, else red; no reading if NULL."""
    j = last.join(F.broadcast(thresholds), "source", "left")
    age = F.expr(f"timestampdiff(MINUTE, {ts_col}, TIMESTAMP_NTZ '{now}')")
    thr = F.col("threshold_minutes")
    state = (F.when(F.col(ts_col).isNull(), F.lit(P.FRESH_NONE)).when(age <= thr, F.lit(P.FRESH_GREEN))
             .when(age <= thr * 2, F.lit(P.FRESH_AMBER)).otherwise(F.lit(P.FRESH_RED)))
    return j.withColumn("age_minutes", age).withColumn("state", state)


def last_ok(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "ok").groupBy("source").agg(F.max("started_at").alias("last_ok_at"))


def _local(c: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return c + F.make_dt_interval(F.lit(0), F.lit(offset_hours))


def runs_digest(runs: DataFrame, now: str, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """INC-11: per source: last load (local time), age in minutes, loads today (local calendar)."""
    local_today = _local(F.lit(now).cast("timestamp_ntz"), offset_hours).cast("date")
    loc = _local(F.col("started_at"), offset_hours)
    g = runs.groupBy("source").agg(F.max("started_at").alias("_last"),
                                   C.count_if(loc.cast("date") == local_today).alias("loads_today"),
                                   F.count("*").alias("loads_total"))
    return g.select("source", F.date_format(_local(F.col("_last"), offset_hours), "dd/MM/yyyy HH:mm").alias("last_load_local"),
                    F.expr(f"timestampdiff(MINUTE, _last, TIMESTAMP_NTZ '{now}')").alias("age_minutes"),
                    "loads_today", "loads_total")


def last_load(df: DataFrame, ts_col: str, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """INC-13: MAX(ts) rendered in local time."""
    return df.agg(F.date_format(_local(F.max(ts_col), offset_hours), "dd/MM/yyyy HH:mm").alias("last_load"))
