"""Session helpers: builder defaults for tests/bench and the checkpoint folder rule.

On a cluster the session is created by the platform; these helpers only fill in
settings that are unset, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library relies on (AQE for runtime re-planning and
# skew splitting, UTC for reproducible dates, Arrow for the few pandas steps).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# scratch folders of local sessions, by application
_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakeops") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("LAKEOPS_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's value is used as is.  Only a local session (tests) may do without: it gets a scratch
    folder, once per application.  On a cluster a missing setting is an error, as a folder of the
    driver's machine would be lost to the executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(sc.applicationId)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        d = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="lakeops-ckpt-")
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never localCheckpoint).

    What was shuffled for it goes from the disk once it is written: nothing reads it again.  Spark takes the setting when a
    DataFrame is made, so a new one is made under it; ``df`` keeps its own plan and may be run again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_SHUFFLES, None)
    conf.set(CLEAN_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            conf.unset(CLEAN_SHUFFLES)
        else:
            conf.set(CLEAN_SHUFFLES, before)
