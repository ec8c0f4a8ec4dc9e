"""Spark session helpers.

On a cluster the session comes from the platform.  ``get_session`` sets a
default only where the loaded configuration (spark-submit, spark-defaults)
has no value, so cluster-level choices always win; time zone and driver
memory are the platform's business and are set for local sessions only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on.  AQE re-plans joins from real shuffle sizes and
# splits skewed join partitions; ANSI mode makes bad casts fail loudly as the
# source warehouse does.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Groupings that reuse a join's partitioning would keep a hot key's join
    # whole; forced, it is split and only then costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Call-site capture for error messages costs a Python stack walk per
    # Column call; plans of wide reports make thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Only for sessions this module starts on a local master (tests, benches).
_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": os.environ.get("STORELIFT_DRIVER_MEMORY", "8g"),
}


def _is_local(master: str | None) -> bool:
    """One JVM on one machine (``local-cluster`` is several processes)."""
    return bool(re.match(r"local(\[|$)", master or ""))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "storelift") -> SparkSession:
    """Return the active session or start one, keeping every configured value."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    SparkContext._ensure_initialized()  # starts the JVM, which has read the submitted settings
    loaded = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = dict(_DEFAULTS)
    if _is_local(master or loaded.get("spark.master", None)):
        defaults |= _LOCAL_DEFAULTS
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in defaults.items():
        if not loaded.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables.

    ``spark.checkpoint.dir`` names it on a cluster (shared storage).  It is
    set once per session: later calls return the same folder.  A temporary
    folder is taken only when the setting is absent and Spark is one local
    JVM, as in tests; on several machines that is an error, because other
    executors could not read what one of them wrote there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured:
            if not _is_local(sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
            configured = tempfile.mkdtemp(prefix="storelift-ckpt-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage in a columnar, prunable form that survives lost
    executors.  ``drop_stored`` removes the session's tables.
    """
    path = f"{shared_dir(df.sparkSession)}/stored/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system Spark itself uses."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def drop_stored(spark: SparkSession) -> None:
    """Remove every table ``stored`` wrote in this session."""
    drop_path(spark, f"{shared_dir(spark)}/stored")
