"""Zone-pinned sessions (C3) and the shared scratch / checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tripgate.config import DEFAULT_TIME_ZONE

_CHECKPOINT_KEY = "spark.checkpoint.dir"


# Session settings of the pipeline's child session. Broadcasts are decided only by AQE
# from *measured* shuffle sizes; the planner's size *estimates* never trigger one (an
# aggregate with one row per trip id can be estimated far too small). Folders of a batch, one a page, are
# listed by some tasks with many folders each; Spark's default is a task for each folder.
PIPELINE_CONF = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}
DEFAULT_ADAPTIVE_BROADCAST = "10MB"


def zoned_session(spark: SparkSession, time_zone: str = DEFAULT_TIME_ZONE) -> SparkSession:
    """A child session pinned to ``time_zone`` with the pipeline's planner settings.

    Timestamp parsing, ``to_date`` and ``to_json`` depend on the session zone; the child
    session pins it without touching the caller's configuration. Shuffle partition
    counts are left to AQE (coalescing + skew-join handling), never fixed here. A session
    that is already such a child is returned as is.
    """
    if spark.conf.get("spark.sql.session.timeZone") == time_zone and all(
            spark.conf.get(k, None) == v for k, v in PIPELINE_CONF.items()):
        return spark
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    child = spark.newSession()
    child.conf.set("spark.sql.session.timeZone", time_zone)
    for key, value in PIPELINE_CONF.items():
        child.conf.set(key, value)
    child.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive or DEFAULT_ADAPTIVE_BROADCAST)
    return child


def footer_session(spark: SparkSession, time_zone: str = DEFAULT_TIME_ZONE) -> SparkSession:
    """A zone-pinned child session whose Parquet reads answer min, max and count from file footers.

    Spark pushes aggregates down for version 2 sources only, so Parquet is read as one here.
    """
    child = zoned_session(spark, time_zone).newSession()
    for key, value in {**PIPELINE_CONF, "spark.sql.session.timeZone": time_zone, "spark.sql.parquet.aggregatePushdown": "true"}.items():
        child.conf.set(key, value)
    known = "spark.sql.sources.useV1SourceList"
    child.conf.set(known, ",".join(name for name in spark.conf.get(known).split(",") if name.strip() != "parquet"))
    return child


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the running session; only when nothing is configured and the master is
    local (tests) a private folder is created; on a cluster that is an error. The folder
    is registered and registered, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(_CHECKPOINT_KEY, None) or spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tripgate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Scratch folders of each application, for ``drop_scratch``.
_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint location."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tripgate-{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this application; how many. Frames that read them are gone with them."""
    jvm, removed = spark.sparkContext._jvm, 0
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        removed += folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return removed


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()``, but computes the plan a single time (an eager
    checkpoint of an unpersisted plan runs it twice: once to count, once to write) and
    survives executor loss, since the files live on the shared file system.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
