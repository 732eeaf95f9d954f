"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins at run time
# (broadcast only when the materialised side is measured small, skew
# splitting) and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable checkpoint files once their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "revlens", extra: dict | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF``.  Master, memory and partition counts
    are the cluster's business (``spark-submit`` options); they are set here
    only when a caller (tests, bench) names them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured checkpoint folder.  Where none is set, a single-JVM
    session (``local[n]``: driver and executors are one process) gets a
    temporary one; a cluster session is an error, because a folder of the
    driver's machine is not visible to the executors."""
    sc = spark.sparkContext
    d = checkpoint_dir(spark)
    if d is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        d = tempfile.mkdtemp(prefix="revlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate
    tables (sink/scan round trips, saved models); removed when the driver's
    JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/revlens-{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint
    folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """Cut lineage with a Parquet table in the shared checkpoint folder: compressed, and its readers take only the
    columns they need, where a checkpoint holds whole rows as they are in memory."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
