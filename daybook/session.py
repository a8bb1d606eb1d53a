"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
exist for tests, the bench and the entry module.  Cluster deployments pass
their own session, and every operator reads what it needs from it.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every run wants: adaptive execution re-plans joins and coalesces
# partitions at runtime, the skew-join rule splits hot shuffle partitions, and
# a pinned time zone keeps date arithmetic identical on every executor.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


class CheckpointFolderMissing(RuntimeError):
    """The session names no folder that all executors share."""


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "daybook") -> SparkSession:
    """Session for tests and the bench: local mode, no UI."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster its operator sets that folder (a shared file system path); a
    session of several machines without it gets a ``CheckpointFolderMissing``,
    as a folder of one machine would be invisible to the others.  Only a local
    session (tests, bench), where there is one machine, takes a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise CheckpointFolderMissing("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder, for file round trips; the file
    system removes it when the session's JVM ends."""
    path = "/".join([ensure_checkpoint_dir(spark), *parts])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder.

    Used where one intermediate result feeds several later jobs (fit and
    score of a forecaster); a lost executor then re-reads the checkpoint
    instead of recomputing the whole plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()          # the eager checkpoint runs two jobs over
    out = cached.checkpoint(eager=True)  # the plan; the cache serves the 2nd
    cached.unpersist()
    return out
