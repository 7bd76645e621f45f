"""Sessions and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build(master: str | None = None, name: str = "veritrail", **more: str) -> SparkSession:
    """A session with the engine's settings; the cluster's own come first where master is None."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where it names none, a session on one machine gets a folder of its own; on a cluster that would lose data, so it raises."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def path_of(spark: SparkSession, path: str):
    """The path and its file system, as the JVM has them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the application's folder within the shared one. The folder goes when the application ends."""
    root, fs = path_of(spark, f"{shared_dir(spark)}/veritrail-{spark.sparkContext.applicationId}")
    if not fs.exists(root):
        fs.mkdirs(root)
        fs.deleteOnExit(root)
    return f"{root.toString()}/{tag}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a path that nothing reads any more."""
    p, fs = path_of(spark, path)
    fs.delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: what follows does not depend on executors that may be lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
