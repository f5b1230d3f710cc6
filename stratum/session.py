"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every stratum job wants, whatever the cluster size.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "stratum",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with stratum's defaults.

    On a cluster leave ``master`` unset (the launcher supplies it) and size
    ``shuffle_partitions`` for the largest stage; AQE coalesces small ones.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did (a cluster ships it with --py-files)."""
    root = str(Path(__file__).resolve().parents[1])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, change logs and scratch tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it).  Only when it is
    unset on a local master -- tests -- a fresh folder under the system temp dir
    is made and recorded in the session so that later calls agree; on a cluster
    an unset value is an error, never a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="stratum-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared root for one run."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now; else they stay until its driver next collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage where one intermediate feeds several aggregate-and-join-back
    branches (each branch would otherwise recompute it), and survives executor
    loss because the files live in shared storage, unlike a local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"materialized-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file through the Hadoop file system: any storage that Spark reads."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Counterpart of :func:`read_text`; replaces the file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
