"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratum.session import scratch_dir

# Fixed value of the contract: the white space that separates words.
WORD_SPACE = " \t\n\x0b\f\r"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did (a cluster ships it with --py-files)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once, where the session still has Spark's default of 10,000 rows of any size."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32(id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


class Scratch:
    """Written intermediate tables of one operator call, in the shared folder.

    ``keep`` writes a frame as Parquet and reads it back: lineage ends there, and the
    files outlive any executor.  ``drop`` removes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark, self.root, self.n = spark, scratch_dir(spark, name), 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def keep(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def release(self) -> None:
        """Let Spark remove the shuffle files of finished steps now; else they stay until its next collections of garbage.

        The first collection frees the plans, the second one what they held.
        """
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def split_by_size(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to at most ``limit`` (one larger item stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
