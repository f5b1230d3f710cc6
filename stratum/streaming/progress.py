"""Progress events of the layers' flows as a table.

Each trigger of a named flow leaves one row: layer, flow, batch, rows, rows a second, events that cannot be
placed, how long the trigger took, and what its rules counted.  A listener writes them, one small
file a trigger under ``<path>/layer=<layer>``, so the driver holds none of them and any number of runs
is read back together.  A trigger that fails and runs again may be reported twice;
:func:`read_progress` keeps one report of a batch.

Late events cannot be told from a trigger's own rows: :func:`late_rows` counts them from the change log.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from collections import defaultdict
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from stratum.operators.quality import INVALID, OBSERVATION, ROWS
from stratum.session import write_text
from stratum.streaming.flows import BATCH, CdcSpec

SCHEMA = ("flow string, query_id string, run_id string, batch_id long, at timestamp, input_rows long, rows_per_second double, "
          "trigger_ms long, write_ms long, invalid_rows long, rules map<string, struct<passed: long, failed: long>>, layer string")


class ProgressTable(StreamingQueryListener):
    """Writes the progress of the flows named in ``layers`` (flow to layer) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, layers: Mapping[str, str]):
        self.spark, self.path, self.layers = spark, path, dict(layers)
        self.running: dict[str, threading.Event] = defaultdict(threading.Event)     # of this session's runs, by run id

    def onQueryStarted(self, event) -> None:
        if event.name in self.layers:
            self.running[str(event.runId)].clear()

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        layer = self.layers.get(report.get("name"))
        if layer is not None:
            write_text(self.spark, os.path.join(self.path, f"layer={layer}", f"{uuid.uuid4().hex}.json"), json.dumps(row_of(report)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if (run := str(event.runId)) in self.running:
            self.running[run].set()

    def settle(self, timeout_s: float = 60.0) -> None:
        """Waits until the reports of ended runs are written: Spark sends them in order, the end last."""
        for ended in list(self.running.values()):
            ended.wait(timeout_s)


@contextmanager
def recorded(spark: SparkSession, path: str, layers: Mapping[str, str]) -> Iterator[ProgressTable]:
    """Flows that run in this block and are named in ``layers`` leave their progress under ``path``."""
    table = ProgressTable(spark, path, layers)
    spark.streams.addListener(table)
    try:
        yield table
        table.settle()
    finally:
        spark.streams.removeListener(table)


def row_of(report: dict) -> dict:
    """One progress report, as Spark gives it, as a row of the table (without the layer)."""
    seen = next((m for name, m in (report.get("observedMetrics") or {}).items() if name.endswith(OBSERVATION)), {})
    rows = seen.get(ROWS)
    rules = {k: {"passed": rows - v, "failed": v} for k, v in seen.items() if k not in (ROWS, INVALID)}
    took = report.get("durationMs") or {}
    return {"flow": report.get("name"), "query_id": report["id"], "run_id": report["runId"], "batch_id": report["batchId"],
            "at": report["timestamp"], "input_rows": report.get("numInputRows") if rows is None else rows,
            "rows_per_second": report.get("processedRowsPerSecond"), "trigger_ms": took.get("triggerExecution"),
            "write_ms": took.get("addBatch"), "invalid_rows": seen.get(INVALID), "rules": rules}


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per flow and batch: its latest report with rows (a run without new rows repeats the last batch's number)."""
    reports = spark.read.schema(SCHEMA).json(path)
    last = Window.partitionBy("layer", "flow", "query_id", "batch_id").orderBy(
        (F.col("input_rows") > 0).desc_nulls_last(), F.col("at").desc(), F.col("run_id"))
    return reports.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")


def late_rows(spark: SparkSession, spec: CdcSpec) -> DataFrame:
    """``batch_id, late_rows``: events of each batch below the greatest sequence of their key in earlier batches."""
    keys = list(spec.keys)
    log = spark.read.parquet(spec.changelog_path).select(*keys, F.col(spec.sequence).alias("__s"), F.col(BATCH).alias("batch_id"))
    tops = log.groupBy(*keys, "batch_id").agg(F.max("__s").alias("__top"))
    earlier = Window.partitionBy(*keys).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = tops.select(*keys, "batch_id", F.max("__top").over(earlier).alias("__seen"))
    return (log.join(seen, [*keys, "batch_id"], "left").groupBy("batch_id")
            .agg(F.count_if(F.col("__s") < F.col("__seen")).alias("late_rows")))
