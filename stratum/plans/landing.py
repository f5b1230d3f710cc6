"""Month-by-month release of source partitions from a vault into the incoming area.

Layout: ``<root>/<schema>/<table>/extraction_month=YYYY-MM/<files>``.

* :func:`inventory`        (schema, table, month, path, bytes) from a ``binaryFile``
                           listing that selects only ``path``/``length`` (no content
                           read); Spark's listing also skips ``_``/``.`` names
* :func:`last_processed`   MAX month in the tracker, whatever its status (or only
                           successful months with ``only_success=True``)
* :func:`next_month`       first month after the last processed one, any table
* :func:`months_to_process` explicit month (wins, no already-done check), or all
                           unprocessed months up to a ceiling (string order), or
                           the next month
* :func:`release`          copies the files of the chosen months, byte for byte and
                           under their names, one file per row of a distributed copy;
                           a manifest holds the size and modification time of every
                           delivered file; files that are unchanged since and still
                           lie there are not copied again, so late files arrive,
                           corrected ones replace what they correct, and nothing
                           arrives twice.  A file that cannot be copied is recorded and
                           the others go on.  Every attempt at a month appends a
                           tracker row; the last one is the month's state
* :func:`dry_run_listing`, :func:`tracker_history`, :func:`tracker_overview`,
  :func:`tracker_attempts`, :func:`superseded`, :func:`reset_month`, :func:`restart`
"""

from __future__ import annotations

import datetime as _dt
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import materialize, workers_import

MONTH = "extraction_month"

# Tracker table schema.
TRACKER_SCHEMA = T.StructType([
    T.StructField("simulation_month", T.StringType(), False),
    T.StructField("total_tables_found", T.IntegerType(), False),
    T.StructField("tables_with_files", T.IntegerType(), False),
    T.StructField("tables_skipped", T.IntegerType(), False),
    T.StructField("total_files_transferred", T.IntegerType(), False),
    T.StructField("total_bytes_transferred", T.LongType(), False),
    T.StructField("last_updated", T.TimestampType(), False),
    T.StructField("status", T.StringType(), False),
])
# beside the tracker's own columns: which attempt at its month a row is, and the run that wrote it
ATTEMPT = [T.StructField("attempt", T.IntegerType()), T.StructField("run", T.StringType())]
DELIVERED = "schema_name string, table_name string, name string, bytes bigint, modified timestamp, released bigint, month string"
ERRORS = "schema_name string, table_name string, name string, error string, run string, month string"


@dataclass(frozen=True)
class LandingConfig:
    vault: str                 # source root
    incoming: str              # target root
    tracker: str               # tracker table location
    formats: dict | None = None  # (schema, table) -> format, for readers; copies do not need it

    @property
    def errors(self) -> str:
        """Table of the files that could not be copied, one partition per month."""
        return _strip(self.tracker) + "_errors"

    @property
    def manifest(self) -> str:
        """Table of the delivered files, one partition per month; a file has a row for each version."""
        return _strip(self.tracker) + "_files"


def _strip(p: str) -> str:
    return p.rstrip("/")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per file: schema_name, table_name, month, path, bytes, modified."""
    listing = T.StructType([
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ])
    base = re.escape(_strip(root).lstrip("/"))
    rel = rf"^(?:file:)?/*{base}/([^/]+)/([^/]+)/{MONTH}=(\d{{4}}-\d{{2}})/[^/]+$"
    files = (spark.read.format("binaryFile").schema(listing)
             .option("recursiveFileLookup", "true").load(root)
             .select("path", "length", "modificationTime"))
    return (files.select(
        F.regexp_extract("path", rel, 1).alias("schema_name"),
        F.regexp_extract("path", rel, 2).alias("table_name"),
        F.regexp_extract("path", rel, 3).alias("month"),
        F.col("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
        .where(F.col("month") != ""))


def tables(inv: DataFrame) -> DataFrame:
    return inv.select("schema_name", "table_name").distinct()


def months(inv: DataFrame) -> DataFrame:
    return inv.select("month").distinct()


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a table, none before its first write.  A table that cannot be read is an error."""
    if not _fs_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def tracker_attempts(spark: SparkSession, cfg: LandingConfig) -> DataFrame:
    """All tracker rows, with the number (from 1) of the attempt at the month and its run."""
    return _read(spark, cfg.tracker, T.StructType(TRACKER_SCHEMA.fields + ATTEMPT)).select(
        *[f.name for f in TRACKER_SCHEMA.fields], F.coalesce("attempt", F.lit(0)).alias("attempt"), "run")


def _last_attempts(spark: SparkSession, cfg: LandingConfig) -> DataFrame:
    attempts = tracker_attempts(spark, cfg)
    order = ["attempt", "last_updated"]
    row = F.struct(*order, *[c for c in attempts.columns if c not in order])
    return attempts.groupBy("simulation_month").agg(F.max(row).alias("last")).select([f"last.{c}" for c in attempts.columns])


def read_tracker(spark: SparkSession, cfg: LandingConfig) -> DataFrame:
    """The row of the last attempt at each month; none before the first release."""
    return _last_attempts(spark, cfg).select(*[f.name for f in TRACKER_SCHEMA.fields])


def read_errors(spark: SparkSession, cfg: LandingConfig) -> DataFrame:
    """schema_name, table_name, name, error, month of the files that the last release of their month could not copy."""
    last = _last_attempts(spark, cfg).select(F.col("simulation_month").alias("month"), "run")
    return (_read(spark, cfg.errors, ERRORS).join(last, ["month", "run"], "left_semi")
            .select("schema_name", "table_name", "name", "error", "month"))


FILE = ["schema_name", "table_name", "month", "name"]


def delivered(spark: SparkSession, cfg: LandingConfig, month_list: list[str] | None = None) -> DataFrame:
    """The version (bytes, modified) of each file that was delivered last."""
    files = _read(spark, cfg.manifest, DELIVERED)
    if month_list is not None:
        files = files.where(F.col("month").isin(month_list))
    return files.groupBy(*FILE).agg(F.max(F.struct("released", "bytes", "modified")).alias("last")).select(
        *FILE, "last.bytes", "last.modified")


def superseded(spark: SparkSession, cfg: LandingConfig) -> DataFrame:
    """schema_name, table_name, month, name, bytes, modified, path: delivered versions that a corrected file has replaced.

    Rows that were read from ``path`` before the correction no longer stand in the incoming area.
    """
    files = _read(spark, cfg.manifest, DELIVERED)
    version = F.struct("bytes", "modified")
    later = F.lead(version).over(Window.partitionBy(*FILE).orderBy("released"))
    path = F.concat_ws("/", F.lit(_strip(cfg.incoming)), "schema_name", "table_name", F.concat(F.lit(f"{MONTH}="), "month"), "name")
    return (files.withColumn("later", later).where(F.col("later") != version)
            .select(*FILE, "bytes", "modified", path.alias("path")))


def last_processed(spark: SparkSession, cfg: LandingConfig, only_success: bool = False) -> str | None:
    t = read_tracker(spark, cfg)
    if only_success:
        t = t.where(F.col("status") == "success")
    return t.agg(F.max("simulation_month")).first()[0]


def next_month(inv: DataFrame, last: str | None) -> str | None:
    m = months(inv)
    if last is not None:
        m = m.where(F.col("month") > last)
    return m.agg(F.min("month")).first()[0]


def months_to_process(spark: SparkSession, cfg: LandingConfig, inv: DataFrame,
                      specific: str | None = None, up_to: str | None = None,
                      only_success: bool = False) -> list[str]:
    if specific:
        return [specific]
    last = last_processed(spark, cfg, only_success)
    if up_to:
        m = months(inv).where(F.col("month") <= up_to)
        if last is not None:
            m = m.where(F.col("month") > last)
        # the month list is bounded by the calendar, not by the data volume
        return [r[0] for r in m.orderBy("month").collect()]
    nxt = next_month(inv, last)
    return [nxt] if nxt else []


def _uri(path: str) -> str:
    """A Hadoop path as a worker's file system library writes it."""
    return re.sub(r"^file:/+", "file:///", re.sub("^s3a:", "s3:", path))


def _copy_file(source: str, folder: str, name: str) -> None:
    """Byte copy under a hidden name, then a rename: readers never see part of a file."""
    fs, src = pyarrow.fs.FileSystem.from_uri(_uri(source))
    to, dst = pyarrow.fs.FileSystem.from_uri(_uri(folder))
    to.create_dir(dst, recursive=True)
    part = f"{dst}/._{uuid.uuid4().hex}"
    with fs.open_input_stream(src, compression=None) as i, to.open_output_stream(part, compression=None) as o:
        while data := i.read(8 << 20):
            o.write(data)
    to.move(part, f"{dst}/{name}")


def _copy(files: DataFrame, incoming: str) -> DataFrame:
    """schema_name, table_name, month, name, bytes, modified, error (null: copied) of each file."""
    root = _strip(incoming)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            errors = []
            for r in b.to_pylist():
                try:
                    _copy_file(r["path"], f"{root}/{r['schema_name']}/{r['table_name']}/{MONTH}={r['month']}", r["name"])
                    errors.append(None)
                except (OSError, pa.ArrowException) as e:    # this file only; recorded in the error table
                    errors.append(f"{type(e).__name__}: {e}")
            names = [n for n in b.schema.names if n != "path"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(errors, pa.string())], names=[*names, "error"])

    workers_import(files.sparkSession)
    return files.select("path", "schema_name", "table_name", "month", "name", "bytes", "modified").mapInArrow(
        run, "schema_name string, table_name string, month string, name string, bytes bigint, modified timestamp, error string")


def _named(inv: DataFrame) -> DataFrame:
    return inv.withColumn("name", F.element_at(F.split("path", "/"), -1))


def release(spark: SparkSession, cfg: LandingConfig, month_list: list[str],
            inv: DataFrame | None = None, now: _dt.datetime | None = None) -> DataFrame:
    """Release ``month_list`` for every table that has files; returns the tracker rows.

    The tracker counts the vault's files of the month that lie in the incoming area after
    the run.  A month is ``success`` if all of them do, ``failed`` if none, else ``partial``.

    Files are written first, then their manifest, the errors and last the tracker.  A run
    that is lost in between leaves files without a record, which the next run copies again.
    """
    run, released = uuid.uuid4().hex, time.time_ns()
    inv = inventory(spark, cfg.vault) if inv is None else inv
    chosen = materialize(_named(inv.where(F.col("month").isin(month_list))), "landing-files")
    version = [*FILE, "bytes", "modified"]
    todo = chosen
    if _fs_exists(spark, cfg.incoming):
        there = _named(inventory(spark, cfg.incoming).where(F.col("month").isin(month_list))).select(*FILE, "bytes")
        same = delivered(spark, cfg, month_list).join(there, [*FILE, "bytes"], "left_semi")
        todo = chosen.join(same, version, "left_anti")
    # each file once, dealt out evenly; the result is written, so no file is copied again when rows are read twice
    parts = spark.sparkContext.defaultParallelism * 2
    done = materialize(_copy(todo.repartition(parts, "path"), cfg.incoming), "landing-copied")
    failed = done.where(F.col("error").isNotNull())
    state = chosen.join(failed.select(*FILE, F.lit(True).alias("bad")), FILE, "left").withColumn("ok", F.col("bad").isNull())
    n_tables = tables(inv).count()
    per_table = (state.groupBy("month", "schema_name", "table_name")
                 .agg(F.count_if("ok").alias("files"), F.sum(F.when(F.col("ok"), F.col("bytes")).otherwise(0)).alias("bytes"),
                      F.count_if(~F.col("ok")).alias("errors")))
    stamp = F.lit(now) if now is not None else F.current_timestamp()
    rows = (spark.createDataFrame([(m,) for m in month_list], "simulation_month string")
            .join(per_table.withColumnRenamed("month", "simulation_month"), "simulation_month", "left")
            .groupBy("simulation_month").agg(
                F.count("table_name").alias("with_files"), F.sum("files").alias("files"),
                F.sum("bytes").alias("bytes"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"))
            .select(
                "simulation_month",
                F.lit(n_tables).cast("int").alias("total_tables_found"),
                F.col("with_files").cast("int").alias("tables_with_files"),
                (F.lit(n_tables) - F.col("with_files")).cast("int").alias("tables_skipped"),
                F.coalesce("files", F.lit(0)).cast("int").alias("total_files_transferred"),
                F.coalesce("bytes", F.lit(0)).cast("long").alias("total_bytes_transferred"),
                stamp.cast("timestamp").alias("last_updated"),
                F.when(F.col("errors") > 0, F.when(F.col("files") > 0, "partial").otherwise("failed"))
                .otherwise("success").alias("status")))
    before = tracker_attempts(spark, cfg).groupBy("simulation_month").agg(F.max("attempt").alias("before"))
    rows = materialize(rows.join(before, "simulation_month", "left").withColumn("attempt", F.coalesce("before", F.lit(0)) + 1)
                       .drop("before").withColumn("run", F.lit(run)), "landing-tracker")
    copied = done.where(F.col("error").isNull()).withColumn("released", F.lit(released))
    _append(copied.select("schema_name", "table_name", "name", "bytes", "modified", "released", "month"), cfg.manifest, "month")
    _append(failed.select("schema_name", "table_name", "name", "error", F.lit(run).alias("run"), "month"), cfg.errors, "month")
    _append(rows, cfg.tracker, "simulation_month")
    return read_tracker(spark, cfg).where(F.col("simulation_month").isin(month_list))


def _append(rows: DataFrame, path: str, month: str) -> None:
    """Add rows to a table with a partition per month; nothing that lies there is touched."""
    rows.repartition(month).write.mode("append").partitionBy(month).parquet(path)


def run(spark: SparkSession, cfg: LandingConfig, specific: str | None = None,
        up_to: str | None = None, only_success: bool = False) -> list[str]:
    """Choose months (M3/M4/M5) and release them; returns the released months."""
    inv = inventory(spark, cfg.vault)
    todo = months_to_process(spark, cfg, inv, specific, up_to, only_success)
    if todo:
        release(spark, cfg, todo, inv)
    return todo


def dry_run_listing(inv: DataFrame) -> DataFrame:
    """Months per table, first .. last."""
    return (inv.groupBy("schema_name", "table_name")
            .agg(F.count_distinct("month").alias("months"),
                 F.min("month").alias("first_month"), F.max("month").alias("last_month")))


def tracker_history(spark: SparkSession, cfg: LandingConfig, limit: int = 50) -> DataFrame:
    t = read_tracker(spark, cfg)
    return (t.select("simulation_month", "total_tables_found", "tables_with_files", "tables_skipped",
                     "total_files_transferred",
                     F.round(F.col("total_bytes_transferred") / 1024 / 1024, 2).alias("mb_transferred"),
                     "last_updated", "status")
            .orderBy(F.col("simulation_month").desc()).limit(limit))


def tracker_overview(spark: SparkSession, cfg: LandingConfig, every_attempt: bool = False) -> DataFrame:
    """Figures over the last attempt at each month, or over every attempt."""
    t = tracker_attempts(spark, cfg) if every_attempt else read_tracker(spark, cfg)
    return t.agg(
        F.count(F.lit(1)).alias("months_processed"),
        F.min("simulation_month").alias("first_month"),
        F.max("simulation_month").alias("latest_month"),
        F.sum("total_files_transferred").alias("total_files"),
        F.round(F.sum("total_bytes_transferred") / 1024 / 1024, 2).alias("total_mb"),
        F.avg("tables_with_files").alias("avg_tables_with_files"),
        F.avg("tables_skipped").alias("avg_tables_skipped"),
        F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).alias("successful_runs"),
        F.sum(F.when(F.col("status") == "partial", 1).otherwise(0)).alias("partial_runs"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed_runs"),
    )


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def _fs_delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def reset_month(spark: SparkSession, cfg: LandingConfig, month: str) -> None:
    """Forget one month in the tracker, with all attempts at it; what was delivered stays known."""
    _fs_delete(spark, f"{_strip(cfg.tracker)}/simulation_month={month}")


def restart(spark: SparkSession, cfg: LandingConfig) -> None:
    """Drop the tracker with its manifest and errors and clear the incoming area (only these configured paths)."""
    _fs_delete(spark, cfg.tracker)
    _fs_delete(spark, cfg.manifest)
    _fs_delete(spark, cfg.errors)
    _fs_delete(spark, cfg.incoming)
