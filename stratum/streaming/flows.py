"""Silver flows: the transform steps of each flow kind and their streaming runners.

Transform steps are plain ``DataFrame -> DataFrame`` functions, so the same code
serves batch rebuilds and micro-batches:

* :func:`prepare_full_row_scd2`   binary UUIDs -> dashed text, sequence from
                                  modified/created time, audit columns dropped
* :func:`prepare_partial_scd2`    epoch days -> dates, sequence from epoch micros
* :func:`prepare_scd1`            UUIDs -> hex, sequence from the CDC struct
* :func:`prepare_append`          UUIDs -> hex, audit columns dropped
* :func:`prepare_epoch_append`    epoch days / micros -> date / timestamp

Runners:

* :func:`run_append_flow`  map-only stream -> parquet sink (append), checkpointed,
  expectations observed per micro-batch
* :func:`run_cdc_flow`     change log + recompute of touched keys in ``foreachBatch``
  (design below), giving exactly the batch SCD result over all events so far.

CDC micro-batch (batch id ``b``):

1. tag events with ``_key_bucket = pmod(xxhash64(keys), N)`` and write them to the
   change log partitioned by ``(_key_bucket, _batch_id=b)`` with dynamic overwrite
   (a retried batch rewrites the same partitions);
2. write the batch's expectation counts, read from the log, to the metrics table
   partition ``_batch_id=b``;
3. re-run the batch operator over the full history of the keys in this batch
   (partition pruning reads only their buckets, a semi-join keeps only their
   events), keep the other keys' rows of those buckets, write the result as a
   staging copy with a completion record and move its partitions to the place of
   the silver table's (a retried batch goes on from the record, see
   :func:`cdc_batch_writer`).  Buckets go through this in groups of about
   ``spark.stratum.rebuildBytes`` of the log, one after the other, so that shuffles
   and staging take the disk of one group, not of the table.
Late events need no special case: they land in the log and their key is
recomputed.  No driver-side state; the bucket list collected per batch is at
most ``N`` integers.  Without a MERGE-capable table format the touched bucket
partitions are rewritten whole; ``N`` sets that granularity.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stratum.functions import (cdc_struct_sequence, epoch_day_to_date, epoch_us_to_timestamp,
                               hex_text, sequence_of, uuid_text)
from stratum.operators import cdc, quality
from stratum.operators.projection import drop_columns
from stratum.session import read_text, release_shuffles, write_text

SEQ = "_sequence_timestamp"
KEY_BUCKET = "_key_bucket"
PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"
BATCH = "_batch_id"
FEW_KEYS = 50_000           # of a batch
REBUILD = "spark.stratum.rebuildBytes"

# Default excluded columns per flow kind.
FULL_ROW_EXCLUDES = ("__START_AT", "__END_AT", "created_at", "modified_at", "created_by", "modified_by")
EVENT_LOG_EXCLUDES = ("_event_id", "_event_type", "_event_timestamp", "_event_worker_id",
                      "created_at", "modified_at", "created_by", "modified_by")
EPOCH_APPEND_EXCLUDES = ("_event_id", "_event_type", "_event_timestamp", "_event_worker_id",
                         "created_by")
APPEND_EXCLUDES = ("__START_AT", "__END_AT", "created_by")


def _excluded(df: DataFrame, cols: Sequence[str], default: tuple[str, ...]) -> list[str]:
    """The default list leaves out what a feed does not have; a list that was passed must be there."""
    return [c for c in cols if c in df.columns] if cols is default else list(cols)


# ---------------------------------------------------------------- transform steps

def prepare_full_row_scd2(df: DataFrame, uuid_columns: Sequence[str] = (),
                          modified_at: str = "modified_at", created_at: str = "created_at",
                          exclude: Sequence[str] = FULL_ROW_EXCLUDES,
                          null_uuid_as_null: bool = False) -> DataFrame:
    seq = sequence_of(modified_at, created_at, "timestamp")
    out = df.withColumns({c: uuid_text(c, null_on_null=null_uuid_as_null) for c in uuid_columns})
    out = out.withColumn(SEQ, seq)  # before the drop: it reads columns that are dropped
    return drop_columns(out, _excluded(out, exclude, FULL_ROW_EXCLUDES))


def prepare_partial_scd2(df: DataFrame, epoch_day_columns: Sequence[str] = (),
                         modified_at: str = "modified_at", created_at: str = "created_at",
                         exclude: Sequence[str] = EVENT_LOG_EXCLUDES) -> DataFrame:
    out = df.withColumns({c: epoch_day_to_date(c) for c in epoch_day_columns})
    out = out.withColumn(SEQ, sequence_of(modified_at, created_at, "epoch_us"))
    return drop_columns(out, _excluded(out, exclude, EVENT_LOG_EXCLUDES))


def prepare_scd1(df: DataFrame, uuid_columns: Sequence[str] = (),
                 cdc_struct: str = "__START_AT",
                 exclude: Sequence[str] = APPEND_EXCLUDES) -> DataFrame:
    out = df.withColumns({c: hex_text(c) for c in uuid_columns})
    out = out.withColumn(SEQ, cdc_struct_sequence(cdc_struct))
    return drop_columns(out, _excluded(out, exclude, APPEND_EXCLUDES))


def prepare_append(df: DataFrame, uuid_columns: Sequence[str] = (),
                   exclude: Sequence[str] = APPEND_EXCLUDES) -> DataFrame:
    out = df.withColumns({c: hex_text(c) for c in uuid_columns})
    return drop_columns(out, _excluded(out, exclude, APPEND_EXCLUDES))


def prepare_epoch_append(df: DataFrame, epoch_day_columns: Sequence[str] = (),
                         epoch_us_columns: Sequence[str] = (), created_at: str = "created_at",
                         exclude: Sequence[str] = EPOCH_APPEND_EXCLUDES) -> DataFrame:
    conv = {c: epoch_day_to_date(c) for c in epoch_day_columns}
    conv.update({c: epoch_us_to_timestamp(c) for c in epoch_us_columns})
    if created_at in df.columns:
        conv[created_at] = epoch_us_to_timestamp(created_at)
    out = df.withColumns(conv)
    return drop_columns(out, _excluded(out, exclude, EPOCH_APPEND_EXCLUDES))


def with_processing_time(df: DataFrame) -> DataFrame:
    """Re-stamp ``_processing_timestamp`` (constant within one micro-batch)."""
    return df.withColumn("_processing_timestamp", F.current_timestamp())


# ---------------------------------------------------------------- append flows

def _named(writer: DataStreamWriter, name: str) -> DataStreamWriter:
    """Flows with a name of their own show it in their progress reports."""
    return writer if name in ("flow", "table") else writer.queryName(name)


def run_append_flow(stream: DataFrame, target_path: str, checkpoint: str,
                    rules: list[quality.Rule] | None = None, name: str = "flow",
                    timeout_s: float | None = None,
                    metrics_path: str | None = None) -> StreamingQuery:
    """Map-only stream to an append parquet sink; expectations observed, never dropped.

    Per micro-batch failure counts arrive in the query progress; with
    ``metrics_path`` they are written to the metrics table (one row per batch
    and rule, partition ``batch_id`` replaced on a re-run).
    """
    out = stream
    obs = f"{name}{quality.OBSERVATION}"
    if rules:
        out = quality.observe_expectations(out, rules, obs)
    # counts come from the progress reports: keep those of every batch of the run, not the last 100
    spark = stream.sparkSession
    before = spark.conf.get(PROGRESS_KEPT, None)
    spark.conf.set(PROGRESS_KEPT, str(2**31 - 1))
    try:
        q = (_named(out.writeStream, name).format("parquet").outputMode("append").option("compression", "zstd")
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(target_path))
        q.awaitTermination(timeout_s)
    finally:
        spark.conf.unset(PROGRESS_KEPT) if before is None else spark.conf.set(PROGRESS_KEPT, before)
    if q.exception() is not None:
        raise q.exception()
    if rules and metrics_path:
        write_observed_metrics(stream.sparkSession, q, rules, obs, name, metrics_path)
    return q


def observed_metric_rows(q: StreamingQuery, rules: list[quality.Rule], obs: str, table: str):
    """``(table, batch_id, rule, passed, failed)`` from the query's progress reports.

    Bounded by (micro-batches of this run) x (rules); nothing row-level."""
    out = []
    for p in q.recentProgress:
        m = (p.observedMetrics or {}).get(obs)
        if m is None:
            continue
        total = int(m["rows"])
        for r in rules:
            failed = int(m[r.name])
            out.append((table, int(p.batchId), r.name, total - failed, failed))
    return out


def write_observed_metrics(spark: SparkSession, q: StreamingQuery, rules, obs, table, path) -> None:
    rows = observed_metric_rows(q, rules, obs, table)
    if not rows:
        return
    (spark.createDataFrame(rows, "table string, batch_id long, rule string, passed long, failed long")
     .withColumn("ts", F.current_timestamp())
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


# ---------------------------------------------------------------- CDC flows

@dataclass(frozen=True)
class CdcSpec:
    keys: tuple[str, ...]
    target_path: str
    changelog_path: str
    checkpoint: str
    scd_type: int = 2
    sequence: str = SEQ
    partial: bool = False
    except_cols: tuple[str, ...] = (SEQ,)
    key_buckets: int = 64
    files_per_bucket: int = 4             # of a batch's log and of the table
    seq_chunks: int = 1
    hot_rows: int | None = None
    rules: tuple[quality.Rule, ...] = field(default_factory=tuple)
    metrics_path: str | None = None
    rejected_path: str | None = None      # events with a NULL key or sequence, per batch
    table: str = "table"


def _bucket(keys: Sequence[str], n: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def _scd(spec: CdcSpec, events: DataFrame, clustered: bool) -> DataFrame:
    keys = list(spec.keys)
    if spec.scd_type == 1:
        return cdc.scd1(events, keys, spec.sequence, except_cols=spec.except_cols)
    return cdc.scd2(events, keys, spec.sequence, partial=spec.partial,
                    except_cols=spec.except_cols, chunks=spec.seq_chunks, hot_rows=spec.hot_rows, clustered=clustered)


def _by_bucket(df: DataFrame, spec: CdcSpec) -> DataFrame:
    """Rows of a bucket together, in at most ``files_per_bucket`` tasks and so files; a hot key is dealt out by its sequence.

    Files are in the order of the keys, which makes them smaller; a partitioned write sorts by the bucket anyway.
    """
    placed = [c for c in df.columns if c in (spec.sequence, cdc.START_AT, *spec.keys)]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in placed]), F.lit(spec.files_per_bucket))
    order = [*spec.keys, *[c for c in placed if c not in spec.keys]]
    return df.repartition(F.col(KEY_BUCKET), salt).sortWithinPartitions(KEY_BUCKET, *[c for c in (BATCH,) if c in df.columns], *order)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def _staging(spec: CdcSpec, batch_id: int) -> str:
    return f"{spec.target_path.rstrip('/')}_staging/batch={batch_id}"


def _staged_record(spec: CdcSpec, batch_id: int) -> str:
    """Exists while the batch's staging copy is complete and its swap may be under way."""
    return f"{_staging(spec, batch_id)}.complete"


def rebuild_keys(spark: SparkSession, spec: CdcSpec, buckets: list[int], touched_keys: DataFrame) -> DataFrame:
    """New content of the touched bucket partitions.

    The full history of the touched keys is read back from the change log
    (partition pruning on the buckets, then a join on the keys) and re-run
    through the SCD operator; rows of other keys in those buckets are kept as
    they are.
    """
    keys = list(spec.keys)
    log = (spark.read.parquet(spec.changelog_path).where(F.col(KEY_BUCKET).isin(buckets))
           .drop(BATCH, KEY_BUCKET))
    # few keys are sent to the log's tasks; many are joined by a shuffle, which the versions' order then shares
    many = touched_keys.count() > FEW_KEYS
    touched = touched_keys.hint("merge" if many else "broadcast")
    rebuilt = _scd(spec, log.join(touched, keys, "left_semi"), many) \
        .withColumn(KEY_BUCKET, _bucket(keys, spec.key_buckets))
    if _exists(spark, spec.target_path):
        old = (spark.read.parquet(spec.target_path).where(F.col(KEY_BUCKET).isin(buckets))
               .join(touched_keys, keys, "left_anti"))
        rebuilt = old.unionByName(rebuilt, allowMissingColumns=True)
    return rebuilt


def _stage(rebuilt: DataFrame, spec: CdcSpec, batch_id: int) -> None:
    """The new content of the touched buckets, laid out like the table."""
    _delete(rebuilt.sparkSession, _staging(spec, batch_id))     # what a lost attempt left
    (_by_bucket(rebuilt, spec).write.mode("overwrite").option("compression", "zstd")
     .partitionBy(KEY_BUCKET).parquet(_staging(spec, batch_id)))


def swap_buckets(spark: SparkSession, spec: CdcSpec, batch_id: int, buckets: list[int]) -> None:
    """Replace these bucket partitions of the table by those of the batch's complete staging copy.

    Folders are moved, no row is read.  One that is no longer in the copy has arrived before.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    staging, target = hadoop.Path(_staging(spec, batch_id)), hadoop.Path(spec.target_path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    complete = {f"{KEY_BUCKET}={b}" for b in buckets}
    for status in fs.listStatus(staging) if fs.exists(staging) else []:     # at most ``key_buckets``
        name = status.getPath().getName()
        if name not in complete:
            continue
        bucket = hadoop.Path(target, name)
        if fs.exists(bucket):
            fs.delete(bucket, True)
        if not fs.rename(status.getPath(), bucket):
            raise OSError(f"cannot move {status.getPath()} to {bucket}")


def bucket_groups(spark: SparkSession, spec: CdcSpec, buckets: list[int]) -> list[list[int]]:
    """The buckets in groups of about ``spark.stratum.rebuildBytes`` of the log, at least one bucket each."""
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(REBUILD, "64m"))
    out, total = [], 0
    for b in buckets:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{spec.changelog_path}/{KEY_BUCKET}={b}")
        size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
        if not out or total + size > limit:
            out.append([])
            total = 0
        out[-1].append(b)
        total += size
    return out


def _recorded(spark: SparkSession, spec: CdcSpec, batch_id: int, touched: list[int]) -> list[int]:
    """The batch's buckets that have replaced the table's, or lie complete in the staging copy."""
    record = _staged_record(spec, batch_id)
    if not _exists(spark, record):
        return []
    checkpoint, _, buckets = read_text(spark, record).partition("\n")
    if checkpoint != spec.checkpoint:
        return []
    return [int(b) for b in buckets.split(",")] if buckets else touched    # a record without a list is for all of them


def cdc_batch_writer(spark: SparkSession, spec: CdcSpec, at_step: Callable[[str], None] | None = None):
    """The ``foreachBatch`` function of a CDC flow (exposed for tests and replays).

    The table changes in two phases, for a group of buckets at a time.  The new
    buckets are written to a staging folder first; then a record says that they
    are complete; only then do they replace the table's.  A group that was lost
    before its record is rebuilt from buckets it has not touched; one that was
    lost after it, however far its swap had come, is swapped again from the same
    copy and never reads the table.  ``at_step`` is called before each step
    (tests interrupt there).

    The batch is read once, for the log; what follows reads its rows there, so no
    copy of it is held in memory or on disk.
    """
    def step(name: str) -> None:
        if at_step:
            at_step(name)

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = (batch.withColumn(KEY_BUCKET, _bucket(spec.keys, spec.key_buckets))
                  .withColumn(BATCH, F.lit(batch_id).cast("long")))
        try:
            step("log")
            (_by_bucket(tagged, spec).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", "zstd").partitionBy(KEY_BUCKET, BATCH).parquet(spec.changelog_path))
            release_shuffles(spark)
            logged = spark.read.schema(tagged.schema).parquet(spec.changelog_path).where(F.col(BATCH) == batch_id)
            touched = sorted(r[0] for r in logged.select(KEY_BUCKET).distinct().collect())
            if spec.rejected_path:
                (cdc.invalid_events(logged, list(spec.keys), spec.sequence).drop(KEY_BUCKET)
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(BATCH).parquet(spec.rejected_path))
            if spec.rules and spec.metrics_path:
                (quality.metrics_rows(logged, list(spec.rules), spec.table, batch_id)
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(spec.metrics_path))
            if touched:
                done = _recorded(spark, spec, batch_id, touched)
                if done:
                    step("swap")
                    swap_buckets(spark, spec, batch_id, done)
                for group in bucket_groups(spark, spec, [b for b in touched if b not in done]):
                    keys = (cdc.valid_events(logged.where(F.col(KEY_BUCKET).isin(group)), list(spec.keys), spec.sequence)
                            .select(*spec.keys).distinct())
                    step("stage")
                    _stage(rebuild_keys(spark, spec, group, keys), spec, batch_id)
                    step("record")
                    done = done + group
                    write_text(spark, _staged_record(spec, batch_id), spec.checkpoint + "\n" + ",".join(map(str, done)))
                    step("swap")
                    swap_buckets(spark, spec, batch_id, group)
                    release_shuffles(spark)
                step("forget")
                _delete(spark, _staged_record(spec, batch_id))
                step("clear")
                _delete(spark, _staging(spec, batch_id))
        finally:
            release_shuffles(spark)

    return write


def run_cdc_flow(spark: SparkSession, stream: DataFrame, spec: CdcSpec,
                 max_batches_timeout_s: float | None = None) -> StreamingQuery:
    invalid = F.col(spec.sequence).isNull()
    for k in spec.keys:
        invalid |= F.col(k).isNull()
    out = quality.observe_expectations(stream, list(spec.rules), f"{spec.table}{quality.OBSERVATION}", invalid)
    q = (_named(out.writeStream, spec.table).foreachBatch(cdc_batch_writer(spark, spec))
         .option("checkpointLocation", spec.checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(max_batches_timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return q


def read_scd(spark: SparkSession, target_path: str) -> DataFrame:
    """Batch read of a CDC-maintained table (re-read per run; see README)."""
    return spark.read.parquet(target_path).drop(KEY_BUCKET)
