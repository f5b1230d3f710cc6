"""Incremental file ingest into bronze with schema evolution and lineage.

One triggered run (``availableNow``) picks up every file not seen by earlier runs:

* A file-list stream (``binaryFile`` with only ``path``/``length`` selected, so no
  content is read) tracks which files are new; its checkpoint gives each file
  exactly once across runs.
* ``foreachBatch`` reads just the batch's new files with the format's own schema
  inference (Parquet footers, JSON / CSV type inference), so inference cost is
  proportional to new data, not to the whole feed.
* CSV files are grouped by header line and Parquet files by schema (both read in
  tasks); each group is read on its own and aligned to the record before they are
  combined, in the order of their first file, as if each had come in its own run:
  the first file's type is the column's, and names that differ in case are one column.
* The result is aligned to the feed's *schema record* (kept beside the
  checkpoint): new columns are appended, a known column never changes type; a
  value that does not fit the recorded type becomes NULL and its text goes to
  ``_rescued`` (a JSON object column -> text).
* Lineage: ``_source_file_path``, ``_source_file_name``, ``_processing_timestamp``
  and the ``extraction_month`` folder value (string) when present.
* The batch is written to ``<target>/_batch_id=<id>`` with dynamic partition
  overwrite, so a retried batch replaces its own output and nothing else.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import workers_import

LINEAGE = ("_source_file_path", "_source_file_name", "_processing_timestamp")
RESCUED = "_rescued"
BATCH_COL = "_batch_id"
MONTH_COL = "extraction_month"
_MONTH_RE = r"extraction_month=([^/]+)"


@dataclass(frozen=True)
class FeedSpec:
    source_path: str
    target_path: str
    checkpoint: str
    fmt: str = "parquet"            # parquet | json | csv
    max_files_per_trigger: int = 1000
    header: bool = True             # csv


# ---------------------------------------------------------------- schema record

def _record_path(spec: FeedSpec) -> str:
    return spec.checkpoint.rstrip("/") + "/_schema_record.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def read_schema_record(spark: SparkSession, spec: FeedSpec) -> T.StructType | None:
    """The feed's schema record: a small JSON file beside the checkpoint, read
    through the Hadoop file system (any shared storage), no Spark job."""
    p, fs = _fs(spark, _record_path(spec))
    if not fs.exists(p):
        return None
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        text = "".join(iter(reader.readLine, None))
    finally:
        reader.close()
    return T.StructType.fromJson(json.loads(text)) if text else None


def _write_schema_record(spark: SparkSession, spec: FeedSpec, schema: T.StructType) -> None:
    p, fs = _fs(spark, _record_path(spec))
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(schema.jsonValue()).encode("utf-8")))
    finally:
        out.close()


def bronze_schema(spark: SparkSession, spec: FeedSpec) -> T.StructType | None:
    """Schema of the bronze rows written so far (record + rescue + lineage columns)."""
    record = read_schema_record(spark, spec)
    if record is None:
        return None
    tail = [T.StructField(RESCUED, T.StringType()), T.StructField(MONTH_COL, T.StringType()),
            T.StructField("_source_file_path", T.StringType()),
            T.StructField("_source_file_name", T.StringType()),
            T.StructField("_processing_timestamp", T.TimestampType())]
    return T.StructType(list(record.fields) + tail)


def evolve(record: T.StructType | None, seen: T.StructType) -> T.StructType:
    """Known columns keep their type; new columns are appended in arrival order.

    Names that differ in case only are one column, under the name that came first.
    The same holds inside structs, also those in arrays and maps."""
    known = {f.name.lower(): f for f in (record.fields if record is not None else [])}
    for f in seen.fields:
        old = known.get(f.name.lower())
        known[f.name.lower()] = T.StructField(old.name, _evolve_type(old.dataType, f.dataType), True, old.metadata) if old else f
    return T.StructType(list(known.values()))


def _evolve_type(old: T.DataType, seen: T.DataType) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(seen, T.StructType):
        return evolve(old, seen)
    if isinstance(old, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(_evolve_type(old.elementType, seen.elementType), True)
    if isinstance(old, T.MapType) and isinstance(seen, T.MapType):
        return T.MapType(old.keyType, _evolve_type(old.valueType, seen.valueType), True)
    return old


def _same(have: T.DataType, want: T.DataType) -> bool:
    return have.simpleString() == want.simpleString()


def _nested(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType, T.MapType))


def _fit(x: Column, have: T.DataType, want: T.DataType) -> Column:
    """``x`` as ``want``: members by name, missing ones NULL, values that do not fit NULL."""
    if _same(have, want):
        return x
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        members = [(_fit(x.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(x.isNotNull(), F.struct(*members))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(x, lambda e: _fit(e, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and _same(have.keyType, want.keyType):
        return F.transform_values(x, lambda _, v: _fit(v, have.valueType, want.valueType))
    if _nested(have) or _nested(want):
        return F.lit(None).cast(want)
    cast = x.try_cast(want)
    return F.when((cast.cast(have) == x).eqNullSafe(F.lit(True)), cast)


def _misfits(x: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """Whether some leaf of ``x`` is lost by ``_fit``; None if none can be."""
    if _same(have, want):
        return None
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        to = {f.name: f.dataType for f in want.fields}
        parts = [x.getField(f.name).isNotNull() if f.name not in to else _misfits(x.getField(f.name), f.dataType, to[f.name]) for f in have.fields]
        parts = [p for p in parts if p is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return F.coalesce(out, F.lit(False))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        if _misfits(F.lit(None), have.elementType, want.elementType) is None:
            return None
        return F.coalesce(F.exists(x, lambda e: _misfits(e, have.elementType, want.elementType)), F.lit(False))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and _same(have.keyType, want.keyType):
        if _misfits(F.lit(None), have.valueType, want.valueType) is None:
            return None
        return F.coalesce(F.exists(F.map_values(x), lambda v: _misfits(v, have.valueType, want.valueType)), F.lit(False))
    return x.isNotNull() & _fit(x, have, want).isNull()


def _text(x: Column, t: T.DataType) -> Column:
    return F.to_json(x) if _nested(t) else x.cast("string")


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing -> NULL; misfits -> NULL + ``_rescued``.

    A nested column with a misfit leaf keeps its other leaves and is rescued whole."""
    cols: list[Column] = []
    rescues: list[Column] = []
    have: dict[str, list[T.StructField]] = {}
    for g in df.schema.fields:
        have.setdefault(g.name.lower(), []).append(g)

    def rescue(g: T.StructField, lost: Column) -> None:
        src = F.col(f"`{g.name}`")
        rescues.append(F.when(lost, F.struct(F.lit(g.name).alias("k"), _text(src, g.dataType).alias("v"))))

    for f in schema.fields:
        own = sorted(have.pop(f.name.lower(), []), key=lambda g: g.name != f.name)
        if not own:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        fitted = [_fit(F.col(f"`{g.name}`"), g.dataType, f.dataType) for g in own]
        taken = fitted[0] if len(own) == 1 else F.coalesce(*fitted)
        cols.append(taken.alias(f.name))
        for k, g in enumerate(own):
            src, lost = F.col(f"`{g.name}`"), _misfits(F.col(f"`{g.name}`"), g.dataType, f.dataType)
            if k:       # the same name in other case: what the column does not hold
                other = src.isNotNull() if _nested(f.dataType) else src.isNotNull() & ~fitted[k].eqNullSafe(taken)
                lost = other if lost is None else lost | other
            if lost is not None:
                rescue(g, lost)
    for g in (g for own in have.values() for g in own):     # record written by another run
        rescue(g, F.col(f"`{g.name}`").isNotNull())
    if rescues:
        entries = F.filter(F.array(*rescues), lambda x: x.isNotNull())
        rescued = F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries)))
    else:
        rescued = F.lit(None).cast("string")
    return df.select(*cols, rescued.alias(RESCUED))


# ---------------------------------------------------------------- reading new files

def _signatures(spark: SparkSession, paths: list[str], fmt: str) -> list[tuple[str, str]]:
    """path, signature of each file, read in tasks: a CSV file's header line, a Parquet file's schema."""
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs, parquet
        for b in batches:
            found = []
            for path in b.column(0).to_pylist():
                store, name = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)
                if fmt == "parquet":
                    with store.open_input_file(name) as f:
                        found.append("; ".join(f"{c.name}: {c.type}" for c in parquet.read_schema(f)))
                else:
                    with store.open_input_stream(name, compression="detect") as f:
                        line = b""
                        while b"\n" not in line and (more := f.read(4096)):
                            line += more
                    found.append(line.split(b"\n")[0].rstrip(b"\r").decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=["path", "signature"])

    workers_import(spark)
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 64))
    # at most max_files_per_trigger rows
    return sorted((r["path"], r["signature"]) for r in listed.mapInArrow(run, "path string, signature string").collect())


def read_new_files(spark: SparkSession, paths: list[str], spec: FeedSpec) -> list[DataFrame]:
    """Batch reads of the given files with inference and lineage columns: one for each schema, in the order of the first file with it."""
    def lineage(df: DataFrame) -> DataFrame:
        return df.select("*", F.col("_metadata.file_path").alias("_source_file_path"),
                         F.col("_metadata.file_name").alias("_source_file_name"))

    if spec.fmt not in ("csv", "parquet"):
        return [lineage(spark.read.format(spec.fmt).load(paths))]
    groups: dict[str, list[str]] = {}
    for path, signature in _signatures(spark, paths, spec.fmt):
        groups.setdefault(signature, []).append(path)
    reader = spark.read.option("header", spec.header).option("inferSchema", True) if spec.fmt == "csv" else spark.read
    return [lineage(reader.format(spec.fmt).load(group)) for group in groups.values()]


# ---------------------------------------------------------------- the run

@dataclass
class IngestResult:
    batches: int
    files: int
    schema: T.StructType | None


def ingest(spark: SparkSession, spec: FeedSpec, timeout_s: float | None = None) -> IngestResult:
    """One triggered run: ingest all files that arrived since the last run."""
    listing_schema = T.StructType([
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ])
    # every file of the folder, whatever its ending; Spark's listing leaves out names with _ and . in front
    files = (spark.readStream.format("binaryFile").schema(listing_schema)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", spec.max_files_per_trigger)
             .load(spec.source_path)
             .select("path", "length"))
    stats = {"batches": 0, "files": 0}

    def write(paths: list[str], batch_id: int) -> None:
        groups = read_new_files(spark, paths, spec)
        lineage = [T.StructField("_source_file_path", T.StringType()),
                   T.StructField("_source_file_name", T.StringType())]
        old = record = read_schema_record(spark, spec)
        for df in groups:       # as if each schema's files had come in a run of their own
            record = evolve(record, T.StructType([f for f in df.schema.fields if f.name not in ("_source_file_path", "_source_file_name", MONTH_COL)]))
        if old is None or record != old:
            _write_schema_record(spark, spec, record)
        # align() keeps only record columns; carry the lineage through it
        aligned = None
        for df in groups:
            part = align(df.drop(MONTH_COL), T.StructType(list(record.fields) + lineage))
            aligned = part if aligned is None else aligned.union(part)
        month = F.regexp_extract("_source_file_path", _MONTH_RE, 1)
        result = aligned.select(
            *[F.col(f"`{f.name}`") for f in record.fields],
            F.col(RESCUED),
            F.when(month != "", month).alias(MONTH_COL),
            "_source_file_path", "_source_file_name",
            F.current_timestamp().alias("_processing_timestamp"),
            F.lit(batch_id).cast("long").alias(BATCH_COL))
        (result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy(BATCH_COL).parquet(spec.target_path))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # file paths of this micro-batch only: at most max_files_per_trigger names
        paths = sorted(r.path for r in batch.select("path").collect())
        if not paths:
            return
        # columns whose names differ in case only are told apart until align() has put them together
        case = spark.conf.get("spark.sql.caseSensitive")
        spark.conf.set("spark.sql.caseSensitive", "true")
        try:
            write(paths, batch_id)
        finally:
            spark.conf.set("spark.sql.caseSensitive", case)
        stats["batches"] += 1
        stats["files"] += len(paths)

    q = (files.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", spec.checkpoint.rstrip("/") + "/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return IngestResult(stats["batches"], stats["files"], read_schema_record(spark, spec))


def read_bronze(spark: SparkSession, target_path: str) -> DataFrame:
    """Batch read of a bronze table; older files get NULL for later columns."""
    return spark.read.option("mergeSchema", True).parquet(target_path)
