"""Operator-level queries over the driver tables (one per operator family).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; they are
registered in ``__spark_entry__.queries()`` next to the gold views.

Change-event mapping of ``events`` (fixed): key ``user_id``, sequence ``ts``,
row ``(event_type, value)``.  The partial-update log blanks ``value`` unless the
event is a purchase and blanks ``event_type`` for views, so NULL means
"unchanged".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import epoch_day_to_date, epoch_us_to_timestamp, hex_text, uuid_text
from stratum.operators import cdc, quality
from stratum.operators.latest import latest_per_key
from stratum.operators.rank import percent_rank_global
from stratum.plans import domain, feeds, gold, landing, pipeline, silver
from stratum.session import release_shuffles, scratch_dir, write_text
from stratum.sources import ingest as ing
from stratum.sources import sql as sql_text
from stratum.streaming import flows, progress

SCD2_CHUNKS = 8   # with hot_rows=0 the split plan always runs, so the oracle checks it


def events(spark: SparkSession, sf: str) -> DataFrame:
    return domain.table(spark, sf, "events")


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("user_id", "ts", "event_type", "value")


def partial_change_log(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    return e.select(
        "user_id", "ts",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"))


# ---------------------------------------------------------------- CDC

def q_latest_per_key(spark, sf):
    return latest_per_key(events(spark, sf), "user_id", ["ts", "event_id"],
                          ["event_id", "ts", "event_type", "value"])


def q_scd1_latest(spark, sf):
    return cdc.scd1(change_log(spark, sf), "user_id", "ts")


def q_scd2_history(spark, sf):
    return cdc.scd2(change_log(spark, sf), "user_id", "ts", except_cols=["ts"],
                    chunks=SCD2_CHUNKS, hot_rows=0)


def q_scd2_partial_update(spark, sf):
    return cdc.scd2(partial_change_log(spark, sf), "user_id", "ts", partial=True,
                    except_cols=["ts"], chunks=SCD2_CHUNKS, hot_rows=0)


def q_scd2_current(spark, sf):
    hist = cdc.scd2(change_log(spark, sf), "user_id", "ts", except_cols=["ts"],
                    chunks=SCD2_CHUNKS, hot_rows=0)
    return cdc.current_versions(hist)


def q_scd2_composite_key(spark, sf):
    e = events(spark, sf).select("user_id", "event_type", "ts", "value", "props")
    return cdc.scd2(e, ["user_id", "event_type"], "ts", except_cols=["ts"], chunks=SCD2_CHUNKS, hot_rows=0)


BURST_ROWS = 64


def q_scd2_burst_key(spark, sf):
    """Text sequences; each twentieth event belongs to one key and falls into one second.  Keys of more than
    ``BURST_ROWS`` events are cut into ranges of about that many."""
    ev = events(spark, sf).select(
        F.when(F.col("event_id") % 20 == 0, F.lit(-1).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 20 == 0, F.concat(F.lit("2024-01-15 12:00:00."), F.lpad(F.col("event_id").cast("string"), 12, "0")))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("at"),
        "event_type", "value")
    return cdc.scd2(ev, "user_id", "at", except_cols=["at"], chunks=SCD2_CHUNKS, hot_rows=BURST_ROWS)


def q_sequence_fallback(spark, sf):
    """sequence = modified time, else created time; both NULL -> set aside."""
    e = events(spark, sf).select(
        "event_id", "user_id", "event_type", "value",
        F.when(F.col("event_type") != "signup", F.col("ts")).alias("modified_at"),
        F.when(F.col("event_type") != "error", F.col("ts") - F.expr("INTERVAL 1 SECOND"))
         .alias("created_at"))
    seq = F.coalesce(F.col("modified_at").cast("timestamp_ntz"), F.col("created_at").cast("timestamp_ntz"))
    ev = e.withColumn("_sequence_timestamp", seq).drop("modified_at", "created_at")
    return cdc.scd2(ev, "user_id", "_sequence_timestamp", except_cols=["_sequence_timestamp"],
                    chunks=SCD2_CHUNKS, hot_rows=0)


# ---------------------------------------------------------------- scalar functions

def _uuid_source(spark, sf):
    e = events(spark, sf)
    uid = F.unhex(F.md5(F.col("event_id").cast("string")))
    return e.select("event_id",
                    F.when(F.col("event_type") != "error", uid).alias("event_uuid"),
                    F.unix_micros(F.col("ts").cast("timestamp")).alias("created_at_us"),
                    F.unix_date(F.to_date("ts")).alias("event_day"))


def q_uuid_text(spark, sf):
    src = _uuid_source(spark, sf)
    return src.select("event_id", uuid_text("event_uuid").alias("event_uuid"),
                      uuid_text("event_uuid", null_on_null=True).alias("event_uuid_or_null"))


def q_hex_text(spark, sf):
    return _uuid_source(spark, sf).select("event_id", hex_text("event_uuid").alias("event_uuid"))


def q_epoch_conversion(spark, sf):
    src = _uuid_source(spark, sf)
    return src.select("event_id",
                      epoch_us_to_timestamp("created_at_us").cast("timestamp_ntz").alias("created_at"),
                      epoch_day_to_date("event_day").alias("event_day"))


# ---------------------------------------------------------------- data quality (Q1-Q8)

QUALITY_TABLES = ("claim", "claim_assessment", "benefit_usage")


def _silver(spark, sf, name):
    return {"claim": domain.claim, "claim_assessment": domain.claim_assessment,
            "benefit_usage": domain.benefit_usage}[name](spark, sf)


def q_expectation_counts(spark, sf):
    out = None
    for t in QUALITY_TABLES:
        counts = quality.expectation_counts(_silver(spark, sf, t), quality.silver_rules(t))
        counts = counts.select(F.lit(t).alias("table_name"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


FEED_QUALITY_TABLES = ("invoice", "payment", "claim_line")


def _prepared(spark, sf, name):
    """The silver rows of a feed as the pipeline's checks see them: the domain tables lack columns that these rules read."""
    orders, li = domain.table(spark, sf, "orders"), domain.table(spark, sf, "lineitem")
    bronze = {"invoice": lambda: feeds.invoice_bronze(orders), "payment": lambda: feeds.payment_bronze(li, orders),
              "claim_line": lambda: feeds.claim_line_bronze(li)}[name]()
    return silver.SPECS[name].prepare(bronze.withColumns({c: F.lit(None).cast("string") for c in silver.META}))


def q_expectation_counts_feeds(spark, sf):
    """The other three rule sets; with ``expectation_counts`` all 63 rules are counted."""
    out = None
    for t in FEED_QUALITY_TABLES:
        counts = quality.expectation_counts(_prepared(spark, sf, t), quality.silver_rules(t))
        counts = counts.select(F.lit(t).alias("table_name"), "*")
        out = counts if out is None else out.unionByName(counts)
    return out


def q_expectation_passthrough(spark, sf):
    t = "claim_assessment"
    return quality.observe_expectations(_silver(spark, sf, t), quality.silver_rules(t),
                                        "claim_assessment_checks")


# ---------------------------------------------------------------- windows

MEMBER_CHUNKS = 8


def _member_windows(spark, sf):
    claims = cdc.current_versions(domain.claim(spark, sf)).select(
        "claim_id", "member_id", "service_date", "total_charge", "total_benefit")
    return gold.member_windows(claims, MEMBER_CHUNKS)


def _claims_with_nulls(spark, sf):
    """Every claim; each seventh without member, each fifth without service date."""
    claims = cdc.current_versions(domain.claim(spark, sf))
    return claims.withColumn("member_id", F.when(F.col("claim_id") % 7 != 0, F.col("member_id"))) \
                 .withColumn("service_date", F.when(F.col("claim_id") % 5 != 0, F.col("service_date")))


def q_member_windows_nulls(spark, sf):
    """W2-W8 in the split form where members and dates may be missing."""
    claims = _claims_with_nulls(spark, sf).select("claim_id", "member_id", "service_date", "total_charge", "total_benefit")
    return gold.member_windows(claims, MEMBER_CHUNKS).drop("service_date", "total_charge", "total_benefit")


def q_member_sequence_gaps(spark, sf):
    return _member_windows(spark, sf).select("claim_id", "member_id", "member_claim_seq",
                                             "days_since_prev_claim", "days_to_next_claim")


def q_running_totals(spark, sf):
    return _member_windows(spark, sf).select("claim_id", "member_running_total_charge",
                                             "member_running_total_benefit")


def q_moving_average(spark, sf):
    return _member_windows(spark, sf).select("claim_id", "member_moving_avg_charge_3")


def q_partition_totals(spark, sf):
    return _member_windows(spark, sf).select("claim_id", "member_total_claims",
                                             "member_lifetime_charge", "member_avg_charge")


def q_charge_rank(spark, sf):
    return _member_windows(spark, sf).select("claim_id", "member_charge_rank")


def q_percent_rank_global(spark, sf):
    li = domain.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")).alias("price"))
    return percent_rank_global(li, "price", "pct_rank", buckets=16).drop("price")


# ---------------------------------------------------------------- aggregates (A1-A10)

def q_conditional_counts(spark, sf):
    o = domain.table(spark, sf, "orders")
    return o.groupBy(F.col("o_custkey").alias("customer")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("open_sum"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.count_distinct(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")))
         .alias("pending_priorities"),
        F.min(F.to_date("o_orderdate")).alias("first_order"),
        F.max(F.to_date("o_orderdate")).alias("last_order"),
    )


# ---------------------------------------------------------------- ingest


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
SPLIT_MONTH = "1997-12"


def _orders_feed(spark, sf):
    return feeds.with_month(domain.table(spark, sf, "orders"), "o_orderdate")


def _two_run_ingest(spark, sf, fmt, first_cols=None, second_reorder=False, name="ingest"):
    root = scratch_dir(spark, name)
    spec = ing.FeedSpec(f"{root}/incoming/claims/orders", f"{root}/bronze/orders",
                        f"{root}/checkpoints/orders", fmt=fmt)
    o = _orders_feed(spark, sf)
    if fmt == "csv":
        o = o.withColumn("o_orderdate", F.to_date("o_orderdate"))
    first = o.where(F.col(feeds.MONTH) <= SPLIT_MONTH)
    if first_cols is not None:
        first = first.select(*first_cols, feeds.MONTH)
    second = o.where(F.col(feeds.MONTH) > SPLIT_MONTH)
    if second_reorder:
        second = second.select(*reversed(second.columns))
    feeds.write_months(first, spec.source_path, fmt)
    ing.ingest(spark, spec)
    ing.ingest(spark, spec)          # nothing new: must be a no-op
    feeds.write_months(second, spec.source_path, fmt)
    ing.ingest(spark, spec)
    return ing.read_bronze(spark, spec.target_path)


def q_ingest_parquet_incremental(spark, sf):
    b = _two_run_ingest(spark, sf, "parquet", name="ingest-parquet")
    return b.select(*ORDERS_COLS, feeds.MONTH)


def q_ingest_json_incremental(spark, sf):
    b = _two_run_ingest(spark, sf, "json", name="ingest-json")
    return b.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
                    "o_orderpriority", feeds.MONTH)


def q_ingest_csv_incremental(spark, sf):
    b = _two_run_ingest(spark, sf, "csv", second_reorder=True, name="ingest-csv")
    return b.select(F.col("o_orderkey").cast("long").alias("o_orderkey"),
                    F.col("o_custkey").cast("long").alias("o_custkey"),
                    "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"),
                    "o_orderpriority", feeds.MONTH)


def q_schema_evolution(spark, sf):
    first = [c for c in ORDERS_COLS if c != "o_orderpriority"]
    b = _two_run_ingest(spark, sf, "parquet", first_cols=first, name="ingest-evolve")
    return b.select(*ORDERS_COLS, feeds.MONTH)


def _one_run_ingest(spark, sf, fmt, name, early, late):
    """Months up to the split through ``early``, later ones through ``late``, all taken in by one run."""
    root = scratch_dir(spark, name)
    spec = ing.FeedSpec(f"{root}/incoming/claims/orders", f"{root}/bronze/orders", f"{root}/checkpoints/orders", fmt=fmt)
    o = _orders_feed(spark, sf).select("o_orderkey", "o_orderstatus", feeds.MONTH)
    for part, shape in ((o.where(F.col(feeds.MONTH) <= SPLIT_MONTH), early), (o.where(F.col(feeds.MONTH) > SPLIT_MONTH), late)):
        shape(part).write.mode("append").partitionBy(feeds.MONTH).format("text" if fmt == "json" else fmt).option("header", True).save(spec.source_path)
    ing.ingest(spark, spec)
    return ing.read_bronze(spark, spec.target_path)


def q_ingest_mixed_types(spark, sf):
    """INT and BIGINT files in one run; what the first file's type cannot hold is rescued."""
    b = _one_run_ingest(spark, sf, "parquet", "ingest-mixed", lambda d: d.withColumn("o_orderkey", F.col("o_orderkey").cast("int")),
                        lambda d: d.withColumn("o_orderkey", F.col("o_orderkey").cast("long") * 1_000_003))
    return b.select("o_orderkey", "o_orderstatus", ing.RESCUED, feeds.MONTH)


def q_ingest_csv_mixed_types(spark, sf):
    """Files with another column order and another inferred type in one run."""
    b = _one_run_ingest(spark, sf, "csv", "ingest-csv-mixed", lambda d: d,
                        lambda d: d.select("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("K"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string")).alias("o_orderkey"), feeds.MONTH))
    return b.select("o_orderkey", "o_orderstatus", ing.RESCUED, feeds.MONTH)


def q_ingest_case_clash(spark, sf):
    """Keys that differ in case only, in one JSON object."""
    other = F.when(F.col("o_orderkey") % 3 == 0, F.lit(',"STATUS":"X"')).otherwise("")
    text = lambda d: d.select(F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey"), F.lit(',"status":"'), "o_orderstatus", F.lit('"'), other, F.lit("}")).alias("value"), feeds.MONTH)
    b = _one_run_ingest(spark, sf, "json", "ingest-case", text, text)
    return b.select("o_orderkey", F.col("status").alias("status"), ing.RESCUED, feeds.MONTH)


def q_lineage_columns(spark, sf):
    """Every bronze row names its file, and the file sits in its month folder."""
    b = _two_run_ingest(spark, sf, "parquet", name="ingest-lineage")
    return b.select(
        "o_orderkey", feeds.MONTH,
        F.col("_source_file_path").contains(F.concat(F.lit("extraction_month="), F.col(feeds.MONTH)))
        .alias("path_has_month"),
        F.col("_source_file_path").endswith(F.col("_source_file_name")).alias("path_ends_with_name"),
        F.col("_processing_timestamp").isNotNull().alias("stamped"))


# ---------------------------------------------------------------- streaming CDC

ARRIVALS = 5


def _streaming_cdc(spark, sf, scd_type, name):
    """All events, delivered in groups of event types (by hash): arrival order is not
    sequence order, so most batches carry late events.

    The flow runs after each arrival and takes all of its files as one batch: a batch
    rewrites the buckets it touches, so there must not be more of them the more files there are.
    """
    root = scratch_dir(spark, name)
    log = change_log(spark, sf)
    spec = flows.CdcSpec(keys=("user_id",), sequence="ts", except_cols=("ts",), scd_type=scd_type,
                         target_path=f"{root}/silver", changelog_path=f"{root}/changelog",
                         checkpoint=f"{root}/checkpoint", key_buckets=8, seq_chunks=4,
                         hot_rows=0)
    group = F.pmod(F.xxhash64(F.coalesce("event_type", F.lit(""))), F.lit(ARRIVALS))
    for g in range(ARRIVALS):
        log.where(group == g).write.mode("append").parquet(f"{root}/arrivals")
        flows.run_cdc_flow(spark, spark.readStream.schema(log.schema).parquet(f"{root}/arrivals"), spec)
    # replaying a batch changes nothing: rerun the writer for batch 0 from the log
    replay = spark.read.parquet(spec.changelog_path).where(F.col(flows.BATCH) == 0) \
        .drop(flows.BATCH, flows.KEY_BUCKET)
    flows.cdc_batch_writer(spark, spec)(replay, 0)
    return flows.read_scd(spark, spec.target_path)


def q_scd2_streaming(spark, sf):
    return _streaming_cdc(spark, sf, 2, "cdc-scd2").select(
        "user_id", "event_type", "value", cdc.START_AT, cdc.END_AT)


class _Lost(RuntimeError):
    """Stands for the loss of a batch."""


def interrupted(spark, spec, batch_id, lost_at):
    """For ``cdc_batch_writer``: the batch is lost at a step; at the swap when the buckets it
    replaces are deleted and none of the new ones has arrived."""
    def at_step(name):
        if name != lost_at:
            return
        if name == "swap":
            staged = spark.read.parquet(flows._staging(spec, batch_id))
            for r in staged.select(flows.KEY_BUCKET).distinct().collect():
                flows._delete(spark, f"{spec.target_path}/{flows.KEY_BUCKET}={r[0]}")
        raise _Lost(name)
    return at_step


def q_scd2_retry(spark, sf):
    """C11: each batch of events is lost at another step of its write, and run again."""
    root = scratch_dir(spark, "cdc-retry")
    spec = flows.CdcSpec(keys=("user_id",), sequence="ts", except_cols=("ts",), target_path=f"{root}/silver",
                         changelog_path=f"{root}/changelog", checkpoint=f"{root}/checkpoint", key_buckets=8)
    log = change_log(spark, sf)
    group = F.pmod(F.xxhash64(F.coalesce("event_type", F.lit(""))), F.lit(ARRIVALS))
    for g, lost_at in zip(range(ARRIVALS), ("stage", "record", "swap", "forget", "clear")):
        batch = log.where(group == g)
        try:
            flows.cdc_batch_writer(spark, spec, interrupted(spark, spec, g, lost_at))(batch, g)
        except _Lost:
            pass
        flows.cdc_batch_writer(spark, spec)(batch, g)
    return flows.read_scd(spark, spec.target_path).select("user_id", "event_type", "value", cdc.START_AT, cdc.END_AT)


def q_scd1_streaming(spark, sf):
    return _streaming_cdc(spark, sf, 1, "cdc-scd1").select("user_id", "event_type", "value")


# ---------------------------------------------------------------- append flows

def _event_log_bronze(spark, sf, path):
    e = events(spark, sf)
    (e.select("event_id", "user_id", "event_type", "value",
              F.unix_micros(F.col("ts").cast("timestamp")).alias("created_at"),
              F.unix_date(F.to_date("ts")).alias("event_day"),
              F.col("event_id").cast("string").alias("_event_id"),
              F.lit("insert").alias("_event_type"),
              F.lit("loader").alias("created_by"))
     .write.mode("overwrite").parquet(path))


def q_append_epoch_conversion(spark, sf):
    root = scratch_dir(spark, "append-epoch")
    _event_log_bronze(spark, sf, f"{root}/bronze")
    schema = spark.read.parquet(f"{root}/bronze").schema
    stream = flows.prepare_epoch_append(
        spark.readStream.schema(schema).parquet(f"{root}/bronze"), epoch_day_columns=["event_day"])
    rules = quality.rules_from_pairs([("value_non_negative", "value >= 0"),
                                      ("event_day_not_null", "event_day IS NOT NULL")])
    flows.run_append_flow(stream, f"{root}/silver", f"{root}/checkpoint", rules, "events")
    out = spark.read.parquet(f"{root}/silver")
    return out.select("event_id", "user_id", "event_type", "value", "event_day",
                      F.col("created_at").cast("timestamp_ntz").alias("created_at"))


def q_uuid_append_flow(spark, sf):
    """Append-only flow turning binary UUIDs into hex text, audit columns dropped."""
    root = scratch_dir(spark, "append-uuid")
    src = _uuid_source(spark, sf).select(
        "event_id", "event_uuid", F.lit(None).cast("timestamp").alias("__START_AT"),
        F.lit(None).cast("timestamp").alias("__END_AT"), F.lit("loader").alias("created_by"))
    src.write.mode("overwrite").parquet(f"{root}/bronze")
    stream = flows.prepare_append(spark.readStream.schema(src.schema).parquet(f"{root}/bronze"),
                                  uuid_columns=["event_uuid"])
    flows.run_append_flow(stream, f"{root}/silver", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/silver")


def q_scd1_struct_sequence(spark, sf):
    """Current state per key, ordered by a field of the CDC position struct."""
    root = scratch_dir(spark, "scd1-struct")
    e = events(spark, sf)
    position = F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("__cdc_timestamp_value"), F.lit("log").alias("__cdc_source"))
    src = e.select("user_id", "event_type", "value", position.alias("__START_AT"), F.lit("loader").alias("created_by"))
    src.write.parquet(f"{root}/bronze")
    stream = flows.prepare_scd1(spark.readStream.schema(src.schema).parquet(f"{root}/bronze"))
    spec = flows.CdcSpec(keys=("user_id",), scd_type=1, target_path=f"{root}/silver", changelog_path=f"{root}/changelog",
                         checkpoint=f"{root}/checkpoint", key_buckets=8)
    flows.run_cdc_flow(spark, stream, spec)
    return flows.read_scd(spark, spec.target_path).select("user_id", "event_type", "value")


EVENT_DAYS_SQL = """
SELECT event_id, user_id, upper(event_type) AS kind, to_date(ts) AS event_day, round(value * 2, 2) AS twice
FROM STREAM(arrivals) WHERE event_type <> 'error'
"""


def q_sql_stream_flow(spark, sf):
    """A SQL text over a stream, appended to a table."""
    root = scratch_dir(spark, "sql-stream")
    e = events(spark, sf)
    e.write.parquet(f"{root}/bronze")
    stream = sql_text.run_sql(spark, EVENT_DAYS_SQL, {"arrivals": spark.readStream.schema(e.schema).parquet(f"{root}/bronze")})
    flows.run_append_flow(stream, f"{root}/silver", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/silver")


EVENTS_PER_DAY_SQL = """
SELECT to_date(ts) AS event_day, event_type, count(*) AS events, count(DISTINCT user_id) AS users
FROM {source} GROUP BY ALL
"""


def q_sql_file_view(spark, sf):
    """A gold view whose text lies in a file, with its source's name filled in."""
    path = f"{scratch_dir(spark, 'sql-file')}/events_per_day.sql"
    write_text(spark, path, EVENTS_PER_DAY_SQL)
    return sql_text.run_sql_file(spark, path, {"silver_events": events(spark, sf)}, {"source": "silver_events"})


def q_quality_metrics_table(spark, sf):
    """Q1, Q8: rule counts of every micro-batch, read back from the metrics table."""
    root = scratch_dir(spark, "metrics")
    e = events(spark, sf)
    for g in range(ARRIVALS):
        e.where(F.pmod(F.xxhash64("event_id"), F.lit(ARRIVALS)) == g).write.mode("append").parquet(f"{root}/bronze")
    rules = quality.rules_from_pairs([("value_over_50", "value > 50"), ("known_user", "user_id IS NOT NULL"), ("no_error", "event_type <> 'error'")])
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/bronze")
    flows.run_append_flow(stream, f"{root}/silver", f"{root}/checkpoint", rules, "events", metrics_path=f"{root}/metrics")
    return (spark.read.parquet(f"{root}/metrics").groupBy("table", "rule")
            .agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), (F.count_distinct("batch_id") > 1).alias("several_batches")))


def q_progress_events(spark, sf):
    """Q1, Q8: the progress table over a CDC and an append flow that take the events in in three runs."""
    root = scratch_dir(spark, "progress")
    rules = quality.rules_from_pairs([("value_over_50", "value > 50"), ("no_error", "event_type <> 'error'")])
    log = events(spark, sf).select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id"), "ts", "event_type", "value")
    spec = flows.CdcSpec(keys=("user_id",), sequence="ts", except_cols=("ts",), target_path=f"{root}/silver", changelog_path=f"{root}/changelog",
                         checkpoint=f"{root}/cdc", key_buckets=8, rules=tuple(rules), table="user_state")
    with progress.recorded(spark, f"{root}/progress", {"user_state": "silver", "event_rows": "bronze"}):
        for g in range(3):
            log.where(F.col("event_id") % 3 == g).write.mode("append").parquet(f"{root}/arrivals")
            stream = spark.readStream.schema(log.schema).parquet(f"{root}/arrivals")
            flows.run_cdc_flow(spark, stream, spec)
            flows.run_append_flow(stream, f"{root}/rows", f"{root}/append", rules, "event_rows")
    late = progress.late_rows(spark, spec).select(F.lit("user_state").alias("flow"), "batch_id", "late_rows")
    return (progress.read_progress(spark, f"{root}/progress").join(late, ["flow", "batch_id"], "left")
            .select("layer", "flow", "batch_id", "input_rows", "invalid_rows", "late_rows", F.explode("rules").alias("rule", "c"))
            .select("layer", "flow", "batch_id", "input_rows", "invalid_rows", "late_rows", "rule", "c.passed", "c.failed"))


# ---------------------------------------------------------------- landing

def _vault(spark, sf, root):
    vault = f"{root}/vault"
    feeds.write_months(feeds.with_month(domain.table(spark, sf, "orders"), "o_orderdate"),
                       f"{vault}/claims/orders")
    feeds.write_months(feeds.with_month(domain.table(spark, sf, "lineitem"), "l_shipdate"),
                       f"{vault}/claims/lineitem")
    feeds.write_months(feeds.with_month(domain.table(spark, sf, "events"), "ts"),
                       f"{vault}/web/events", fmt="json")
    return landing.LandingConfig(vault=vault, incoming=f"{root}/incoming",
                                 tracker=f"{root}/tracker",
                                 formats={("web", "events"): "json"})


def q_month_inventory(spark, sf):
    cfg = _vault(spark, sf, scratch_dir(spark, "landing-inv"))
    return (landing.inventory(spark, cfg.vault)
            .groupBy("schema_name", "table_name", "month")
            .agg(F.count(F.lit(1)).alias("files")))


def q_dry_run_listing(spark, sf):
    cfg = _vault(spark, sf, scratch_dir(spark, "landing-dry"))
    return landing.dry_run_listing(landing.inventory(spark, cfg.vault))


LANDING_CEILING = "2001-08"   # last month of orders; lineitem runs three months longer


def _released(spark, sf, name):
    cfg = _vault(spark, sf, scratch_dir(spark, name))
    landing.run(spark, cfg, up_to="1998-12")           # M5: all months up to a ceiling
    landing.run(spark, cfg)                            # M3: the next month only
    landing.run(spark, cfg, up_to=LANDING_CEILING)     # M5 again from the new position
    landing.run(spark, cfg, specific="1996-02")        # M4: explicit month, re-released
    return cfg


def q_next_month(spark, sf):
    cfg = _released(spark, sf, "landing-next")
    inv = landing.inventory(spark, cfg.vault)
    last = landing.last_processed(spark, cfg)
    nxt = landing.next_month(inv, last)
    todo = landing.months_to_process(spark, cfg, inv, up_to="9999-12")
    return spark.createDataFrame([(last, nxt, len(todo))],
                                 "last_processed string, next_month string, remaining_months int")


def q_months_up_to(spark, sf):
    cfg = _released(spark, sf, "landing-upto")
    inv = landing.inventory(spark, cfg.vault)
    todo = landing.months_to_process(spark, cfg, inv, up_to="9999-12")
    return spark.createDataFrame([(m,) for m in todo], "month string")


def q_tracker_history(spark, sf):
    cfg = _released(spark, sf, "landing-hist")
    return landing.tracker_history(spark, cfg).drop("mb_transferred", "last_updated")


def q_tracker_overview(spark, sf):
    cfg = _released(spark, sf, "landing-over")
    return landing.tracker_overview(spark, cfg).drop("total_mb")


def q_released_rows(spark, sf):
    """M6: rows in the incoming area equal the vault rows of the released months."""
    cfg = _released(spark, sf, "landing-rows")
    inc = spark.read.parquet(f"{cfg.incoming}/claims/orders")
    return inc.select(*ORDERS_COLS, F.col(feeds.MONTH).cast("string").alias(feeds.MONTH))


def _orders_vault(spark, sf, name, fmt="parquet"):
    """Vault and feed of the orders: the months after the split have other columns than those before."""
    root = scratch_dir(spark, name)
    cfg = landing.LandingConfig(f"{root}/vault", f"{root}/incoming", f"{root}/tracker")
    spec = ing.FeedSpec(f"{cfg.incoming}/claims/orders", f"{root}/bronze", f"{root}/checkpoint", fmt=fmt)
    return cfg, spec, f"{cfg.vault}/claims/orders"


def q_release_new_column(spark, sf):
    """Months with and without a column are released together and keep it."""
    cfg, spec, vault = _orders_vault(spark, sf, "release-column")
    o = _orders_feed(spark, sf)
    feeds.write_months(o.where(F.col(feeds.MONTH) <= SPLIT_MONTH).drop("o_orderpriority"), vault)
    feeds.write_months(o.where(F.col(feeds.MONTH) > SPLIT_MONTH), vault)
    landing.run(spark, cfg, up_to="9999-12")
    ing.ingest(spark, spec)
    return ing.read_bronze(spark, spec.target_path).select(*ORDERS_COLS, feeds.MONTH)


def q_release_csv_reordered(spark, sf):
    """M6, S3: CSV months with their columns in another order arrive under the right names."""
    cfg, spec, vault = _orders_vault(spark, sf, "release-csv", "csv")
    o = _orders_feed(spark, sf).withColumn("o_orderdate", F.to_date("o_orderdate"))
    feeds.write_months(o.where(F.col(feeds.MONTH) <= SPLIT_MONTH), vault, "csv")
    late = o.where(F.col(feeds.MONTH) > SPLIT_MONTH)
    feeds.write_months(late.select(*reversed(late.columns)), vault, "csv")
    landing.run(spark, cfg, up_to="9999-12")
    ing.ingest(spark, spec)
    b = ing.read_bronze(spark, spec.target_path)
    return b.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority", feeds.MONTH)


def q_release_late_files(spark, sf):
    """M4, M6: files that come late to released months are delivered, no row arrives twice."""
    cfg, spec, vault = _orders_vault(spark, sf, "release-late")
    o = _orders_feed(spark, sf)
    feeds.write_months(o.where("o_orderkey % 3 <> 0"), vault)
    released = landing.run(spark, cfg, up_to="9999-12")
    ing.ingest(spark, spec)
    feeds.write_months(o.where("o_orderkey % 3 = 0"), vault)
    landing.release(spark, cfg, released)
    ing.ingest(spark, spec)
    return ing.read_bronze(spark, spec.target_path).select(*ORDERS_COLS, feeds.MONTH)


def correct_files(spark, source, vault):
    """Files of the vault are replaced, under their names, by the corrected months in ``source``."""
    names = {(f.schema_name, f.table_name, f.month): f.path for f in landing.inventory(spark, vault).collect()}    # a calendar's worth
    for f in landing.inventory(spark, source).collect():
        old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (names[f.schema_name, f.table_name, f.month], f.path))
        fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(old, False)
        fs.rename(new, old)


def q_release_corrected_file(spark, sf):
    """M4, M6: corrected files of equal size replace what was delivered; the versions they replace are known."""
    cfg, _, vault = _orders_vault(spark, sf, "release-corrected", "csv")
    o = _orders_feed(spark, sf).select("o_orderkey", "o_orderstatus", feeds.MONTH)
    feeds.write_months(o, vault, "csv")
    released = landing.run(spark, cfg, up_to="9999-12")
    corrected = o.where(F.col(feeds.MONTH) > SPLIT_MONTH).withColumn("o_orderstatus", F.lit("Z"))
    feeds.write_months(corrected, f"{cfg.vault}-corrected/claims/orders", "csv")
    correct_files(spark, f"{cfg.vault}-corrected", cfg.vault)
    landing.release(spark, cfg, released)
    landing.release(spark, cfg, released)           # nothing is left to deliver
    replaced = landing.superseded(spark, cfg).groupBy(F.col("month").alias(feeds.MONTH)).agg(F.count("*").alias("versions_replaced"))
    rows = spark.read.schema(f"o_orderkey bigint, o_orderstatus string, {feeds.MONTH} string").option("header", True).csv(f"{cfg.incoming}/claims/orders")
    return rows.join(replaced, feeds.MONTH, "left").select("o_orderkey", "o_orderstatus", feeds.MONTH, F.coalesce("versions_replaced", F.lit(0)).alias("versions_replaced"))


BLOCKED_MONTH, HALF_MONTH = "1996-03", "1996-05"


def q_tracker_attempts(spark, sf):
    """Each attempt at a month stays in the tracker, also the failed one that was made good."""
    root = scratch_dir(spark, "release-attempts")
    cfg = landing.LandingConfig(f"{root}/vault", f"{root}/incoming", f"{root}/tracker")
    feeds.write_months(_orders_feed(spark, sf), f"{cfg.vault}/claims/orders")
    blocked = f"{cfg.incoming}/claims/orders/{feeds.MONTH}={BLOCKED_MONTH}"
    write_text(spark, blocked, "blocked")           # a file where the month's folder should be
    landing.run(spark, cfg, up_to="1996-06")
    landing.run(spark, cfg, specific=BLOCKED_MONTH)
    landing._fs_delete(spark, blocked)
    landing.run(spark, cfg, specific=BLOCKED_MONTH)
    landing.run(spark, cfg, specific="1996-02")
    vault = landing.inventory(spark, cfg.vault).groupBy(F.col("month").alias("simulation_month")).agg(F.sum("bytes").alias("vault_bytes"))
    history = landing.tracker_history(spark, cfg).select("simulation_month", F.col("mb_transferred").alias("last_mb"))
    every = landing.tracker_overview(spark, cfg, every_attempt=True)
    attempts = landing.tracker_attempts(spark, cfg).join(vault, "simulation_month").join(history, "simulation_month", "left")
    return attempts.select(
        "simulation_month", "attempt", F.col("total_files_transferred").alias("files"), "status",
        (F.col("total_bytes_transferred") == F.when(F.col("status") == "success", F.col("vault_bytes")).otherwise(0)).alias("bytes_agree"),
        (F.col("last_mb") == F.round(F.col("vault_bytes") / 1048576, 2)).alias("mb_agree"),
        every.select("successful_runs").scalar().alias("all_successful_runs"), every.select("failed_runs").scalar().alias("all_failed_runs"))


def q_tracker_status_partial(spark, sf):
    """M7: a month with no file copied, one with half of them, and the others; bytes are those of the vault's files."""
    root = scratch_dir(spark, "release-status")
    cfg = landing.LandingConfig(f"{root}/vault", f"{root}/incoming", f"{root}/tracker")
    o = _orders_feed(spark, sf)
    feeds.write_months(o, f"{cfg.vault}/claims/orders")
    feeds.write_months(o.where(F.col(feeds.MONTH) != BLOCKED_MONTH), f"{cfg.vault}/claims/more")
    for table, month in (("orders", BLOCKED_MONTH), ("orders", HALF_MONTH)):
        # a file where the month's folder should be
        write_text(spark, f"{cfg.incoming}/claims/{table}/{feeds.MONTH}={month}", "blocked")
    landing.run(spark, cfg, up_to="1996-06")
    vault = landing.inventory(spark, cfg.vault).groupBy(F.col("month").alias("simulation_month")).agg(F.sum("bytes").alias("vault_bytes"))
    errors = landing.read_errors(spark, cfg).groupBy(F.col("month").alias("simulation_month")).agg(F.count("*").alias("errors"))
    return (landing.read_tracker(spark, cfg).join(vault, "simulation_month").join(errors, "simulation_month", "left")
            .select("simulation_month", "total_tables_found", "tables_with_files", "tables_skipped", "total_files_transferred", "status",
                    (F.col("total_bytes_transferred") == F.col("vault_bytes")).alias("all_bytes"), F.coalesce("errors", F.lit(0)).alias("errors")))


# ---------------------------------------------------------------- end to end (step 9)


REPLAY_CEILINGS = ("1997-12", "1999-12", "9999-12")


def replay(spark, sf, name="replay"):
    """Release every month in three steps; after each, run bronze -> silver -> gold."""
    root = scratch_dir(spark, name)
    vault = f"{root}/vault"
    orders, li = domain.table(spark, sf, "orders"), domain.table(spark, sf, "lineitem")
    feeds.write_months(feeds.claim_bronze(orders), f"{vault}/claim/claim")
    feeds.write_months(feeds.claim_line_bronze(li), f"{vault}/claim/claim_line")
    feeds.write_months(feeds.claim_assessment_bronze(li), f"{vault}/claim/claim_assessment")
    release_shuffles(spark)
    lcfg = landing.LandingConfig(vault, f"{root}/pipeline/incoming", f"{root}/tracker")
    pcfg = pipeline.PipelineConfig(
        root=f"{root}/pipeline",
        feeds=(("claim", "claim", "parquet"), ("claim", "claim_line", "parquet"),
               ("claim", "claim_assessment", "parquet")),
        key_buckets=8, seq_chunks=4, optional_columns=True)
    for ceiling in REPLAY_CEILINGS:
        landing.run(spark, lcfg, up_to=ceiling)
        pipeline.run_all(spark, pcfg, only=("claim_summary",))
    return pcfg


def q_month_replay_gold(spark, sf):
    pcfg = replay(spark, sf, "replay-gold")
    return spark.read.parquet(pcfg.path("gold", "claim_summary"))


def q_month_replay_billing(spark, sf):
    """Billing feeds (binary UUIDs, full-row SCD2 flows) through landing, bronze,
    silver and the policy billing view, in three releases."""
    root = scratch_dir(spark, "replay-billing")
    vault = f"{root}/vault"
    orders, li = domain.table(spark, sf, "orders"), domain.table(spark, sf, "lineitem")
    feeds.write_months(feeds.invoice_bronze(orders), f"{vault}/billing/invoice")
    feeds.write_months(feeds.payment_bronze(li, orders), f"{vault}/billing/payment")
    release_shuffles(spark)
    lcfg = landing.LandingConfig(vault, f"{root}/pipeline/incoming", f"{root}/tracker")
    pcfg = pipeline.PipelineConfig(
        root=f"{root}/pipeline",
        feeds=(("billing", "invoice", "parquet"), ("billing", "payment", "parquet")),
        key_buckets=8, seq_chunks=4, as_of=domain.AS_OF, optional_columns=True)
    for ceiling in REPLAY_CEILINGS:
        landing.run(spark, lcfg, up_to=ceiling)
        pipeline.run_all(spark, pcfg, only=("policy_billing_summary",))
    return spark.read.parquet(pcfg.path("gold", "policy_billing_summary"))


def q_month_replay_usage(spark, sf):
    """Benefit-usage append flow (epoch days, money casts) and the claim CDC flow
    through landing, bronze and silver into the benefit utilization view."""
    root = scratch_dir(spark, "replay-usage")
    vault = f"{root}/vault"
    orders, li = domain.table(spark, sf, "orders"), domain.table(spark, sf, "lineitem")
    feeds.write_months(feeds.claim_bronze(orders), f"{vault}/claim/claim")
    feeds.write_months(feeds.benefit_usage_bronze(li, orders), f"{vault}/claim/benefit_usage")
    release_shuffles(spark)
    lcfg = landing.LandingConfig(vault, f"{root}/pipeline/incoming", f"{root}/tracker")
    pcfg = pipeline.PipelineConfig(
        root=f"{root}/pipeline",
        feeds=(("claim", "claim", "parquet"), ("claim", "benefit_usage", "parquet")),
        key_buckets=8, seq_chunks=4, optional_columns=True)
    for ceiling in REPLAY_CEILINGS:
        landing.run(spark, lcfg, up_to=ceiling)
        pipeline.run_all(spark, pcfg, only=("benefit_utilization",))
    return spark.read.parquet(pcfg.path("gold", "benefit_utilization"))
