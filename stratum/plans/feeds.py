"""Source feeds derived from the driver tables, laid out like the landing vault.

``<root>/<schema>/<table>/extraction_month=YYYY-MM/<files>``; every row of the
source table is written (whole tables), the month comes from a date column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH = "extraction_month"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
WRITERS = 96                # tasks of a feed's writing, a month each over eight years


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(date_col, "yyyy-MM"))


def write_months(df: DataFrame, path: str, fmt: str = "parquet", one_file_per_month: bool = True,
                 mode: str = "append") -> None:
    """Write a month-partitioned feed.  ``one_file_per_month`` makes file counts
    predictable for fixtures (it routes each month through one task, so it is
    for derived test feeds, not for production releases)."""
    if one_file_per_month:
        # by the month's number, not its hash: no task gets several months while others get none
        number = F.col(MONTH).substr(1, 4).try_cast("int") * 12 + F.col(MONTH).substr(6, 2).try_cast("int")
        df = df.repartitionById(max(WRITERS, df.sparkSession.sparkContext.defaultParallelism), F.coalesce(number, F.lit(0)))
    w = df.write.mode(mode).partitionBy(MONTH)
    if fmt == "csv":
        w = w.option("header", True)
    elif fmt == "parquet":
        w = w.option("compression", "zstd")     # like the tables made from it
    # a task of few months keeps their files open: it sorts nothing, however many rows a month has
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FILES, "0")
    conf.set(OPEN_FILES, "4")
    try:
        w.format(fmt).save(path)
    finally:
        conf.set(OPEN_FILES, before)


# ---------------------------------------------------------------- claims-domain bronze feeds
#
# The reference's bronze shapes (change-event logs with epoch ints and audit
# columns), derived row for row from the driver tables.

def _null(t: str) -> "F.Column":
    return F.lit(None).cast(t)


def _event_cols(key_text, ts_us) -> list:
    return [F.concat(F.lit("ev-"), key_text).alias("_event_id"),
            F.lit("insert").alias("_event_type"),
            ts_us.alias("_event_timestamp"),
            F.lit("w1").alias("_event_worker_id"),
            F.lit("loader").alias("created_by"),
            _null("string").alias("modified_by")]


def claim_bronze(orders: DataFrame) -> DataFrame:
    o = orders
    day = F.unix_date(F.to_date("o_orderdate"))
    created = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    fraud = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return o.select(
        F.col("o_orderkey").alias("claim_id"),
        F.concat(F.lit("CLM-"), F.col("o_orderkey").cast("string")).alias("claim_number"),
        F.col("o_custkey").alias("policy_id"), F.col("o_custkey").alias("member_id"),
        _null("string").alias("coverage_id"),
        F.col("o_orderpriority").alias("claim_type"),
        F.when(F.col("o_orderstatus") == "F", "Paid").when(F.col("o_orderstatus") == "O", "Assessed")
         .otherwise("Lodged").alias("claim_status"),
        day.alias("service_date"), (day + 2).alias("lodgement_date"),
        F.when(F.col("o_orderstatus") != "P", day + 9).alias("assessment_date"),
        F.when(F.col("o_orderstatus") == "F", day + 16).alias("payment_date"),
        F.concat(F.lit("PRV-"), F.col("o_custkey").cast("string")).alias("provider_id"),
        _null("string").alias("hospital_id"),
        F.col("o_totalprice").alias("total_charge"),
        (F.col("o_totalprice") - F.floor(F.col("o_totalprice") / 10)).alias("total_benefit"),
        F.floor(F.col("o_totalprice") / 10).cast("double").alias("total_gap"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 500.0).otherwise(0.0).alias("excess_applied"),
        F.lit(0.0).alias("co_payment_applied"),
        _null("int").alias("rejection_reason_id"), _null("string").alias("rejection_notes"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "online")
         .otherwise("branch").alias("claim_channel"),
        _null("string").alias("pay_to"),
        fraud.alias("is_fraud"), F.when(fraud, "inflation").alias("fraud_type"),
        _null("double").alias("fraud_original_charge"), _null("double").alias("fraud_inflation_amount"),
        _null("double").alias("fraud_inflation_ratio"), _null("string").alias("fraud_source_claim_id"),
        _null("string").alias("fraud_ring_id"),
        created.alias("created_at"), _null("bigint").alias("modified_at"),
        *_event_cols(F.col("o_orderkey").cast("string"), created),
        F.date_format("o_orderdate", "yyyy-MM").alias(MONTH),
    )


def claim_line_bronze(lineitem: DataFrame) -> DataFrame:
    li = lineitem
    created = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    gap = F.col("l_quantity") * 10
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_line_id"),
        F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("item_code"), _null("string").alias("item_description"),
        _null("int").alias("clinical_category_id"), _null("int").alias("benefit_category_id"),
        F.unix_date(F.to_date("l_shipdate")).alias("service_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("charge_amount"), _null("double").alias("schedule_fee"),
        (F.col("l_extendedprice") - gap).alias("benefit_amount"), gap.alias("gap_amount"),
        F.col("l_linestatus").alias("line_status"), _null("int").alias("rejection_reason_id"),
        F.col("l_suppkey").cast("string").alias("provider_id"),
        _null("string").alias("provider_number"), _null("string").alias("tooth_number"),
        _null("string").alias("body_part"),
        created.alias("created_at"), _null("bigint").alias("modified_at"),
        *_event_cols(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), created),
        F.date_format("l_shipdate", "yyyy-MM").alias(MONTH),
    )


def claim_assessment_bronze(lineitem: DataFrame) -> DataFrame:
    li = lineitem
    at = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    aid = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select(
        aid.alias("assessment_id"), F.col("l_orderkey").alias("claim_id"),
        F.when(F.col("l_linestatus") == "F", "auto").otherwise("manual").alias("assessment_type"),
        at.alias("assessment_date"),
        F.concat(F.lit("assessor-"), F.col("l_suppkey").cast("string")).alias("assessed_by"),
        F.col("l_extendedprice").alias("original_benefit"),
        (F.col("l_extendedprice") - F.col("l_quantity")).alias("adjusted_benefit"),
        _null("string").alias("adjustment_reason"), _null("boolean").alias("waiting_period_check"),
        _null("boolean").alias("benefit_limit_check"), _null("boolean").alias("eligibility_check"),
        F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "R", "rejected")
         .otherwise("pending_review").alias("outcome"),
        _null("string").alias("notes"),
        at.alias("created_at"),
        *_event_cols(aid, at)[:5],
        F.date_format("l_shipdate", "yyyy-MM").alias(MONTH),
    )


def _uuid(*parts) -> "F.Column":
    """16-byte binary id derived from the row's natural key."""
    return F.unhex(F.md5(F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p
                                            for p in parts])))


def _cdc_struct(ts) -> "F.Column":
    return F.struct(ts.alias("__cdc_timestamp_value"))


def invoice_bronze(orders: DataFrame) -> DataFrame:
    total = F.col("o_totalprice").cast("decimal(10,2)")
    paid = F.when(F.col("o_orderstatus") == "F", total).otherwise(F.lit(0).cast("decimal(10,2)"))
    day = F.to_date("o_orderdate")
    return orders.select(
        _uuid(F.lit("inv"), "o_orderkey").alias("invoice_id"),
        F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("invoice_number"),
        _uuid(F.lit("pol"), "o_custkey").alias("policy_id"),
        day.alias("invoice_date"), F.date_add(day, 30).alias("due_date"),
        day.alias("period_start"), F.date_add(day, 29).alias("period_end"),
        F.when(F.col("o_orderstatus") == "F", "paid").otherwise("issued").alias("invoice_status"),
        total.alias("gross_premium"), F.lit(0).cast("decimal(10,2)").alias("lhc_loading_amount"),
        F.lit(0).cast("decimal(10,2)").alias("age_discount_amount"),
        F.lit(0).cast("decimal(10,2)").alias("rebate_amount"),
        F.lit(0).cast("decimal(10,2)").alias("other_adjustments"),
        total.alias("net_amount"), F.lit(0).cast("decimal(10,2)").alias("gst_amount"),
        total.alias("total_amount"), paid.alias("paid_amount"),
        (total - paid).cast("decimal(10,2)").alias("balance_due"),
        F.lit(0).alias("retry_attempts"), _null("date").alias("next_retry_date"),
        (F.col("o_orderpriority") == "1-URGENT").alias("arrears_created"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        _null("string").alias("modified_at"),
        F.lit("loader").alias("created_by"), _null("string").alias("modified_by"),
        _cdc_struct(F.col("o_orderdate")).alias("__START_AT"),
        _cdc_struct(_null("timestamp_ntz")).alias("__END_AT"),
        F.date_format("o_orderdate", "yyyy-MM").alias(MONTH),
    )


def payment_bronze(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey")
    j = lineitem.join(o, lineitem["l_orderkey"] == o["o_orderkey"])
    return j.select(
        _uuid(F.lit("pay"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payment_id"),
        F.concat(F.lit("PAY-"), F.col("l_orderkey").cast("string")).alias("payment_number"),
        _uuid(F.lit("pol"), "o_custkey").alias("policy_id"),
        _uuid(F.lit("inv"), "l_orderkey").alias("invoice_id"),
        F.to_date("l_shipdate").alias("payment_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("payment_amount"),
        F.lit("direct_debit").alias("payment_method"),
        F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Pending").alias("payment_status"),
        F.col("l_partkey").cast("string").alias("bank_reference"),
        _null("string").alias("created_at"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("modified_at"),
        F.lit("loader").alias("created_by"), _null("string").alias("modified_by"),
        F.date_format("l_shipdate", "yyyy-MM").alias(MONTH),
    )


def benefit_usage_bronze(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey")
    j = lineitem.join(o, lineitem["l_orderkey"] == o["o_orderkey"])
    created = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    annual = F.when(F.col("l_returnflag") == "A", 150000.0).when(F.col("l_returnflag") == "R", 250000.0) \
        .otherwise(0.0)
    uid = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return j.select(
        uid.alias("benefit_usage_id"),
        F.col("o_custkey").alias("policy_id"), F.col("o_custkey").alias("member_id"),
        F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("benefit_category_id"),
        F.year("l_shipdate").alias("benefit_year"),
        F.unix_date(F.to_date("l_shipdate")).alias("usage_date"),
        F.col("l_extendedprice").alias("usage_amount"), F.col("l_quantity").cast("int").alias("usage_count"),
        annual.alias("annual_limit"), (annual - F.col("l_extendedprice")).alias("remaining_limit"),
        F.when(F.col("l_linestatus") == "F", "Dollar").otherwise("Visits").alias("limit_type"),
        created.alias("created_at"),
        *_event_cols(uid, created)[:5],
        F.date_format("l_shipdate", "yyyy-MM").alias(MONTH),
    )
