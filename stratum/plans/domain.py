"""Silver-shaped claims and billing tables derived from the driver's star-schema tables.

The driver tables (``orders``, ``lineitem``, ``events`` ...) are mapped onto the
claims domain so every gold view and flow runs over whole tables:

* claim            <- orders (one version per order, all current)
* claim_line       <- lineitem as change events keyed ``l_orderkey-l_linenumber``,
                      sequenced by ship date, built with :func:`scd2` -> superseded
                      versions exist and must be ignored by gold
* claim_assessment <- lineitem (append only; date ties broken by ``assessment_id``)
* benefit_usage    <- lineitem joined to orders (append only)
* invoice          <- orders (one version per order)
* payment          <- lineitem joined to orders as change events keyed by order,
                      built with :func:`scd2`

Money in the driver tables is DOUBLE with two decimals; it is cast to
decimal(10,2) first and all further arithmetic is exact decimal arithmetic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import money
from stratum.operators import skew
from stratum.operators.cdc import scd2

# Fixed value: the reporting date used instead of current_date() for billing.
AS_OF = _dt.date(1998, 8, 2)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    service = F.to_date("o_orderdate")
    total_charge = money("o_totalprice")
    total_gap = money(F.floor(F.col("o_totalprice") / 10))
    is_fraud = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    return o.select(
        F.col("o_orderkey").alias("claim_id"),
        F.concat(F.lit("CLM-"), F.col("o_orderkey").cast("string")).alias("claim_number"),
        F.col("o_custkey").alias("policy_id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderpriority").alias("claim_type"),
        F.when(F.col("o_orderstatus") == "F", "Paid").when(F.col("o_orderstatus") == "O", "Assessed")
         .otherwise("Lodged").alias("claim_status"),
        service.alias("service_date"),
        F.date_add(service, 2).alias("lodgement_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(service, 9)).alias("assessment_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(service, 16)).alias("payment_date"),
        F.concat(F.lit("PRV-"), F.col("o_custkey").cast("string")).alias("provider_id"),
        F.lit(None).cast("string").alias("hospital_id"),
        total_charge.alias("total_charge"),
        money(total_charge - total_gap).alias("total_benefit"),
        total_gap.alias("total_gap"),
        money(F.when(F.col("o_orderpriority") == "1-URGENT", 500).otherwise(0)).alias("excess_applied"),
        money(F.lit(0)).alias("co_payment_applied"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "online")
         .otherwise("branch").alias("claim_channel"),
        is_fraud.alias("is_fraud"),
        F.when(is_fraud, "inflation").alias("fraud_type"),
        F.col("o_orderdate").alias("__START_AT"),
        F.lit(None).cast("timestamp_ntz").alias("__END_AT"),
    )


def claim_line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    charge = money("l_extendedprice")
    gap = money(F.col("l_quantity").cast("decimal(10,2)") * 10)
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_line_id"),
        F.col("l_shipdate").alias("_sequence_timestamp"),
        F.col("l_orderkey").alias("claim_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("item_code"),
        F.col("l_quantity").cast("int").alias("quantity"),
        charge.alias("charge_amount"),
        money(charge - gap).alias("benefit_amount"),
        gap.alias("gap_amount"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_suppkey").cast("string").alias("provider_id"),
    )


def claim_line(spark: SparkSession, sf_dir: str, chunks: int = 8) -> DataFrame:
    return scd2(claim_line_events(spark, sf_dir), "claim_line_id", "_sequence_timestamp",
                except_cols=["_sequence_timestamp"], chunks=chunks)


def claim_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    original = money("l_extendedprice")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("assessment_id"),
        F.col("l_orderkey").alias("claim_id"),
        F.when(F.col("l_linestatus") == "F", "auto").otherwise("manual").alias("assessment_type"),
        F.col("l_shipdate").alias("assessment_date"),
        F.concat(F.lit("assessor-"), F.col("l_suppkey").cast("string")).alias("assessed_by"),
        original.alias("original_benefit"),
        money(original - F.col("l_quantity").cast("decimal(10,2)")).alias("adjusted_benefit"),
        F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "R", "rejected")
         .otherwise("pending_review").alias("outcome"),
    )


def benefit_usage(spark: SparkSession, sf_dir: str, clustered: bool = False) -> DataFrame:
    """``clustered``: dealt by claim before the join with orders, which keeps that shuffle."""
    li = table(spark, sf_dir, "lineitem")
    li = skew.dealt(li, ["l_orderkey"]) if clustered else li
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    usage = money("l_extendedprice")
    annual = money(F.when(F.col("l_returnflag") == "A", 150000)
                   .when(F.col("l_returnflag") == "R", 250000).otherwise(0))
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("benefit_usage_id"),
        F.col("o_custkey").alias("policy_id"),
        F.col("o_custkey").alias("member_id"),
        F.col("l_orderkey").alias("claim_id"),
        F.col("l_linenumber").alias("benefit_category_id"),
        F.year("l_shipdate").alias("benefit_year"),
        F.to_date("l_shipdate").alias("usage_date"),
        usage.alias("usage_amount"),
        F.col("l_quantity").cast("int").alias("usage_count"),
        annual.alias("annual_limit"),
        money(annual - usage).alias("remaining_limit"),
        F.when(F.col("l_linestatus") == "F", "Dollar").otherwise("Visits").alias("limit_type"),
    )


def invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    inv_date = F.to_date("o_orderdate")
    total = money("o_totalprice")
    paid = money(F.when(F.col("o_orderstatus") == "F", total)
                 .when(F.col("o_orderstatus") == "P", money(F.floor(F.col("o_totalprice") / 2)))
                 .otherwise(0))
    return o.select(
        F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("invoice_number"),
        F.col("o_custkey").alias("policy_id"),
        inv_date.alias("invoice_date"),
        F.date_add(inv_date, 30).alias("due_date"),
        total.alias("total_amount"),
        paid.alias("paid_amount"),
        money(total - paid).alias("balance_due"),
        ((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .alias("arrears_created"),
        F.col("o_orderdate").alias("__START_AT"),
        F.lit(None).cast("timestamp_ntz").alias("__END_AT"),
    )


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").select(
        F.concat(F.lit("PAY-"), F.col("l_orderkey").cast("string")).alias("payment_number"),
        F.col("l_shipdate").alias("_sequence_timestamp"),
        F.col("o_custkey").alias("policy_id"),
        F.to_date("l_shipdate").alias("payment_date"),
        money("l_extendedprice").alias("payment_amount"),
        F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Pending").alias("payment_status"),
        F.col("l_partkey").cast("string").alias("bank_reference"),
    )


def payment(spark: SparkSession, sf_dir: str, chunks: int = 8) -> DataFrame:
    # a payment's events are the lines of one order: their number is seen without the join
    hot = chunks > 1 and skew.needs_split(table(spark, sf_dir, "lineitem").select("l_orderkey"), ["l_orderkey"])
    return scd2(payment_events(spark, sf_dir), "payment_number", "_sequence_timestamp",
                except_cols=["_sequence_timestamp"], chunks=chunks if hot else 1, hot_rows=0)
