"""Gold views as pure DataFrame functions of silver DataFrames.

Each function is a full recompute (materialized-view semantics); write the
result with :func:`stratum.config.write_view`.  Aggregates are
built before joins so no join fans out, and every join is a left outer
equi-join on one key whose right side is unique per key.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import days_between, flag
from stratum.operators.cdc import current_versions
from stratum.operators.latest import latest_per_key
from stratum.operators import ordered, skew
from stratum.operators.ranges import HotKeys, hot_keys
from stratum.operators.rank import percent_rank_table
from stratum.session import materialize

# Status literals the gold views compare against (case-sensitive).
APPROVED_CLAIM_STATUSES = ("Assessed", "Paid")
COMPLETED_PAYMENT_STATUS = "Completed"
DOLLAR_LIMIT_TYPE = "Dollar"
RAPID_RECLAIM_DAYS = 7
HIGH_COST_FACTOR = 2
ESCALATING_FACTOR = Decimal("1.5")  # a decimal literal, as in SQL
ESCALATING_MIN_SEQ = 3


def _zero_if_null(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _line_aggregate(claim_line: DataFrame, with_gap: bool) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("line_count"),
            F.sum("charge_amount").alias("total_line_charge"),
            F.sum("benefit_amount").alias("total_line_benefit")]
    if with_gap:
        aggs.append(F.sum("gap_amount").alias("total_line_gap"))
    return current_versions(claim_line).groupBy("claim_id").agg(*aggs)


def latest_assessment(claim_assessment: DataFrame, cols: list[str]) -> DataFrame:
    """Latest assessment per claim; ties on the date broken by ``assessment_id``."""
    return latest_per_key(claim_assessment, "claim_id",
                          ["assessment_date", "assessment_id"], cols)


def claim_summary(claim: DataFrame, claim_line: DataFrame,
                  claim_assessment: DataFrame) -> DataFrame:
    """One row per current claim with line totals and the latest assessment."""
    c = current_versions(claim)
    cl = _line_aggregate(claim_line, with_gap=True)
    ca = latest_assessment(claim_assessment, ["assessment_type", "assessed_by", "outcome",
                                              "original_benefit", "adjusted_benefit",
                                              "assessment_date"])
    ca = ca.select("claim_id", "assessment_type", "assessed_by",
                   F.col("outcome").alias("assessment_outcome"),
                   F.col("original_benefit").alias("assessed_original_benefit"),
                   F.col("adjusted_benefit").alias("assessed_adjusted_benefit"))
    j = c.join(cl, "claim_id", "left").join(ca, "claim_id", "left")
    return j.select(
        "claim_id", "claim_number", "policy_id", "member_id", "claim_type", "claim_status",
        "service_date", "lodgement_date", c["assessment_date"], "payment_date",
        "total_charge", "total_benefit", "total_gap", "excess_applied", "co_payment_applied",
        _zero_if_null("line_count").alias("line_count"),
        _zero_if_null("total_line_charge").alias("total_line_charge"),
        _zero_if_null("total_line_benefit").alias("total_line_benefit"),
        _zero_if_null("total_line_gap").alias("total_line_gap"),
        "assessment_type", "assessed_by", "assessment_outcome",
        "assessed_original_benefit", "assessed_adjusted_benefit",
        days_between(c["assessment_date"], "lodgement_date").alias("days_to_assess"),
        days_between("payment_date", c["assessment_date"]).alias("days_to_pay"),
        "claim_channel", "is_fraud", "fraud_type",
    )


def benefit_utilization(benefit_usage: DataFrame, claim: DataFrame,
                        approved_statuses=APPROVED_CLAIM_STATUSES,
                        dollar_type: str = DOLLAR_LIMIT_TYPE, clustered: bool = False) -> DataFrame:
    """Usage per policy x member x category x year x limit type.

    ``clustered``: the usage comes from a shuffle by ``claim_id`` into tasks of bounded size
    (:func:`stratum.operators.skew.dealt`); else it is dealt out here.
    """
    cc = current_versions(claim).select("claim_id", "claim_status")
    # hardly any two rows share (keys, claim), so the tasks of the join and of the sums by claim
    # hold all their rows, sorted and hashed
    usage = benefit_usage if clustered else skew.dealt(benefit_usage, ["claim_id"])
    bu = usage.join(cc, "claim_id", "left")
    keys = ["policy_id", "member_id", "benefit_category_id", "benefit_year", "limit_type"]
    # Two exact COUNT(DISTINCT claim_id) variants without Expand: the current
    # status is one value per claim, so aggregate per (keys, claim) first and
    # count claims in the second step.  Both steps combine map-side.
    per_claim = bu.groupBy(*keys, "claim_id").agg(
        F.sum("usage_amount").alias("usage_amount"),
        F.sum("usage_count").alias("usage_count"),
        F.max("annual_limit").alias("annual_limit"),
        F.min("remaining_limit").alias("remaining_limit"),
        F.max(F.col("claim_status").isin(*approved_statuses)).alias("approved"),
        F.min("usage_date").alias("first_usage_date"),
        F.max("usage_date").alias("last_usage_date"),
    )
    amount_t = benefit_usage.schema["usage_amount"].dataType
    sum_t = (T.DecimalType(min(38, amount_t.precision + 10), amount_t.scale)
             if isinstance(amount_t, T.DecimalType) else
             T.DoubleType() if isinstance(amount_t, T.FractionalType) else T.LongType())
    agg = per_claim.groupBy(*keys).agg(
        F.sum("usage_amount").cast(sum_t).alias("total_usage_amount"),  # type of one SUM
        F.sum("usage_count").alias("total_usage_count"),
        F.max("annual_limit").alias("annual_limit"),
        F.min("remaining_limit").alias("remaining_limit"),
        F.count("claim_id").alias("claim_count"),
        F.count_if(F.col("claim_id").isNotNull() & F.col("approved")).alias("approved_claim_count"),
        F.min("first_usage_date").alias("first_usage_date"),
        F.max("last_usage_date").alias("last_usage_date"),
    )
    pct = F.when((F.col("annual_limit") > 0) & (F.col("limit_type") == dollar_type),
                 F.round(F.col("total_usage_amount") / F.col("annual_limit") * 100, 2))
    return agg.select(*keys, "total_usage_amount", "total_usage_count", "annual_limit",
                      "remaining_limit", "claim_count", "approved_claim_count",
                      "first_usage_date", "last_usage_date", pct.alias("utilization_pct"))


def policy_billing_summary(invoice: DataFrame, payment: DataFrame,
                           as_of: _dt.date | Column | None = None,
                           completed_status: str = COMPLETED_PAYMENT_STATUS) -> DataFrame:
    """Per-policy billing KPIs for policies with at least one current invoice.

    ``as_of`` replaces ``current_date()`` so the view is reproducible.
    """
    today = F.current_date() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of))
    inv = current_versions(invoice).groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("total_invoices"),
        F.sum("total_amount").alias("total_invoiced_amount"),
        F.sum("paid_amount").alias("total_paid_amount"),
        F.sum("balance_due").alias("total_outstanding"),
        F.count_if((F.col("balance_due") > 0) & (F.col("due_date") < today)).alias("overdue_count"),
        F.count_if(F.col("arrears_created") == F.lit(True)).alias("arrears_count"),
        F.min("invoice_date").alias("first_invoice_date"),
        F.max("invoice_date").alias("last_invoice_date"),
    )
    pay = (current_versions(payment).where(F.col("payment_status") == completed_status)
           .groupBy("policy_id").agg(
               F.count(F.lit(1)).alias("total_payments"),
               F.sum("payment_amount").alias("total_payment_amount"),
               F.max("payment_date").alias("last_payment_date")))
    j = inv.join(pay, "policy_id", "left")
    rate = (F.when(F.col("total_invoiced_amount") > 0,
                   F.round(F.col("total_paid_amount") / F.col("total_invoiced_amount") * 100, 2))
            .otherwise(F.lit(0)))
    return j.select("policy_id", "total_invoices", "total_invoiced_amount", "total_paid_amount",
                    "total_outstanding", "overdue_count", "arrears_count",
                    "first_invoice_date", "last_invoice_date",
                    _zero_if_null("total_payments").alias("total_payments"),
                    _zero_if_null("total_payment_amount").alias("total_payment_amount"),
                    "last_payment_date", rate.alias("payment_rate_pct"))


def member_windows(claims: DataFrame, chunks: int = 1, hot: HotKeys | None = None) -> DataFrame:
    """Per-member sequence, gap, running, moving, lifetime and rank columns.

    ``chunks <= 1``: plain windows that share the partition key ``member_id`` so
    Catalyst plans one exchange; the ``(service_date, claim_id)`` order is total.
    ``chunks > 1``: the split form of :mod:`stratum.operators.ordered` -- same
    values, but the members ``hot`` (default: those that the limit cuts which makes ``chunks``
    ranges of the largest) are scanned in parallel ranges instead of one task.
    """
    if chunks > 1 and hot is None:
        hot = hot_keys(claims, ["member_id"], 0, chunks)
    if chunks > 1 and hot is not None:
        seq = ordered.sequence_windows(claims, "member_id", ("service_date", "claim_id"), "total_charge", "total_benefit",
                                       hot.ranges(F.struct("service_date", "claim_id")))
        return ordered.rank_desc_within(seq, "member_id", "total_charge", "member_charge_rank",
                                        hot.ranges(F.col("total_charge")))
    w = Window.partitionBy("member_id").orderBy("service_date", "claim_id")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moving3 = w.rowsBetween(-2, Window.currentRow)
    whole = Window.partitionBy("member_id")
    by_charge = Window.partitionBy("member_id").orderBy(F.col("total_charge").desc())
    return claims.select(
        "*",
        F.row_number().over(w).alias("member_claim_seq"),
        F.datediff("service_date", F.lag("service_date").over(w)).alias("days_since_prev_claim"),
        F.datediff(F.lead("service_date").over(w), "service_date").alias("days_to_next_claim"),
        F.sum("total_charge").over(running).alias("member_running_total_charge"),
        F.sum("total_benefit").over(running).alias("member_running_total_benefit"),
        F.round(F.avg("total_charge").over(moving3), 2).alias("member_moving_avg_charge_3"),
        F.count(F.lit(1)).over(whole).alias("member_total_claims"),
        F.sum("total_charge").over(whole).alias("member_lifetime_charge"),
        F.round(F.avg("total_charge").over(whole), 2).alias("member_avg_charge"),
        F.rank().over(by_charge).alias("member_charge_rank"),
    )


def member_claim_activity(claim: DataFrame, claim_line: DataFrame,
                          claim_assessment: DataFrame, *,
                          distributed_percent_rank: bool = True,
                          rank_buckets: int = 1, member_chunks: int = 16,
                          hot_rows: int | None = None,
                          materialize_base: bool = False) -> DataFrame:
    """One row per current claim with per-member trend windows and risk flags.

    ``materialize_base`` writes the joined per-claim frame once to the shared
    folder: the split windows, the charge rank and the percent rank each
    aggregate it and join back, which would otherwise re-run its joins (worth
    it when the claim-line history is large; measured slower at sf0.1).
    """
    c = current_versions(claim)
    ca = latest_assessment(claim_assessment, ["outcome", "assessment_type"]).select(
        "claim_id", F.col("outcome").alias("assessment_outcome"), "assessment_type")
    cl = current_versions(claim_line).groupBy("claim_id").agg(
        F.count(F.lit(1)).alias("line_count"))
    base = (c.join(ca, "claim_id", "left").join(cl, "claim_id", "left")
            .select("claim_id", "claim_number", "policy_id", "member_id", "claim_type",
                    "claim_status", "service_date", "lodgement_date", c["assessment_date"],
                    "payment_date", "provider_id", "hospital_id", "total_charge",
                    "total_benefit", "total_gap", "excess_applied", "co_payment_applied",
                    "claim_channel", "is_fraud", "fraud_type", "assessment_outcome",
                    ca["assessment_type"], _zero_if_null("line_count").alias("line_count"),
                    days_between(c["assessment_date"], "lodgement_date").alias("days_to_assess"),
                    days_between("payment_date", c["assessment_date"]).alias("days_to_pay")))
    if materialize_base:
        base = materialize(base, "member-claims")
    # Members are counted in the narrow current-claims frame: the joined one would
    # run all of its joins once more.  The split plan is chosen only when some member
    # holds more than `hot_rows` claims.
    hot = hot_keys(c, ["member_id"], hot_rows, member_chunks) if member_chunks > 1 else None
    enriched = member_windows(base, member_chunks if hot else 1, hot)

    if distributed_percent_rank:
        # Every claim of a member carries the member's lifetime charge, so rank the
        # members (weighted by their claim count) and join back on member_id: the
        # claim rows are already hash-partitioned by member from the windows.
        charge_t = c.schema["total_charge"].dataType
        members = c.groupBy("member_id").agg(
            F.sum("total_charge").cast(T.DecimalType(min(38, charge_t.precision + 10), charge_t.scale))
            .alias("__lt"),
            F.count(F.lit(1)).alias("__claims"))
        by_value = percent_rank_table(members, "__lt", "__pr", "__claims", buckets=rank_buckets)
        member_pr = (members.join(by_value, members["__lt"].eqNullSafe(by_value["__lt"]), "left")
                     .select(members["member_id"].alias("__m"), "__pr"))
        # null-safe: claims without a member are a group of their own
        ranked = enriched.join(member_pr, F.col("member_id").eqNullSafe(F.col("__m")), "left").drop("__m")
    else:
        ranked = enriched.withColumn(
            "__pr", F.percent_rank().over(Window.orderBy("member_lifetime_charge")))

    return ranked.select(
        "claim_id", "claim_number", "policy_id", "member_id", "claim_type", "claim_status",
        "service_date", "lodgement_date", "assessment_date", "payment_date", "provider_id",
        "hospital_id", "total_charge", "total_benefit", "total_gap", "excess_applied",
        "co_payment_applied", "claim_channel", "assessment_outcome", "assessment_type",
        "line_count", "member_claim_seq", "days_since_prev_claim", "days_to_next_claim",
        "member_running_total_charge", "member_running_total_benefit",
        "member_moving_avg_charge_3", "member_total_claims", "member_lifetime_charge",
        "member_avg_charge",
        F.round(F.col("total_charge") - F.col("member_avg_charge"), 2).alias("charge_variance_from_avg"),
        "member_charge_rank", "days_to_assess", "days_to_pay",
        F.round(F.col("__pr") * 100, 2).alias("member_cost_percentile"),
        "is_fraud", "fraud_type",
        flag(F.col("days_since_prev_claim").isNotNull()
             & (F.col("days_since_prev_claim") < RAPID_RECLAIM_DAYS)).alias("rapid_reclaim_flag"),
        flag(F.col("total_charge") > F.col("member_avg_charge") * HIGH_COST_FACTOR).alias("high_cost_outlier_flag"),
        flag((F.col("member_moving_avg_charge_3") > F.col("member_avg_charge") * F.lit(ESCALATING_FACTOR))
             & (F.col("member_claim_seq") >= ESCALATING_MIN_SEQ)).alias("escalating_cost_flag"),
    )
