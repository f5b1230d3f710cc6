"""Data-quality expectations: warn-only rules that count failures and never drop rows.

A rule is ``(name, SQL boolean expression, action)``.  A NULL result counts as a
failure.  Counting is one aggregate over the batch (partial aggregation, a
single output row per rule set), so cost is one pass whatever the rule count.

* :func:`expectation_counts`  batch: ``(rule, passed, failed)`` long table
* :func:`observe_expectations` streams: attaches an ``observe`` so each
  micro-batch reports its counts in ``StreamingQueryProgress.observedMetrics``
  while rows pass through unchanged
* :func:`metrics_rows`        the per-batch metrics-table rows for a CDC flow
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    expression: str
    action: str = "warn"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.expression), F.lit(False))


def load_rules(path: str, spark=None) -> list[Rule]:
    """Read ``{"expectations": [{"name", "expression", "failureAction"}, ...]}``."""
    if spark is None:
        with open(path) as fh:
            doc = json.load(fh)
    else:                                   # any storage that Spark reads
        from stratum.session import read_text
        doc = json.loads(read_text(spark, path))
    rules = [Rule(e["name"], e["expression"], e.get("failureAction", "warn"))
             for e in doc["expectations"]]
    bad = [r.name for r in rules if r.action != "warn"]
    if bad:
        raise ValueError(f"only warn rules are supported, got {bad}")
    return rules


def rules_from_pairs(pairs) -> list[Rule]:
    return [Rule(n, e) for n, e in pairs]


def expectation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: ``rule``, ``passed``, ``failed`` (bigint)."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(r.passed()).alias(f"__p{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(f"__p{i}").alias("passed"))
        for i, r in enumerate(rules)]))
    return (one.select("__n", stacked.alias("__s"))
            .select(F.col("__s.rule").alias("rule"),
                    F.col("__s.passed").cast("long").alias("passed"),
                    (F.col("__n") - F.col("__s.passed")).cast("long").alias("failed")))


# Names in a flow's observation beside its rules'.
OBSERVATION, ROWS, INVALID = "_expectations", "rows", "__invalid"


def observe_expectations(df: DataFrame, rules: list[Rule], name: str, invalid: Column | None = None) -> DataFrame:
    """Pass rows through unchanged; count failures per rule (and ``invalid`` rows) as observed metrics."""
    metrics = [F.count(F.lit(1)).alias(ROWS)]
    if invalid is not None:
        metrics.append(F.count_if(invalid).alias(INVALID))
    metrics += [F.count_if(~r.passed()).alias(r.name) for r in rules]
    return df.observe(name, *metrics)


def metrics_rows(df: DataFrame, rules: list[Rule], table: str, batch_id: int) -> DataFrame:
    """Metrics-table rows ``(table, batch_id, rule, passed, failed, ts)`` for one batch."""
    return (expectation_counts(df, rules)
            .select(F.lit(table).alias("table"), F.lit(batch_id).cast("long").alias("batch_id"),
                    "rule", "passed", "failed", F.current_timestamp().alias("ts")))


# The warn-only silver rule sets (name, expression), per silver table.
SILVER_RULES: dict[str, list[tuple[str, str]]] = {
    "invoice": [
        ("invoice_id_not_null", "invoice_id IS NOT NULL"),
        ("invoice_number_not_null", "invoice_number IS NOT NULL"),
        ("policy_id_not_null", "policy_id IS NOT NULL"),
        ("invoice_date_not_null", "invoice_date IS NOT NULL"),
        ("net_amount_non_negative", "net_amount >= 0"),
        ("total_amount_non_negative", "total_amount >= 0"),
        ("gst_amount_non_negative", "gst_amount >= 0"),
        ("paid_amount_non_negative", "paid_amount >= 0"),
        ("balance_due_non_negative", "balance_due >= 0"),
        ("valid_invoice_status", "invoice_status IN ('draft', 'issued', 'paid', 'overdue', 'cancelled', 'partially_paid')"),
        ("period_end_after_start", "period_end >= period_start"),
        ("due_date_after_invoice_date", "due_date >= invoice_date"),
    ],
    "payment": [
        ("payment_id_not_null", "payment_id IS NOT NULL"),
        ("payment_number_not_null", "payment_number IS NOT NULL"),
        ("policy_id_not_null", "policy_id IS NOT NULL"),
        ("invoice_id_not_null", "invoice_id IS NOT NULL"),
        ("payment_date_not_null", "payment_date IS NOT NULL"),
        ("payment_amount_positive", "payment_amount > 0"),
        ("valid_payment_status", "payment_status IN ('pending', 'completed', 'failed', 'reversed', 'refunded')"),
        ("valid_payment_method", "payment_method IN ('direct_debit', 'credit_card', 'bpay', 'eft', 'cash', 'cheque')"),
    ],
    "benefit_usage": [
        ("benefit_usage_id_not_null", "benefit_usage_id IS NOT NULL"),
        ("policy_id_not_null", "policy_id IS NOT NULL"),
        ("member_id_not_null", "member_id IS NOT NULL"),
        ("claim_id_not_null", "claim_id IS NOT NULL"),
        ("usage_date_not_null", "usage_date IS NOT NULL"),
        ("usage_amount_non_negative", "usage_amount >= 0"),
        ("annual_limit_positive", "annual_limit > 0"),
        ("remaining_limit_non_negative", "remaining_limit >= 0"),
        ("remaining_not_exceed_annual", "remaining_limit <= annual_limit"),
        ("valid_benefit_year", "benefit_year >= 2000 AND benefit_year <= 2100"),
    ],
    "claim": [
        ("claim_id_not_null", "claim_id IS NOT NULL"),
        ("claim_number_not_null", "claim_number IS NOT NULL"),
        ("policy_id_not_null", "policy_id IS NOT NULL"),
        ("member_id_not_null", "member_id IS NOT NULL"),
        ("service_date_not_null", "service_date IS NOT NULL"),
        ("lodgement_date_not_null", "lodgement_date IS NOT NULL"),
        ("total_charge_non_negative", "total_charge >= 0"),
        ("total_benefit_non_negative", "total_benefit >= 0"),
        ("total_gap_non_negative", "total_gap >= 0"),
        ("excess_applied_non_negative", "excess_applied >= 0"),
        ("valid_claim_status", "claim_status IN ('lodged', 'under_assessment', 'approved', 'partially_approved', 'rejected', 'paid', 'appealed')"),
        ("valid_claim_type", "claim_type IN ('hospital', 'general_treatment', 'dental', 'optical', 'physiotherapy', 'pharmacy', 'ambulance', 'mental_health')"),
        ("lodgement_after_service", "lodgement_date >= service_date"),
    ],
    "claim_assessment": [
        ("assessment_id_not_null", "assessment_id IS NOT NULL"),
        ("claim_id_not_null", "claim_id IS NOT NULL"),
        ("assessment_date_not_null", "assessment_date IS NOT NULL"),
        ("assessed_by_not_null", "assessed_by IS NOT NULL"),
        ("original_benefit_non_negative", "original_benefit >= 0"),
        ("adjusted_benefit_non_negative", "adjusted_benefit >= 0"),
        ("valid_outcome", "outcome IN ('approved', 'partially_approved', 'rejected', 'pending_review', 'escalated')"),
        ("valid_assessment_type", "assessment_type IN ('auto', 'manual', 'review', 'appeal')"),
        ("adjusted_not_exceed_original", "adjusted_benefit <= original_benefit"),
    ],
    "claim_line": [
        ("claim_line_id_not_null", "claim_line_id IS NOT NULL"),
        ("claim_id_not_null", "claim_id IS NOT NULL"),
        ("line_number_positive", "line_number > 0"),
        ("item_code_not_null", "item_code IS NOT NULL"),
        ("service_date_not_null", "service_date IS NOT NULL"),
        ("quantity_positive", "quantity > 0"),
        ("charge_amount_non_negative", "charge_amount >= 0"),
        ("benefit_amount_non_negative", "benefit_amount >= 0"),
        ("gap_amount_non_negative", "gap_amount >= 0"),
        ("schedule_fee_non_negative", "schedule_fee >= 0"),
        ("benefit_not_exceed_charge", "benefit_amount <= charge_amount"),
    ],
}


def silver_rules(table: str) -> list[Rule]:
    return rules_from_pairs(SILVER_RULES[table])
