import json

import pytest

from stratum.operators import quality
from tests.conftest import rows


def test_true_false_null_counted(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = quality.rules_from_pairs([("x_non_negative", "x >= 0"), ("x_not_null", "x IS NOT NULL")])
    got = rows(quality.expectation_counts(df, rules))
    assert got == [("x_non_negative", 1, 2), ("x_not_null", 2, 1)]   # NULL result = failed


def test_empty_batch(spark):
    df = spark.createDataFrame([], "x int")
    got = rows(quality.expectation_counts(df, quality.rules_from_pairs([("r", "x > 0")])))
    assert got == [("r", 0, 0)]


def test_rows_pass_through_unchanged(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    out = quality.observe_expectations(df, quality.rules_from_pairs([("pos", "x > 0")]), "chk")
    assert rows(out) == [(-1,), (1,)]


def test_load_rules(tmp_path):
    p = tmp_path / "r.json"
    p.write_text(json.dumps({"expectations": [
        {"name": "a", "expression": "a IS NOT NULL", "failureAction": "warn"}]}))
    assert quality.load_rules(str(p)) == [quality.Rule("a", "a IS NOT NULL", "warn")]
    p.write_text(json.dumps({"expectations": [{"name": "a", "expression": "a", "failureAction": "drop"}]}))
    with pytest.raises(ValueError):
        quality.load_rules(str(p))


def test_silver_rule_sets_complete():
    assert {k: len(v) for k, v in quality.SILVER_RULES.items()} == {
        "invoice": 12, "payment": 8, "benefit_usage": 10, "claim": 13, "claim_assessment": 9,
        "claim_line": 11}


def test_status_case_is_significant(spark):
    df = spark.createDataFrame([("Paid",), ("paid",)], "claim_status string")
    r = [x for x in quality.silver_rules("claim") if x.name == "valid_claim_status"]
    assert rows(quality.expectation_counts(df, r)) == [("valid_claim_status", 1, 1)]


def test_all_silver_rules_are_counted_by_registered_queries(spark):
    import __spark_entry__ as E
    counted = [(r["table_name"], r["rule"]) for name, q in E.queries().items() if name.startswith("expectation_counts")
               for r in q(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(counted) == sorted((t, name) for t, rules in quality.SILVER_RULES.items() for name, _ in rules)
    assert len(counted) == 63
