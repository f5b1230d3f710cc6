"""Gold views on small silver fixtures with the edge cases spelled out."""

import datetime as dt
import random
from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators.rank import percent_rank_global
from stratum.plans import gold
from tests.conftest import rows

d = dt.date
NOW = None
CLAIM = ("claim_id long, claim_number string, policy_id long, member_id long, claim_type string, "
         "claim_status string, service_date date, lodgement_date date, assessment_date date, "
         "payment_date date, provider_id string, hospital_id string, total_charge decimal(10,2), "
         "total_benefit decimal(10,2), total_gap decimal(10,2), excess_applied decimal(10,2), "
         "co_payment_applied decimal(10,2), claim_channel string, is_fraud boolean, fraud_type string, "
         "__START_AT timestamp_ntz, __END_AT timestamp_ntz")
LINE = "claim_id long, charge_amount decimal(10,2), benefit_amount decimal(10,2), gap_amount decimal(10,2), __END_AT timestamp_ntz"
ASSESS = ("assessment_id string, claim_id long, assessment_type string, assessed_by string, outcome string, "
          "original_benefit decimal(10,2), adjusted_benefit decimal(10,2), assessment_date timestamp_ntz")
OLD = dt.datetime(2020, 1, 1)


def claim(cid, member, sd, charge, status="Paid", end=None, lodge=None, assess=None, pay=None):
    return (cid, f"C{cid}", member, member, "t", status, sd, lodge or sd, assess, pay, "p", None,
            None if charge is None else D(charge), D("1.00"), D("0.00"), D("0.00"), D("0.00"),
            "online", False, None, OLD, end)


def fixtures(spark):
    claims = spark.createDataFrame([
        claim(1, 10, d(2024, 1, 1), "100.00", lodge=d(2024, 1, 2), assess=d(2024, 1, 5), pay=d(2024, 1, 9)),
        claim(1, 10, d(2024, 1, 1), "999.00", end=OLD),                   # superseded: ignored
        claim(2, 10, d(2024, 1, 1), "300.00"),                            # two claims on one day
        claim(3, 10, d(2024, 1, 8), "300.00"),                            # exactly 7 days later, tied charge
        claim(4, 10, d(2024, 1, 14), "900.00"),                           # 6 days later
        claim(5, 20, d(2024, 2, 1), "50.00"),                             # member with one claim
        claim(6, 30, d(2024, 3, 1), None),                                # NULL charge
    ], CLAIM)
    lines = spark.createDataFrame([(1, D("60.00"), D("50.00"), D("10.00"), None),
                                   (1, D("40.00"), D("30.00"), D("10.00"), None),
                                   (1, D("500.00"), D("1.00"), D("1.00"), OLD),      # superseded line
                                   (2, D("300.00"), D("200.00"), D("100.00"), None)], LINE)
    assess = spark.createDataFrame([
        ("a1", 1, "auto", "u1", "approved", D("10.00"), D("9.00"), dt.datetime(2024, 1, 5)),
        ("a2", 1, "manual", "u2", "rejected", D("10.00"), D("0.00"), dt.datetime(2024, 1, 5)),  # tie -> a2
        ("a3", 2, "auto", "u3", "approved", D("5.00"), D("5.00"), dt.datetime(2024, 1, 3)),
    ], ASSESS)
    return claims, lines, assess


def test_claim_summary_edges(spark):
    c, l, a = fixtures(spark)
    out = {r["claim_id"]: r for r in gold.claim_summary(c, l, a).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6]
    assert out[1]["line_count"] == 2 and out[1]["total_line_charge"] == D("100.00")
    assert out[1]["assessment_outcome"] == "rejected"          # date tie broken by assessment_id
    assert out[1]["days_to_assess"] == 3 and out[1]["days_to_pay"] == 4
    assert out[3]["line_count"] == 0 and out[3]["total_line_gap"] == 0   # claim with no lines
    assert out[3]["assessment_type"] is None                             # no assessment


def test_member_claim_activity_edges(spark):
    c, l, a = fixtures(spark)
    for distributed, hot in ((True, 0), (False, None)):
        out = {r["claim_id"]: r for r in
               gold.member_claim_activity(c, l, a, distributed_percent_rank=distributed, rank_buckets=3,
                                          hot_rows=hot).collect()}
        assert [out[i]["member_claim_seq"] for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
        assert out[2]["days_since_prev_claim"] == 0 and out[2]["rapid_reclaim_flag"] is True
        assert out[3]["days_since_prev_claim"] == 7 and out[3]["rapid_reclaim_flag"] is False
        assert out[4]["days_since_prev_claim"] == 6 and out[4]["rapid_reclaim_flag"] is True
        assert out[1]["days_since_prev_claim"] is None and out[1]["rapid_reclaim_flag"] is False
        assert out[2]["member_charge_rank"] == out[3]["member_charge_rank"] == 2   # tied charges
        assert out[4]["member_running_total_charge"] == D("1600.00")
        assert out[3]["member_moving_avg_charge_3"] == D("233.33")
        assert out[1]["member_avg_charge"] == D("400.00")
        assert out[4]["high_cost_outlier_flag"] is True
        assert out[5]["member_total_claims"] == 1 and out[5]["days_to_next_claim"] is None
        assert out[6]["member_lifetime_charge"] is None and out[6]["high_cost_outlier_flag"] is False
        assert out[6]["member_cost_percentile"] == 0.0                 # NULL sorts first
        assert out[5]["member_cost_percentile"] == 20.0        # rank 2 of 6 rows


def test_benefit_utilization_edges(spark):
    c, _, _ = fixtures(spark)
    bu = spark.createDataFrame([
        (1, 10, 1, 2024, "Dollar", D("50.00"), 1, D("200.00"), D("150.00"), d(2024, 1, 1)),
        (1, 10, 1, 2024, "Dollar", D("25.00"), 2, D("200.00"), D("125.00"), d(2024, 1, 2)),
        (2, 10, 1, 2024, "Visits", D("10.00"), 1, D("5.00"), D("4.00"), d(2024, 1, 3)),
        (5, 20, 1, 2024, "Dollar", D("10.00"), 1, D("0.00"), D("0.00"), d(2024, 2, 1)),
        (6, 30, 1, 2024, "Dollar", D("10.00"), 1, None, None, d(2024, 3, 1)),
    ], "claim_id long, member_id long, benefit_category_id int, benefit_year int, limit_type string, "
       "usage_amount decimal(10,2), usage_count int, annual_limit decimal(10,2), "
       "remaining_limit decimal(10,2), usage_date date").withColumn("policy_id", F.col("member_id"))
    out = {(r["member_id"], r["limit_type"]): r for r in gold.benefit_utilization(bu, c).collect()}
    r = out[(10, "Dollar")]
    assert (r["total_usage_amount"], r["claim_count"], r["utilization_pct"]) == (D("75.00"), 1, D("37.50"))
    assert r["approved_claim_count"] == 1
    assert out[(10, "Visits")]["utilization_pct"] is None            # not a dollar limit
    assert out[(20, "Dollar")]["utilization_pct"] is None            # limit 0
    assert out[(30, "Dollar")]["utilization_pct"] is None            # limit NULL


def test_policy_billing_summary_edges(spark):
    inv = spark.createDataFrame([
        (1, d(2024, 1, 1), d(2024, 1, 31), D("100.00"), D("40.00"), D("60.00"), True, None),
        (1, d(2024, 2, 1), d(2024, 3, 31), D("100.00"), D("100.00"), D("0.00"), False, None),
        (1, d(2023, 1, 1), d(2023, 1, 31), D("999.00"), D("0.00"), D("999.00"), False, OLD),  # superseded
        (2, d(2024, 1, 1), d(2024, 1, 31), D("0.00"), D("0.00"), D("0.00"), False, None),   # total 0
    ], "policy_id long, invoice_date date, due_date date, total_amount decimal(10,2), "
       "paid_amount decimal(10,2), balance_due decimal(10,2), arrears_created boolean, __END_AT timestamp_ntz")
    pay = spark.createDataFrame([
        (1, d(2024, 2, 2), D("100.00"), "Completed", None),
        (1, d(2024, 2, 3), D("5.00"), "completed", None),           # wrong case: not completed
        (3, d(2024, 2, 2), D("7.00"), "Completed", None),           # payments only: absent
    ], "policy_id long, payment_date date, payment_amount decimal(10,2), payment_status string, __END_AT timestamp_ntz")
    out = {r["policy_id"]: r for r in gold.policy_billing_summary(inv, pay, as_of=d(2024, 3, 1)).collect()}
    assert sorted(out) == [1, 2]
    assert out[1]["total_invoices"] == 2 and out[1]["overdue_count"] == 1 and out[1]["arrears_count"] == 1
    assert out[1]["total_payments"] == 1 and out[1]["payment_rate_pct"] == D("70.00")
    assert out[2]["payment_rate_pct"] == 0 and out[2]["total_payments"] == 0


def test_distributed_percent_rank_equals_builtin(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([None, float(rnd.randrange(40)), rnd.random()])) for i in range(500)]
    data += [(1000 + i, 5.0) for i in range(200)]                     # one hot value
    df = spark.createDataFrame(data, "id int, x double")
    want = df.withColumn("pr", F.percent_rank().over(Window.orderBy("x")))
    for buckets in (1, 4, 33):
        got = percent_rank_global(df, "x", "pr", buckets=buckets)
        assert rows(got, "id", "pr") == rows(want, "id", "pr")
    one = spark.createDataFrame([(1, 3.0)], "id int, x double")
    assert percent_rank_global(one, "x", "pr").first()["pr"] == 0.0


def test_split_member_windows_equal_plain_on_hot_member(spark):
    rnd = random.Random(11)
    data = []
    for i in range(600):                       # member 1 owns most claims
        m = 1 if i < 400 else rnd.randrange(2, 40)
        charge = None if rnd.random() < 0.05 else D(str(rnd.choice([100, 250, rnd.randrange(1, 10**6) / 100])))
        data.append((i, m, d(2024, 1, 1) + dt.timedelta(days=rnd.randrange(0, 90)), charge,
                     D(str(rnd.randrange(0, 10**4) / 100))))
    claims = spark.createDataFrame(
        data, "claim_id long, member_id long, service_date date, total_charge decimal(10,2), "
              "total_benefit decimal(10,2)")
    plain = gold.member_windows(claims, 1)
    for chunks in (3, 16, 64):
        split = gold.member_windows(claims, chunks)
        assert sorted(split.columns) == sorted(plain.columns)
        assert rows(split, *plain.columns) == rows(plain)


def test_weighted_percent_rank_table_equals_expanded_builtin(spark):
    from stratum.operators.rank import percent_rank_table
    rnd = random.Random(5)
    members = [(m, rnd.choice([None, float(rnd.randrange(20))]), rnd.randrange(1, 6)) for m in range(120)]
    mdf = spark.createDataFrame(members, "m int, lt double, n int")
    expanded = spark.createDataFrame([(m, lt) for m, lt, n in members for _ in range(n)], "m int, lt double")
    want = {r["lt"]: r["pr"] for r in
            expanded.withColumn("pr", F.percent_rank().over(Window.orderBy("lt"))).select("lt", "pr").distinct().collect()}
    for buckets in (1, 5):
        got = {r["lt"]: r["pr"] for r in percent_rank_table(mdf, "lt", "pr", "n", buckets=buckets).collect()}
        assert got == want


def test_split_member_windows_with_double_amounts(spark):
    rnd = random.Random(3)
    data = [(i, 1 if i < 150 else rnd.randrange(2, 9), d(2024, 1, 1) + dt.timedelta(days=rnd.randrange(60)),
             None if rnd.random() < 0.05 else float(rnd.randrange(1, 500)), float(rnd.randrange(0, 50)))
            for i in range(250)]
    claims = spark.createDataFrame(
        data, "claim_id long, member_id long, service_date date, total_charge double, total_benefit double")
    plain = gold.member_windows(claims, 1)
    split = gold.member_windows(claims, 8)
    norm = lambda rs: [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rs]
    assert norm(rows(split, *plain.columns)) == norm(rows(plain))


def test_split_windows_equal_plain_ones_with_missing_members_and_dates(spark):
    import random
    random.seed(11)
    data = [(i, random.choice([None, 1, 1, 1, 2, 3]), random.choice([None, d(2024, 1, 1), d(2024, 1, 1 + i % 28), d(2024, 3, 1 + i % 20)]),
             random.choice([None, D("10.00"), D("20.00"), D(f"{i}.50")]), D("1.00")) for i in range(120)]
    df = spark.createDataFrame(data, "claim_id int, member_id int, service_date date, total_charge decimal(10,2), total_benefit decimal(10,2)")
    plain, split = gold.member_windows(df), gold.member_windows(df, chunks=5)
    assert rows(plain, *plain.columns) == rows(split, *plain.columns)


def test_activity_of_claims_without_member(spark):
    c, l, a = fixtures(spark)
    c = c.withColumn("member_id", F.when(F.col("claim_id") > 3, F.col("member_id")))
    views = [gold.member_claim_activity(c, l, a, distributed_percent_rank=x, rank_buckets=3, hot_rows=h) for x, h in ((True, 0), (True, None), (False, None))]
    first = rows(views[0], *views[0].columns)
    assert all(rows(v, *views[0].columns) == first for v in views[1:])
    assert all(r["member_cost_percentile"] is not None for r in views[0].collect())
