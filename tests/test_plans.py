"""Physical-plan properties that matter at scale (no AQE, no broadcast, so the
static plan is what a large input would get)."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from stratum.operators import cdc
from stratum.operators.latest import latest_per_key
from stratum.operators.rank import percent_rank_global
from stratum.plans import gold

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "event_type", "value")


def test_scd1_and_latest_combine_map_side(static):
    ev = _events(static)
    assert "partial_max" in plan(cdc.scd1(ev, "user_id", "ts"))
    assert "partial_max" in plan(latest_per_key(ev, "user_id", ["ts"], ["event_type"]))


def test_scd2_plain_plan_one_exchange(static):
    p = plan(cdc.scd2(_events(static), "user_id", "ts", chunks=1))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "SinglePartition" not in p


def test_scd2_split_plan_partitions_by_key_and_range(static):
    p = plan(cdc.scd2(_events(static), "user_id", "ts", chunks=4, hot_rows=0))
    assert re.search(r"hashpartitioning\(user_id#\d+L, __chunk", p)


def test_percent_rank_single_partition_only_on_bucket_totals(static):
    li = static.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    p = plan(percent_rank_global(li, "l_extendedprice", "pr", buckets=8))
    singles = [m.start() for m in re.finditer("SinglePartition", p)]
    assert len(singles) == 1
    # the single-partition exchange sits under the per-bucket totals, not the rows
    tail = p[singles[0]:]
    assert "__bcnt" in tail.splitlines()[1] or "__bucket" in tail.splitlines()[1]


def test_member_percent_rank_joins_back_on_member(static):
    from stratum.plans import domain
    c, l, a = domain.claim(static, SF), domain.claim_line(static, SF), domain.claim_assessment(static, SF)
    p = plan(gold.member_claim_activity(c, l, a, hot_rows=10**9))
    assert "hashpartitioning(member_lifetime_charge" not in p
    assert "SinglePartition" in p            # only the bucket-totals window
    assert p.count("SinglePartition") == 1


def test_each_month_has_a_writer_task_of_its_own(spark, scratch):
    import os
    from stratum.plans import feeds
    days = spark.sql("SELECT id, timestampadd(MONTH, CAST(id % 84 AS INT), TIMESTAMP'1992-01-15') AS d FROM range(840)")
    feeds.write_months(feeds.with_month(days, "d"), f"{scratch}/months")
    tasks = {folder: [f.split("-")[1] for f in names if f.startswith("part-")] for folder, _, names in os.walk(f"{scratch}/months")}
    tasks = [t for found in tasks.values() for t in found]
    assert len(tasks) == 84 and len(set(tasks)) == 84


def test_a_task_of_few_months_sorts_nothing(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from stratum.plans import feeds
    days = feeds.with_month(spark.sql("SELECT id, TIMESTAMP'2024-01-15' AS d FROM range(1000)"), "d")
    seen, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda w, path: (seen.append(spark.conf.get(feeds.OPEN_FILES)), save(w, path)))
    feeds.write_months(days, f"{scratch}/one")
    assert seen == ["4"] and spark.conf.get(feeds.OPEN_FILES) == "0"
    assert spark.read.parquet(f"{scratch}/one").count() == 1000


def test_usage_tasks_follow_the_rows(static):
    """A task of the joins and of the sums by claim gets about taskRows rows, whatever the session's partitions."""
    from stratum.plans import domain
    from tests.conftest import rows
    query = lambda clustered: gold.benefit_utilization(domain.benefit_usage(static, SF, clustered=clustered),
                                                       domain.claim(static, SF), clustered=clustered)
    by_claim = lambda p: {(k, int(n)) for k, n in re.findall(r"Exchange hashpartitioning\((\w+)#\d+L, (\d+)\)", p)}
    small = query(True)                      # 6,000 rows: one task may hold them all
    assert {n for _, n in by_claim(plan(small))} == {4}
    static.conf.set("spark.stratum.taskRows", "100")
    try:
        dealt, here = query(True), query(False)
        p = plan(dealt)
        n = -(-domain.table(static, SF, "lineitem").count() // 100)
        assert by_claim(p) == {("l_orderkey", n), ("o_orderkey", n), ("claim_id", n)}
        assert p.count("REPARTITION_BY_NUM") == 1          # dealt once, before the join with orders
        assert "l_discount" not in p                       # the shuffle carries only columns that are used
        assert ("claim_id", n) in by_claim(plan(here))     # usage from anywhere, as from the silver table
        assert rows(small) == rows(dealt) == rows(here)
    finally:
        static.conf.unset("spark.stratum.taskRows")


def test_small_tables_are_not_dealt(spark):
    from stratum.operators import skew
    df = spark.range(1000)
    assert skew.dealt(df, ["id"]) is df
    spark.conf.set("spark.stratum.taskRows", "90")
    try:
        assert skew.dealt(df, ["id"]).rdd.getNumPartitions() == 12
        assert skew.dealt(spark.range(91), ["id"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("spark.stratum.taskRows")
