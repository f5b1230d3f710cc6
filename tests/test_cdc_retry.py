"""A CDC batch that is lost at any step of its write and run again leaves the table of the batch build."""

import pytest
from pyspark.sql import functions as F

from stratum.operators import cdc
from stratum.plans.registry import _Lost, interrupted
from stratum.streaming import flows
from tests.conftest import rows

EVENTS = [(k, s, f"v{k}{s}") for k in range(6) for s in (1, 2, 3) if (k + s) % 4]


@pytest.mark.parametrize("buckets", [1, 4])
def test_lost_at_every_step(spark, scratch, buckets):
    spec = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t{buckets}", changelog_path=f"{scratch}/l{buckets}",
                         checkpoint=f"{scratch}/c{buckets}", key_buckets=buckets)
    log = spark.createDataFrame(EVENTS, "k int, s int, v string")
    flows.cdc_batch_writer(spark, spec)(log.where("s = 2"), 0)
    late = log.where("s <> 2 AND k < 4")        # keys 4 and 5 stay as they are, in the same buckets
    for lost_at in ("log", "stage", "record", "swap", "swap", "forget", "clear"):
        with pytest.raises(_Lost):
            flows.cdc_batch_writer(spark, spec, interrupted(spark, spec, 1, lost_at))(late, 1)
    flows.cdc_batch_writer(spark, spec)(late, 1)
    want = cdc.scd2(log.where("s = 2 OR k < 4"), ["k"], "s", except_cols=["s"])
    cols = ["k", "v", cdc.START_AT, cdc.END_AT]
    assert rows(flows.read_scd(spark, spec.target_path), *cols) == rows(want, *cols)
    assert not flows._exists(spark, flows._staged_record(spec, 1)) and not flows._exists(spark, flows._staging(spec, 1))


def test_record_of_another_checkpoint_is_not_used(spark, scratch):
    spec = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t", changelog_path=f"{scratch}/l", checkpoint=f"{scratch}/c", key_buckets=2)
    log = spark.createDataFrame(EVENTS, "k int, s int, v string")
    log.limit(0).withColumn(flows.KEY_BUCKET, F.lit(0)).write.parquet(flows._staging(spec, 0))
    flows.write_text(spark, flows._staged_record(spec, 0), "another")
    flows.cdc_batch_writer(spark, spec)(log, 0)
    assert flows.read_scd(spark, spec.target_path).count() == len(EVENTS)


def test_swap_moves_the_staged_files(spark, scratch):
    import os
    spec = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t", changelog_path=f"{scratch}/l", checkpoint=f"{scratch}/c", key_buckets=4)
    log = spark.createDataFrame(EVENTS, "k int, s int, v string")
    staged = []

    def at_step(name):
        if name == "swap":
            staged.extend(f for _, _, names in os.walk(flows._staging(spec, 0)) for f in names if f.endswith(".parquet"))

    flows.cdc_batch_writer(spark, spec, at_step)(log, 0)
    there = [f for _, _, names in os.walk(spec.target_path) for f in names if f.endswith(".parquet")]
    assert staged and sorted(there) == sorted(staged)


def test_buckets_are_rebuilt_one_group_after_the_other(spark, scratch):
    """No more than a group is staged at a time, no copy of the batch is held, and a loss in any group leaves no trace."""
    import os
    spec = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t", changelog_path=f"{scratch}/l", checkpoint=f"{scratch}/c", key_buckets=4)
    log = spark.createDataFrame(EVENTS, "k int, s int, v string")
    staged = []

    def at_step(name):
        assert not spark.sparkContext._jsc.getPersistentRDDs()
        if name == "swap":
            staged.append([d for d in os.listdir(flows._staging(spec, 0)) if d.startswith(flows.KEY_BUCKET)])

    def lost_at(step, nth):
        seen = []

        def at(name):
            seen.append(name)
            if seen.count(step) == nth:
                interrupted(spark, spec, 1, step)(name)
        return at

    spark.conf.set(flows.REBUILD, "1")
    try:
        flows.cdc_batch_writer(spark, spec, at_step)(log.where("s = 2"), 0)
        assert len(staged) > 1 and {len(s) for s in staged} == {1}
        late = log.where("s <> 2 AND k < 4")
        assert late.select(flows._bucket(spec.keys, 4)).distinct().count() > 1
        for step, nth in (("stage", 2), ("record", 1), ("swap", 1), ("record", 1), ("swap", 2), ("forget", 1)):
            with pytest.raises(_Lost):
                flows.cdc_batch_writer(spark, spec, lost_at(step, nth))(late, 1)
        flows.cdc_batch_writer(spark, spec)(late, 1)
    finally:
        spark.conf.unset(flows.REBUILD)
    want = cdc.scd2(log.where("s = 2 OR k < 4"), ["k"], "s", except_cols=["s"])
    cols = ["k", "v", cdc.START_AT, cdc.END_AT]
    assert rows(flows.read_scd(spark, spec.target_path), *cols) == rows(want, *cols)


def test_rows_of_a_written_bucket_stand_in_the_order_of_their_keys(spark, scratch):
    """And the month feeds are compressed like the tables made from them."""
    import os
    from stratum.plans import feeds
    spec = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t", changelog_path=f"{scratch}/l", checkpoint=f"{scratch}/c", key_buckets=2, files_per_bucket=1)
    log = spark.range(0, 500, 1, 4).selectExpr("id * 37 % 100 AS k", "id AS s", "concat('v', id) AS v")
    flows.cdc_batch_writer(spark, spec)(log, 0)
    files = [os.path.join(d, f) for top in (spec.target_path, spec.changelog_path) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")]
    assert len(files) == 4
    for f in files:
        keys = [r[0] for r in spark.read.parquet(f).select("k").collect()]
        assert keys == sorted(keys)
    feeds.write_months(log.withColumn(feeds.MONTH, F.lit("1996-01")), f"{scratch}/vault")
    assert all(".zstd." in f for _, _, names in os.walk(f"{scratch}/vault") for f in names if f.endswith(".parquet"))
