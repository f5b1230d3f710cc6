"""Streaming CDC gives the batch answer under any batch split, late data and replay."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stratum.operators import cdc
from stratum.streaming import flows
from tests.conftest import rows

SCHEMA = "k string, seq timestamp_ntz, a string, b int"


def _log(n=300, keys=7, seed=3):
    rnd = random.Random(seed)
    return [(f"k{rnd.randrange(keys)}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(5000)),
             rnd.choice(["x", "y", None]), rnd.choice([1, 2, None])) for _ in range(n)]


def _run(spark, root, data, splits, partial, scd_type=2):
    src = f"{root}/src"
    for part in splits:
        spark.createDataFrame([data[i] for i in part], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    spec = flows.CdcSpec(keys=("k",), sequence="seq", except_cols=("seq",), partial=partial,
                         scd_type=scd_type, target_path=f"{root}/silver",
                         changelog_path=f"{root}/log", checkpoint=f"{root}/ckpt", key_buckets=4,
                         seq_chunks=3, hot_rows=0)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    flows.run_cdc_flow(spark, stream, spec)
    return spec


def test_stream_equals_batch_with_late_batches_and_replay(spark, scratch):
    data = _log()
    idx = list(range(len(data)))
    random.Random(1).shuffle(idx)
    splits = [idx[:50], idx[50:170], idx[170:]]                    # arbitrary arrival split
    for partial in (False, True):
        root = f"{scratch}/p{int(partial)}"
        spec = _run(spark, root, data, splits, partial)
        want = cdc.scd2(spark.createDataFrame(data, SCHEMA), "k", "seq", partial=partial, except_cols=["seq"])
        got = flows.read_scd(spark, spec.target_path)
        assert rows(got, *want.columns) == rows(want)
        # replay batch 1 through the writer: nothing changes
        replay = spark.read.parquet(spec.changelog_path).where(F.col(flows.BATCH) == 1) \
            .drop(flows.BATCH, flows.KEY_BUCKET)
        flows.cdc_batch_writer(spark, spec)(replay, 1)
        assert rows(flows.read_scd(spark, spec.target_path), *want.columns) == rows(want)


def test_stream_scd1(spark, scratch):
    data = _log(seed=9)
    spec = _run(spark, scratch, data, [list(range(0, 150)), list(range(150, 300))], False, scd_type=1)
    want = cdc.scd1(spark.createDataFrame(data, SCHEMA), "k", "seq", except_cols=["seq"])
    assert rows(flows.read_scd(spark, spec.target_path), *want.columns) == rows(want)


def test_rejected_events_are_kept_per_batch(spark, scratch):
    data = [("a", dt.datetime(2024, 1, 1), "x", 1), (None, dt.datetime(2024, 1, 2), "y", 2),
            ("b", None, "z", 3)]
    src = f"{scratch}/src"
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(src)
    spec = flows.CdcSpec(keys=("k",), sequence="seq", except_cols=("seq",), target_path=f"{scratch}/silver",
                         changelog_path=f"{scratch}/log", checkpoint=f"{scratch}/ckpt", key_buckets=2,
                         rejected_path=f"{scratch}/rejected")
    flows.run_cdc_flow(spark, spark.readStream.schema(SCHEMA).parquet(src), spec)
    assert rows(flows.read_scd(spark, spec.target_path), "k", "a") == [("a", "x")]
    assert rows(spark.read.parquet(spec.rejected_path), "a", flows.BATCH) == [("y", 0), ("z", 0)]


def test_expectation_counts_of_more_than_a_hundred_batches(spark, scratch):
    from stratum.operators import quality
    from stratum.streaming import flows
    src = f"{scratch}/in"
    spark.range(130).repartition(130, "id").write.option("maxRecordsPerFile", 1).parquet(src)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    rules = quality.rules_from_pairs([("even", "id % 2 = 0")])
    flows.run_append_flow(stream, f"{scratch}/out", f"{scratch}/ckpt", rules, "t", metrics_path=f"{scratch}/metrics")
    total = spark.read.parquet(f"{scratch}/metrics").selectExpr("count(distinct batch_id) AS n", "sum(passed) AS p", "sum(failed) AS f").first()
    assert (total.p, total.f) == (65, 65) and total.n > 100
