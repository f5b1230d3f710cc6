"""Progress table over streaming flows."""

from pyspark.sql import functions as F

from stratum.operators import quality
from stratum.streaming import flows, progress
from tests.conftest import rows

REPORT = {"id": "q", "runId": "r", "name": "f", "batchId": 3, "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 40, "processedRowsPerSecond": 2.5,
          "durationMs": {"triggerExecution": 12, "addBatch": 7}, "observedMetrics": {"f_expectations": {"rows": 20, "__invalid": 2, "rule": 5}}}


def test_row_of_a_report():
    r = progress.row_of(REPORT)
    assert (r["input_rows"], r["invalid_rows"], r["rules"], r["write_ms"]) == (20, 2, {"rule": {"passed": 15, "failed": 5}}, 7)
    bare = progress.row_of({k: REPORT[k] for k in ("id", "runId", "batchId", "timestamp", "numInputRows")})
    assert (bare["input_rows"], bare["invalid_rows"], bare["rules"], bare["trigger_ms"]) == (40, None, {}, None)


def test_flows_leave_a_row_for_each_batch(spark, scratch):
    spec = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t", changelog_path=f"{scratch}/l", checkpoint=f"{scratch}/c",
                         key_buckets=2, rules=tuple(quality.rules_from_pairs([("small", "v < 3")])), table="kept")
    other = flows.CdcSpec(keys=("k",), sequence="s", except_cols=("s",), target_path=f"{scratch}/t2", changelog_path=f"{scratch}/l2", checkpoint=f"{scratch}/c2",
                          key_buckets=2, table="other")
    batches = [[("a", 5, 1), ("b", 5, 2), (None, 1, 3)], [("a", 3, 4), ("a", 5, 4), ("a", 6, 4), ("c", 1, None), ("b", None, 1)]]
    with progress.recorded(spark, f"{scratch}/p", {"kept": "silver", "never run": "gold"}):
        for data in batches:
            spark.createDataFrame(data, "k string, s int, v int").write.mode("append").parquet(f"{scratch}/in")
            stream = spark.readStream.schema("k string, s int, v int").parquet(f"{scratch}/in")
            flows.run_cdc_flow(spark, stream, spec)
            flows.run_cdc_flow(spark, stream, other)
        flows.run_cdc_flow(spark, stream, spec)                       # nothing new
    got = progress.read_progress(spark, f"{scratch}/p")
    assert rows(got, "layer", "flow", "batch_id", "input_rows", "invalid_rows", F.col("rules")["small"]["passed"], F.col("rules")["small"]["failed"]) == [
        ("silver", "kept", 0, 3, 1, 2, 1), ("silver", "kept", 1, 5, 1, 1, 4)]
    assert got.where("trigger_ms > 0 AND write_ms > 0 AND at IS NOT NULL").count() == 2
    assert rows(progress.late_rows(spark, spec), "batch_id", "late_rows") == [(0, 0), (1, 1)]
    assert not spark.streams.active
