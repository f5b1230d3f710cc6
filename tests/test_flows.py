"""Flow transform steps (full-row SCD2, SCD1, append) and layer configuration."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum import config
from stratum.operators import cdc, quality
from stratum.streaming import flows
from tests.conftest import rows

U1 = bytearray(range(16))


def test_full_row_prepare_uuid_sequence_and_excludes(spark):
    df = spark.createDataFrame([
        ("INV1", U1, None, "2024-01-02 00:00:00", "2024-01-01 00:00:00", "a", "b", 1.0),
        ("INV1", None, None, None, "2024-01-03 00:00:00", "a", "b", 2.0),
    ], "invoice_number string, invoice_id binary, __START_AT string, modified_at string, "
       "created_at string, created_by string, modified_by string, total double")
    out = flows.prepare_full_row_scd2(df, uuid_columns=["invoice_id"])
    assert out.columns == ["invoice_number", "invoice_id", "total", flows.SEQ]
    got = rows(out, "invoice_id", F.col(flows.SEQ).cast("string"))
    assert got == [("", "2024-01-03 00:00:00"), ("00010203-0405-0607-0809-0A0B0C0D0E0F", "2024-01-02 00:00:00")]
    hist = cdc.scd2(out, "invoice_number", flows.SEQ, except_cols=[flows.SEQ])
    assert rows(hist, "total", cdc.END_AT) == [(1.0, dt.datetime(2024, 1, 3)), (2.0, None)]


def test_scd1_prepare_reads_cdc_struct(spark):
    df = spark.createDataFrame([
        ("GOLD", U1, (dt.datetime(2024, 1, 1),), "x", "old"),
        ("GOLD", U1, (dt.datetime(2024, 2, 1),), "x", "new"),
    ], "category_code string, ref_id binary, __START_AT struct<__cdc_timestamp_value: timestamp>, "
       "created_by string, label string")
    out = flows.prepare_scd1(df, uuid_columns=["ref_id"])
    assert out.columns == ["category_code", "ref_id", "label", flows.SEQ]
    cur = cdc.scd1(out, "category_code", flows.SEQ)
    assert rows(cur) == [("GOLD", "000102030405060708090A0B0C0D0E0F", "new")]


def test_append_flow_writes_observed_metrics(spark, scratch):
    src = f"{scratch}/src"
    spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double").write.parquet(src)
    stream = spark.readStream.schema("id int, v double").parquet(src)
    rules = quality.rules_from_pairs([("v_non_negative", "v >= 0")])
    flows.run_append_flow(stream, f"{scratch}/out", f"{scratch}/ckpt", rules, "t",
                          metrics_path=f"{scratch}/metrics")
    assert spark.read.parquet(f"{scratch}/out").count() == 3          # nothing dropped
    m = spark.read.parquet(f"{scratch}/metrics")
    assert rows(m, "rule", "passed", "failed") == [("v_non_negative", 1, 2)]


def test_config_validation_and_bootstrap(spark, scratch):
    with pytest.raises(ValueError):
        config.LakehouseConfig(scratch, {"gold": "g"}).validate()
    cfg = config.LakehouseConfig(scratch, {"bronze_billing": "t_bronze_billing", "bronze_claim": "t_bronze_claim",
                                           "silver_billing": "t_silver_billing", "silver_claim": "t_silver_claim",
                                           "gold": "t_gold"})
    assert config.bootstrap(spark, cfg) == list(cfg.schemas.values())
    assert config.bootstrap(spark, cfg)                                # idempotent
    config.write_view(spark.createDataFrame([(1,)], "x int"), cfg, "v")
    assert spark.table("t_gold.v").count() == 1


def test_sql_text_over_batch_and_stream_views(spark, scratch):
    from stratum.sources.sql import run_sql, run_sql_file
    path = f"{scratch}.sql"
    with open(path, "w") as fh:
        fh.write("WITH cur AS (SELECT * FROM {src} WHERE __END_AT IS NULL)\n"
                 "SELECT claim_id, COUNT(*) AS line_count FROM cur GROUP BY claim_id")
    lines = spark.createDataFrame([(1, None), (1, None), (2, dt.datetime(2024, 1, 1))],
                                  "claim_id long, __END_AT timestamp")
    out = run_sql_file(spark, path, {"cl": lines}, {"src": "cl"})
    assert rows(out) == [(1, 2)]
    src = f"{scratch}/s"
    lines.write.parquet(src)
    stream = spark.readStream.schema(lines.schema).parquet(src)
    st = run_sql(spark, "SELECT claim_id FROM cl_stream WHERE __END_AT IS NULL", {"cl_stream": stream})
    assert st.isStreaming
    q = st.writeStream.format("memory").queryName("sql_stream_t").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("sql_stream_t")) == [(1,), (1,)]


def test_files_of_a_batch_are_bounded_by_its_buckets(spark, scratch):
    import os
    spec = flows.CdcSpec(keys=("id",), sequence="seq", except_cols=("seq",), target_path=f"{scratch}/t", changelog_path=f"{scratch}/l",
                         checkpoint=f"{scratch}/c", key_buckets=6, files_per_bucket=2)
    batch = spark.range(4000).selectExpr("id % 500 AS id", "id AS seq", "id AS v").repartition(40)
    flows.cdc_batch_writer(spark, spec)(batch, 0)
    for root in (spec.target_path, spec.changelog_path):
        files = [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
        assert 6 <= len(files) <= 12
    assert flows.read_scd(spark, spec.target_path).count() == 4000


def test_an_explicit_exclusion_must_exist(spark):
    import pytest
    df = spark.createDataFrame([(1, "a")], "id int, created_by string")
    assert flows.prepare_append(df).columns == ["id"]
    with pytest.raises(ValueError):
        flows.prepare_append(df, exclude=("nothing",))


def test_an_arrival_is_one_batch_whatever_its_files(spark, tmp_path, monkeypatch):
    """scd2_streaming: a batch rewrites whole buckets, so their number must not grow with the input's files."""
    from stratum.plans import registry
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    batches, writer = [], flows.cdc_batch_writer

    def counted(*args):
        write = writer(*args)
        return lambda batch, batch_id: (batches.append(batch_id), write(batch, batch_id))

    monkeypatch.setattr(flows, "cdc_batch_writer", counted)
    monkeypatch.setattr(registry, "change_log", lambda spark, sf: spark.read.parquet(f"{sf}/events.parquet")
                        .select("user_id", "ts", "event_type", "value").repartition(6))
    registry.q_scd2_streaming(spark, str(tmp_path)).count()
    assert batches == [*range(registry.ARRIVALS), 0]        # the last one is the replay


def test_append_flow_files_are_compressed_like_the_other_layers(spark, scratch):
    import os
    spark.range(50).selectExpr("id", "'x' AS t").write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema("id bigint, t string").parquet(f"{scratch}/in")
    flows.run_append_flow(stream, f"{scratch}/out", f"{scratch}/c")
    written = [f for f in os.listdir(f"{scratch}/out") if f.endswith(".parquet")]
    assert written and all(".zstd." in f for f in written)
    assert spark.read.parquet(f"{scratch}/out").count() == 50
