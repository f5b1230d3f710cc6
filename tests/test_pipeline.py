"""All six feeds through landing -> bronze -> silver -> gold in two releases equal a
one-shot batch build of the same silver and gold."""

import datetime as dt

from pyspark.sql import functions as F

from stratum.operators import cdc
from stratum.plans import domain, feeds, gold, landing, pipeline
from stratum.plans.silver import SPECS
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(1998, 8, 2)


def _bronze(spark):
    o, li = domain.table(spark, SF, "orders"), domain.table(spark, SF, "lineitem")
    return {
        ("billing", "invoice"): feeds.invoice_bronze(o),
        ("billing", "payment"): feeds.payment_bronze(li, o),
        ("claim", "benefit_usage"): feeds.benefit_usage_bronze(li, o),
        ("claim", "claim"): feeds.claim_bronze(o),
        ("claim", "claim_line"): feeds.claim_line_bronze(li),
        ("claim", "claim_assessment"): feeds.claim_assessment_bronze(li),
    }


def _batch_silver(bronze):
    out = {}
    for (_, table), df in bronze.items():
        spec = SPECS[table]
        with_meta = df.withColumn("_source_file_path", F.lit("x")).withColumn("_source_file_name", F.lit("x"))
        prepared = spec.prepare(with_meta.drop(feeds.MONTH))
        if spec.kind == "append_epoch":
            out[table] = prepared
        else:
            out[table] = cdc.scd2(prepared, list(spec.keys), "_sequence_timestamp",
                                  partial=spec.kind == "scd2_partial", except_cols=["_sequence_timestamp"])
    return out


def test_six_feeds_end_to_end_equal_batch(spark, scratch):
    bronze = _bronze(spark)
    for (schema, table), df in bronze.items():
        feeds.write_months(df, f"{scratch}/vault/{schema}/{table}")
    lcfg = landing.LandingConfig(f"{scratch}/vault", f"{scratch}/p/incoming", f"{scratch}/tracker")
    pcfg = pipeline.PipelineConfig(root=f"{scratch}/p", feeds=tuple((s, t, "parquet") for s, t in bronze),
                                   key_buckets=4, seq_chunks=3, as_of=AS_OF, optional_columns=True)
    for ceiling in ("1998-06", "9999-12"):
        landing.run(spark, lcfg, up_to=ceiling)
        pipeline.run_all(spark, pcfg)
    s = _batch_silver(bronze)
    want = {
        "claim_summary": gold.claim_summary(s["claim"], s["claim_line"], s["claim_assessment"]),
        "benefit_utilization": gold.benefit_utilization(s["benefit_usage"], s["claim"]),
        "policy_billing_summary": gold.policy_billing_summary(s["invoice"], s["payment"], as_of=AS_OF),
    }
    for name, w in want.items():
        got = spark.read.parquet(pcfg.path("gold", name))
        assert got.count() > 0
        assert rows(got, *w.columns) == rows(w), name
    pol = spark.read.parquet(pcfg.path("gold", "policy_billing_summary")).first()["policy_id"]
    assert len(pol) == 36 and pol.count("-") == 4          # binary UUID -> dashed text
    metrics = spark.read.parquet(pcfg.path("metrics", "invoice"))
    assert metrics.select("rule").distinct().count() == 12 # all invoice rules counted, warn only


def test_rules_that_do_not_resolve_are_an_error(spark, scratch):
    import pytest
    from stratum.operators import quality
    rules = quality.rules_from_pairs([("there", "id >= 0"), ("missing", "nothing > 0")])
    cfg = pipeline.PipelineConfig(root=scratch, feeds=())
    with pytest.raises(ValueError, match="missing"):
        pipeline._applicable(cfg, "t", rules, spark.range(1))
    lenient = pipeline.PipelineConfig(root=scratch, feeds=(), optional_columns=True)
    assert [r.name for r in pipeline._applicable(lenient, "t", rules, spark.range(1))] == ["there"]


def test_gold_views_are_compressed_like_the_other_layers(spark, scratch, monkeypatch):
    import os
    cfg = pipeline.PipelineConfig(root=scratch, feeds=())
    monkeypatch.setattr(pipeline, "gold_views", lambda *_: {"v": spark.range(10)})
    path = pipeline.run_gold(spark, cfg)["v"]
    written = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert written and all(".zstd." in f for f in written) and spark.read.parquet(path).count() == 10
