"""Driver contract: entry() smoke, registry shape, and Spark vs DuckDB oracle."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"
SLOW = {"month_replay_gold", "month_replay_billing", "month_replay_usage", "next_month", "months_up_to", "tracker_history", "tracker_overview",
        "released_rows", "ingest_parquet_incremental", "ingest_json_incremental",
        "ingest_csv_incremental", "schema_evolution", "lineage_columns", "scd2_streaming",
        "scd1_streaming", "month_inventory", "dry_run_listing", "release_new_column",
        "release_csv_reordered", "release_late_files", "tracker_status_partial", "release_corrected_file", "tracker_attempts"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "claim_id" in df.columns


OWN = set(E.queries()) - set(E.training_data.QUERIES if E.training_data else ()) - {"pipeline"}


def test_every_query_has_an_oracle():
    assert OWN == set(E.oracle_sql()) & OWN


@pytest.mark.parametrize("name", sorted(OWN - SLOW))
def test_oracle_fast(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name] == "OK"


@pytest.mark.skipif(not os.environ.get("STRATUM_SLOW"), reason="set STRATUM_SLOW=1")
@pytest.mark.parametrize("name", sorted(SLOW))
def test_oracle_slow(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name] == "OK"
