"""Month landing: sparse months, ceilings, explicit months, failed months, hidden names."""

import os

from stratum.plans import landing
from tests.conftest import rows


def _vault(spark, root):
    v = f"{root}/vault"
    for table, months in (("a", ["2020-01", "2020-02", "2020-03"]), ("b", ["2020-01", "2020-03"])):
        for m in months:
            spark.createDataFrame([(1, m)], "x int, m string").coalesce(1).write.parquet(
                f"{v}/s/{table}/extraction_month={m}")
    os.makedirs(f"{v}/s/a/extraction_month=2020-02/.hidden", exist_ok=True)
    with open(f"{v}/s/a/extraction_month=2020-02/_SUCCESS_marker", "w") as fh:
        fh.write("x")
    return landing.LandingConfig(v, f"{root}/incoming", f"{root}/tracker")


def test_month_selection_and_release(spark, scratch):
    cfg = _vault(spark, scratch)
    inv = landing.inventory(spark, cfg.vault)
    assert rows(inv.select("table_name", "month").distinct()) == [("a", "2020-01"), ("a", "2020-02"), ("a", "2020-03"),
                                                ("b", "2020-01"), ("b", "2020-03")]    # `_` / `.` skipped
    assert landing.run(spark, cfg) == ["2020-01"]                      # first run: first month
    assert landing.run(spark, cfg, up_to="2020-02") == ["2020-02"]     # up to a ceiling
    t = {r.simulation_month: r for r in landing.read_tracker(spark, cfg).collect()}
    assert (t["2020-02"].tables_with_files, t["2020-02"].tables_skipped) == (1, 1)   # sparse month: skip
    assert t["2020-02"].status == "success"
    assert landing.run(spark, cfg, up_to="2020-02") == []              # nothing left below the ceiling
    assert landing.run(spark, cfg, specific="2020-01") == ["2020-01"]  # explicit month, no done-check
    assert landing.read_tracker(spark, cfg).count() == 2               # the last attempt is the month's row
    assert rows(landing.tracker_attempts(spark, cfg), "simulation_month", "attempt") == [("2020-01", 1), ("2020-01", 2), ("2020-02", 1)]
    assert landing.run(spark, cfg) == ["2020-03"]
    assert landing.run(spark, cfg) == []                               # everything released
    inc = spark.read.parquet(f"{cfg.incoming}/s/b")
    assert rows(inc, "m") == [("2020-01",), ("2020-03",)]
    ov = landing.tracker_overview(spark, cfg).first()
    assert (ov.months_processed, ov.first_month, ov.latest_month, ov.successful_runs) == (3, "2020-01", "2020-03", 3)
    assert landing.tracker_history(spark, cfg, limit=2).count() == 2
    assert rows(landing.dry_run_listing(inv), "table_name", "months", "first_month", "last_month") == [
        ("a", 3, "2020-01", "2020-03"), ("b", 2, "2020-01", "2020-03")]


def test_failed_month_is_not_retried_by_default(spark, scratch):
    cfg = _vault(spark, scratch)
    landing.run(spark, cfg)
    rows_ = landing.read_tracker(spark, cfg).collect()
    failed = spark.createDataFrame([(r.simulation_month, r.total_tables_found, r.tables_with_files,
                                     r.tables_skipped, 0, 0, r.last_updated, "failed") for r in rows_]
                                   + [("2020-02", 2, 1, 1, 0, 0, rows_[0].last_updated, "failed")],
                                   landing.TRACKER_SCHEMA)
    failed.coalesce(1).write.mode("overwrite").partitionBy("simulation_month").parquet(cfg.tracker)
    assert landing.last_processed(spark, cfg) == "2020-02"              # MAX whatever the status
    assert landing.last_processed(spark, cfg, only_success=True) is None
    landing.reset_month(spark, cfg, "2020-02")
    assert landing.last_processed(spark, cfg) == "2020-01"
    landing.restart(spark, cfg)
    assert landing.last_processed(spark, cfg) is None


def _block(cfg, table, month):
    """A file where the month's folder should be: nothing can be copied there."""
    folder = f"{cfg.incoming}/s/{table}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/extraction_month={month}", "w") as f:
        f.write("x")


def test_month_status_partial_and_failed(spark, scratch):
    cfg = _vault(spark, scratch)
    _block(cfg, "b", "2020-01")
    _block(cfg, "a", "2020-02")
    landing.run(spark, cfg, up_to="2020-02")
    t = {r.simulation_month: r for r in landing.read_tracker(spark, cfg).collect()}
    assert t["2020-01"].status == "partial" and t["2020-01"].total_files_transferred == 1     # table a moved, table b failed
    assert t["2020-02"].status == "failed" and t["2020-02"].total_files_transferred == 0


def test_unreadable_content_is_delivered_as_it_is(spark, scratch):
    cfg = _vault(spark, scratch)
    with open(f"{cfg.vault}/s/b/extraction_month=2020-01/broken.parquet", "w") as fh:
        fh.write("not parquet")
    landing.run(spark, cfg, specific="2020-01")
    assert landing.read_tracker(spark, cfg).first().status == "success"
    assert _bytes(f"{cfg.incoming}/s/b/extraction_month=2020-01") == _bytes(f"{cfg.vault}/s/b/extraction_month=2020-01")


def _bytes(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read()
            for d, _, names in os.walk(root) for f in names if f[0] not in "._"}


def test_release_is_byte_for_byte_and_takes_late_files(spark, scratch):
    import gzip
    v = f"{scratch}/vault/s"
    for m, head in (("2020-01", "a,b"), ("2020-02", "b,a,c")):
        os.makedirs(f"{v}/csv/extraction_month={m}")
        with open(f"{v}/csv/extraction_month={m}/x.csv", "w") as f:
            f.write(f"{head}\n1,x,2\n")
    os.makedirs(f"{v}/json/extraction_month=2020-01")
    with gzip.open(f"{v}/json/extraction_month=2020-01/x.json.gz", "wt") as f:
        f.write('{"a": null}\n')
    spark.range(3).coalesce(1).write.parquet(f"{v}/p/extraction_month=2020-01")
    spark.range(3).selectExpr("id", "id * 2 AS b").coalesce(1).write.parquet(f"{v}/p/extraction_month=2020-02")
    cfg = landing.LandingConfig(f"{scratch}/vault", f"{scratch}/incoming", f"{scratch}/tracker")
    landing.run(spark, cfg, up_to="2020-02")
    assert _bytes(cfg.incoming) == _bytes(cfg.vault)
    with open(f"{v}/csv/extraction_month=2020-01/late.csv", "w") as f:
        f.write("a,b\n9,9\n")
    kept = {p: os.stat(f"{cfg.incoming}/{p}").st_mtime_ns for p in _bytes(cfg.incoming)}
    landing.run(spark, cfg, specific="2020-01")
    assert _bytes(cfg.incoming) == _bytes(cfg.vault)
    assert all(os.stat(f"{cfg.incoming}/{p}").st_mtime_ns == t for p, t in kept.items())     # nothing is copied twice
    month = landing.read_tracker(spark, cfg).where("simulation_month = '2020-01'").first()
    assert (month.total_files_transferred, month.status) == (4, "success")
    assert month.total_bytes_transferred == sum(len(b) for p, b in _bytes(cfg.vault).items() if "2020-01" in p)


def test_one_bad_file_fails_alone(spark, scratch):
    cfg = _vault(spark, scratch)
    blocked = f"{cfg.incoming}/s/a/extraction_month=2020-02"
    os.makedirs(os.path.dirname(blocked))
    with open(blocked, "w") as f:                   # a file where the month's folder should be
        f.write("x")
    landing.run(spark, cfg, up_to="2020-03")
    assert {r.simulation_month: r.status for r in landing.read_tracker(spark, cfg).collect()} == {
        "2020-01": "success", "2020-02": "failed", "2020-03": "success"}
    errors = landing.read_errors(spark, cfg).collect()
    assert [(e.month, e.table_name) for e in errors] == [("2020-02", "a")] and errors[0].error
    os.remove(blocked)
    landing.run(spark, cfg, specific="2020-02")
    assert landing.read_errors(spark, cfg).count() == 0
    assert _bytes(cfg.incoming) == {p: b for p, b in _bytes(cfg.vault).items()}


def test_corrected_file_of_equal_size_replaces_the_first(spark, scratch):
    folder = "s/t/extraction_month=2020-01"
    cfg = landing.LandingConfig(f"{scratch}/vault", f"{scratch}/incoming", f"{scratch}/tracker")
    os.makedirs(f"{cfg.vault}/{folder}")

    def put(text, at):
        with open(f"{cfg.vault}/{folder}/a.csv", "w") as f:
            f.write(text)
        os.utime(f"{cfg.vault}/{folder}/a.csv", (at, at))

    for text, at in (("x\n1\n", 1000), ("x\n2\n", 2000), ("x\n1\n", 1000)):      # the last one takes the correction back
        put(text, at)
        landing.run(spark, cfg, specific="2020-01")
        assert _bytes(cfg.incoming) == _bytes(cfg.vault)
    kept = os.stat(f"{cfg.incoming}/{folder}/a.csv").st_mtime_ns
    landing.run(spark, cfg, specific="2020-01")
    assert os.stat(f"{cfg.incoming}/{folder}/a.csv").st_mtime_ns == kept
    assert landing.superseded(spark, cfg).count() == 2
    os.remove(f"{cfg.incoming}/{folder}/a.csv")             # what no longer lies there is delivered again
    landing.run(spark, cfg, specific="2020-01")
    assert _bytes(cfg.incoming) == _bytes(cfg.vault) and landing.superseded(spark, cfg).count() == 2


def test_run_lost_before_its_records_is_made_good(spark, scratch, monkeypatch):
    cfg = _vault(spark, scratch)
    append = landing._append
    for lost_at in (cfg.manifest, cfg.errors, cfg.tracker):
        def lose(frame, path, month):
            if path == lost_at:
                raise RuntimeError(path)
            append(frame, path, month)
        monkeypatch.setattr(landing, "_append", lose)
        try:
            landing.run(spark, cfg, specific="2020-01")
            assert False
        except RuntimeError:
            pass
    monkeypatch.setattr(landing, "_append", append)
    assert landing.read_tracker(spark, cfg).count() == 0
    landing.run(spark, cfg)
    assert rows(landing.tracker_attempts(spark, cfg), "simulation_month", "attempt", "status") == [("2020-01", 1, "success")]
    assert _bytes(cfg.incoming) == {p: b for p, b in _bytes(cfg.vault).items() if "2020-01" in p}
    assert landing.superseded(spark, cfg).count() == 0


def test_unreadable_tracker_is_an_error(spark, scratch):
    import pytest
    cfg = _vault(spark, scratch)
    os.makedirs(f"{cfg.tracker}/simulation_month=2020-01")
    with open(f"{cfg.tracker}/simulation_month=2020-01/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        landing.last_processed(spark, cfg)
