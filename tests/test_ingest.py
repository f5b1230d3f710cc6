"""Two-run ingest tests: each file once, new columns, type drift, CSV headers, lineage."""

import json
import os

from pyspark.sql import functions as F

from stratum.sources import ingest as ing
from tests.conftest import rows


def _put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)


def _spec(root, fmt):
    return ing.FeedSpec(f"{root}/in", f"{root}/bronze", f"{root}/ckpt", fmt=fmt)


def test_json_each_file_once_new_column_and_type_drift(spark, scratch):
    spec = _spec(scratch, "json")
    m1 = f"{spec.source_path}/extraction_month=2024-01"
    _put(m1, "a.json", json.dumps({"id": 1, "amount": 10}) + "\n" + json.dumps({"id": 2, "amount": 11}) + "\n")
    r1 = ing.ingest(spark, spec)
    assert (r1.batches, r1.files) == (1, 1)
    r0 = ing.ingest(spark, spec)                       # second run, no new file
    assert (r0.batches, r0.files) == (0, 0)
    m2 = f"{spec.source_path}/extraction_month=2024-02"
    _put(m2, "a.json", json.dumps({"id": 3, "amount": 1.5, "note": "x"}) + "\n")   # same name, new month
    r2 = ing.ingest(spark, spec)
    assert r2.files == 1
    assert [f.name for f in r2.schema.fields] == ["amount", "id", "note"]
    assert r2.schema["amount"].dataType.simpleString() == "bigint"                 # type never changes
    b = ing.read_bronze(spark, spec.target_path)
    got = rows(b, "id", "amount", "note", "_rescued", "extraction_month", "_source_file_name")
    assert got == [(1, 10, None, None, "2024-01", "a.json"), (2, 11, None, None, "2024-01", "a.json"),
                   (3, None, "x", '{"amount":"1.5"}', "2024-02", "a.json")]
    assert b.where(F.col("_processing_timestamp").isNull()).count() == 0


def test_csv_headers_reordered_extra_and_empty_values(spark, scratch):
    spec = _spec(scratch, "csv")
    m = f"{spec.source_path}/extraction_month=2024-01"
    _put(m, "one.csv", "id,name,score\n1,ann,5\n2,,6\n")
    _put(m, "two.csv", "score,id,name,extra\n7,3,cat,e\n")
    ing.ingest(spark, spec)
    b = ing.read_bronze(spark, spec.target_path)
    assert rows(b, "id", "name", "score", "extra") == [(1, "ann", 5, None), (2, None, 6, None), (3, "cat", 7, "e")]


def test_parquet_second_month_adds_column(spark, scratch):
    spec = _spec(scratch, "parquet")
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(
        f"{spec.source_path}/extraction_month=2024-01")
    ing.ingest(spark, spec)
    spark.createDataFrame([(2, "b", 9.5)], "id int, v string, w double").write.parquet(
        f"{spec.source_path}/extraction_month=2024-02")
    ing.ingest(spark, spec)
    b = ing.read_bronze(spark, spec.target_path)
    assert rows(b, "id", "v", "w", "extraction_month") == [(1, "a", None, "2024-01"), (2, "b", 9.5, "2024-02")]


def test_every_ending_is_read_and_nested_fields_evolve(spark, scratch):
    import gzip
    import json
    import os
    src = f"{scratch}/in"
    os.makedirs(src)

    def put(name, *objects):
        text = "\n".join(map(json.dumps, objects))
        with (gzip.open(f"{src}/{name}", "wt") if name.endswith(".gz") else open(f"{src}/{name}", "w")) as f:
            f.write(text)

    spec = ing.FeedSpec(src, f"{scratch}/out", f"{scratch}/ckpt", fmt="json")
    put("a.json", {"id": 1, "s": {"x": 1}, "l": [{"p": 1}]})
    put("b.json.gz", {"id": 2, "s": {"x": 2}, "l": []})
    put("c.jsonl", {"id": 3, "s": None, "l": None})
    put("_hidden.json", {"id": 99})
    ing.ingest(spark, spec)
    put("d", {"id": 4, "s": {"x": 4, "y": "new"}, "l": [{"p": 4, "q": True}]})
    put("e.txt", {"id": 5, "s": {"x": "five"}, "l": [{"p": "text"}]})
    ing.ingest(spark, spec)
    out = {r["id"]: r for r in ing.read_bronze(spark, spec.target_path).select("id", "s", "l", ing.RESCUED).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    assert out[4]["s"]["y"] == "new" and out[4]["l"][0]["q"] is True and out[4]["s"]["x"] == 4
    assert out[1]["s"]["x"] == 1 and out[1]["s"]["y"] is None and out[3]["s"] is None
    assert out[5]["s"]["x"] is None and "five" in out[5][ing.RESCUED] and "text" in out[5][ing.RESCUED]
    assert out[1][ing.RESCUED] is None


def test_compressed_csv_with_reordered_headers(spark, scratch):
    import gzip
    import os
    src = f"{scratch}/in"
    os.makedirs(src)
    for name, text in (("a.csv", "id,v\n1,x\n"), ("b.csv.gz", "v,id,w\ny,2,7\n"), ("c.txt", "id,v\n3,z\n")):
        with (gzip.open(f"{src}/{name}", "wt") if name.endswith(".gz") else open(f"{src}/{name}", "w")) as f:
            f.write(text)
    spec = ing.FeedSpec(src, f"{scratch}/out", f"{scratch}/ckpt", fmt="csv")
    ing.ingest(spark, spec)
    assert rows(ing.read_bronze(spark, spec.target_path), "id", "v", "w") == [(1, "x", None), (2, "y", 7), (3, "z", None)]
