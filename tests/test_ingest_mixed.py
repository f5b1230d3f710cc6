"""Files of different schemas: one run over all of them and a run for each give the same rows."""

import json

import pytest

from stratum.sources import ingest as ing
from tests.conftest import rows


def put(spark, fmt, path, data):
    if fmt == "parquet":
        rows_, schema = data
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(path)
    else:
        spark.createDataFrame([(x,) for x in data], "v string").coalesce(1).write.mode("append").text(path)


FEEDS = {
    "parquet": [([(1, "x"), (2, "y")], "a int, b string"), ([(3, 5_000_000_000), (4, 7)], "b int, a long"), ([("z", 1.5)], "A string, c double"), ([(9.0,), (9.5,)], "a double")],
    "csv": [["a,b", "1,2", "3,4"], ["b,a", "x,5", "6,y"], ["A,c", "7,8"]],
}


@pytest.mark.parametrize("fmt", FEEDS)
def test_one_run_and_several(spark, scratch, fmt):
    found = []
    for several in (False, True):
        spec = ing.FeedSpec(f"{scratch}/{fmt}{several}/in", f"{scratch}/{fmt}{several}/out", f"{scratch}/{fmt}{several}/ck", fmt=fmt)
        for k, data in enumerate(FEEDS[fmt]):
            put(spark, fmt, f"{spec.source_path}/part={k}", data)
            if several:
                ing.ingest(spark, spec)
        ing.ingest(spark, spec)
        b = ing.read_bronze(spark, spec.target_path)
        found.append((sorted((f.name, f.dataType.simpleString()) for f in b.schema.fields), rows(b, "a", "b", "c", ing.RESCUED)))
    assert found[0] == found[1]
    if fmt == "parquet":
        got = {(r[0], r[3]) for r in found[0][1]}
        assert (None, '{"a":"5000000000"}') in got and (9, None) in got and (None, '{"a":"9.5"}') in got and (None, '{"A":"z"}') in got


def test_keys_that_differ_in_case(spark, scratch):
    spec = ing.FeedSpec(f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck", fmt="json")
    put(spark, "json", spec.source_path, [json.dumps(x) for x in ({"k": 1, "a": 1}, {"k": 2, "A": 2}, {"k": 3, "a": 3, "A": 4}, {"k": 4, "a": 5, "A": 5})])
    ing.ingest(spark, spec)
    put(spark, "json", spec.source_path, ['{"k": 5, "a": 6, "K": 7}'])
    ing.ingest(spark, spec)
    b = ing.read_bronze(spark, spec.target_path)
    assert rows(b, "k", "a", ing.RESCUED) == [(1, 1, None), (2, 2, None), (3, 4, '{"a":"3"}'), (4, 5, None), (5, 6, '{"K":"7"}')]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
