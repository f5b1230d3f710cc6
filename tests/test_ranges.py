"""Ranges of hot groups and prefix counts."""

import pytest
from pyspark.sql import functions as F

from stratum.operators import cdc
from stratum.operators.ranges import BEFORE, BUCKET, hot_keys, prefix_counts
from stratum.operators.rank import percent_rank_global
from tests.conftest import rows

LIMIT = 500


def _burst(spark):
    """20,000 events: one in twenty belongs to 'hot' and all those lie within a millisecond of a day of
    even traffic; 'even' holds a fifth, spread over the day; the rest is spread over 400 keys."""
    return spark.range(20000).selectExpr(
        "CASE WHEN id % 20 = 0 THEN 'hot' WHEN id % 5 = 1 THEN 'even' ELSE concat('k', id % 400) END AS k",
        "CASE WHEN id % 20 = 0 THEN 43200000000 + id div 20 ELSE id * 4320000 END AS s", "id AS v")


@pytest.mark.parametrize("order", ["s", "concat('2024-01-01T00:00:', lpad(s, 20, '0'))", "struct(s div 1000000, v)"],
                         ids=["number", "long common prefix", "struct"])
def test_ranges_hold_at_most_twice_the_limit_in_a_burst(spark, order):
    df = _burst(spark).withColumn("o", F.expr(order))
    hot = hot_keys(df, ["k"], LIMIT)
    assert len(hot.hashes) == 2
    got = hot.ranges(F.col("o"), task_rows=700).of(df, F.col("o"), "r")
    sizes = got.groupBy("k", "r").agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"))
    assert sizes.agg(F.max("n")).first()[0] <= 2 * LIMIT
    assert rows(sizes.groupBy("k").agg(F.max("r").alias("r")).where("r > 0")) == [("even", 7), ("hot", 1)]
    a, b = sizes.alias("a"), sizes.alias("b")             # a later range begins above an earlier one
    assert a.join(b, F.expr("a.k = b.k AND a.r < b.r AND a.hi >= b.lo")).count() == 0
    assert got.columns == df.columns + ["r"] and got.count() == 20000


def test_no_hot_key_or_no_rows_means_no_ranges(spark):
    df = _burst(spark)
    assert hot_keys(df, ["k"], 5000) is None
    assert hot_keys(df, ["k"]) is None                    # fewer rows than the session's limit
    assert hot_keys(df.where("false"), ["k"], 0) is None


def test_null_orders_and_keys_ties_and_one_value(spark):
    df = spark.createDataFrame([(None, None)] * 5 + [(None, i) for i in range(10)] + [("t", 1)] * 20, "k string, s int")
    got = hot_keys(df, ["k"], 4).ranges(F.col("s")).of(df, F.col("s"), "r")
    by_key = {}
    for k, s, r in got.collect():
        by_key.setdefault(k, set()).add((s, r))
    assert by_key["t"] == {(1, 0)}                        # one value is never cut
    assert len(by_key[None]) == 11 and (None, 0) in by_key[None]
    # rows before: 0 of NULL, then 5 to 14; a range starts where that passes a multiple of 4
    assert by_key[None] == {(None, 0)} | {(i, (5 + i) // 4) for i in range(10)}


@pytest.mark.parametrize("partial", [False, True])
def test_scd2_of_a_burst_equals_the_plain_plan(spark, partial):
    df = _burst(spark).selectExpr("k", "s", "CASE WHEN v % 3 > 0 THEN v END AS v", "CASE WHEN v % 700 = 0 THEN 'x' END AS w")
    text = df.withColumn("s", F.concat(F.lit("2024-01-01T00:00:"), F.lpad(F.col("s").cast("string"), 20, "0")))
    for events in (df, text):
        plain, cut = (cdc.scd2(events, "k", "s", partial=partial, **kw) for kw in ({}, {"chunks": 2, "hot_rows": 130}))
        assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_prefix_counts_equal_plain_sums(spark, n):
    counts = spark.range(n).selectExpr("CASE WHEN id > 0 THEN hash(id) END AS x", "id % 3 + 1 AS c").groupBy("x").agg(F.sum("c").alias("c"))
    got = prefix_counts(counts, [], "x", "c", task_rows=1000)
    want = sorted((r.x is not None, r.x, r.c) for r in counts.collect())
    before, at = {}, 0
    for _, x, c in want:
        before[x] = at
        at += c
    assert {r.x: r[BEFORE] for r in got.collect()} == before
    assert BUCKET not in got.columns


def test_buckets_grow_with_the_values(spark, monkeypatch):
    from stratum.operators import ranges
    written = []
    monkeypatch.setattr(ranges, "materialize", lambda df, name, real=ranges.materialize: written.append(real(df, name)) or written[-1])
    for n in (3_000, 30_000):
        written.clear()
        prefix_counts(spark.range(n).selectExpr("id * 7 % 10007 + id * 100000 AS x", "1L AS c"), [], "x", "c", task_rows=1000)
        sizes = [r["count"] for r in written[-1].groupBy(BUCKET).count().collect()]
        assert max(sizes) <= 2000 and n // 1000 - 2 <= len(sizes) <= n // 1000


def test_percent_rank_of_many_nulls_and_buckets(spark):
    from pyspark.sql import Window
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN id * 37 % 501 END AS x")
    want = df.withColumn("pr", F.percent_rank().over(Window.orderBy("x")))
    assert rows(percent_rank_global(df, "x", "pr", task_rows=40)) == rows(want)
