"""SCD1 / SCD2 semantics on hand-written change logs, plus SCD2 invariants."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators import cdc
from tests.conftest import rows

T = lambda d: dt.datetime(2024, 1, d)
SCHEMA = "k string, seq timestamp_ntz, a string, b int"


def test_scd2_orders_by_sequence_not_arrival(spark):
    # arrival order: v3, v1, late v2 between them, late v0 before the first
    ev = spark.createDataFrame([("x", T(5), "v3", 3), ("x", T(1), "v1", 1),
                                ("x", T(3), "v2", 2), ("x", T(0 + 1) - dt.timedelta(days=1), "v0", 0)], SCHEMA)
    h = cdc.scd2(ev, "k", "seq", except_cols=["seq"])
    assert h.columns == ["k", "a", "b", "__START_AT", "__END_AT"]
    assert rows(h, "a", "__START_AT", "__END_AT") == [
        ("v0", dt.datetime(2023, 12, 31), T(1)), ("v1", T(1), T(3)),
        ("v2", T(3), T(5)), ("v3", T(5), None)]


def test_scd2_partial_update_carries_last_non_null(spark):
    ev = spark.createDataFrame([("x", T(1), "a1", 1), ("x", T(2), None, 2),
                                ("x", T(3), "a3", None), ("x", T(4), None, None)], SCHEMA)
    h = cdc.scd2(ev, "k", "seq", partial=True, except_cols=["seq"])
    assert rows(h, "__START_AT", "a", "b") == [(T(1), "a1", 1), (T(2), "a1", 2),
                                               (T(3), "a3", 2), (T(4), "a3", 2)]


def test_scd2_same_key_and_sequence_collapse(spark):
    ev = spark.createDataFrame([("x", T(1), "a", 1), ("x", T(1), "b", 0), ("x", T(2), "c", 5)], SCHEMA)
    full = cdc.scd2(ev, "k", "seq", except_cols=["seq"])
    assert rows(full, "__START_AT", "a", "b") == [(T(1), "b", 0), (T(2), "c", 5)]  # greatest tuple
    part = cdc.scd2(ev, "k", "seq", partial=True, except_cols=["seq"])
    assert rows(part, "__START_AT", "a", "b") == [(T(1), "b", 0), (T(2), "c", 5)]  # one common order


def test_null_key_or_sequence_set_aside(spark):
    ev = spark.createDataFrame([("x", T(1), "a", 1), (None, T(1), "n", 1), ("y", None, "s", 1)], SCHEMA)
    assert cdc.scd2(ev, "k", "seq").count() == 1
    assert rows(cdc.invalid_events(ev, "k", "seq"), "a") == [("n",), ("s",)]


def test_composite_key(spark):
    ev = spark.createDataFrame([("x", T(1), "p", 1), ("x", T(2), "q", 1), ("x", T(3), "p", 2)], SCHEMA)
    h = cdc.scd2(ev, ["k", "b"], "seq", except_cols=["seq"])
    assert rows(h, "b", "a", "__END_AT") == [(1, "p", T(2)), (1, "q", None), (2, "p", None)]


def test_scd1_latest_wins(spark):
    ev = spark.createDataFrame([("x", T(2), "new", 2), ("x", T(1), "old", 1), ("y", T(1), "y1", 1)], SCHEMA)
    assert rows(cdc.scd1(ev, "k", "seq"), "k", "a", "b") == [("x", "new", 2), ("y", "y1", 1)]


def _random_log(seed, n_keys, n_events):
    rnd = random.Random(seed)
    out = []
    for _ in range(n_events):
        k = f"k{rnd.randrange(n_keys)}"
        out.append((k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(200)),
                    rnd.choice(["a", "b", None]), rnd.choice([1, 2, None])))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), partial=st.booleans())
def test_scd2_invariants_and_chunk_independence(spark, seed, partial):
    data = _random_log(seed, 4, 60)
    ev = spark.createDataFrame(data, SCHEMA)
    plain = cdc.scd2(ev, "k", "seq", partial=partial, chunks=1)
    chunked = cdc.scd2(ev, "k", "seq", partial=partial, chunks=5, hot_rows=0)
    shuffled = cdc.scd2(spark.createDataFrame(random.Random(seed).sample(data, len(data)), SCHEMA),
                        "k", "seq", partial=partial, chunks=3, hot_rows=0)
    p = rows(plain)
    assert p == rows(chunked) == rows(shuffled)
    by_key = {}
    for r in plain.collect():
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["__START_AT"])
        assert sum(v["__END_AT"] is None for v in versions) == 1          # one open version
        for a, b in zip(versions, versions[1:]):
            assert a["__END_AT"] == b["__START_AT"]                      # contiguous, disjoint
    assert len(p) == len({(k, s) for k, s, _, _ in data})


def test_chunked_scd2_splits_a_hot_key(spark):
    # one key owns most events: with chunks the scan runs per (key, range)
    data = [("hot", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), str(i % 3), i) for i in range(400)]
    data += [(f"c{i}", dt.datetime(2024, 1, 2), "x", i) for i in range(50)]
    ev = spark.createDataFrame(data, SCHEMA)
    a = cdc.scd2(ev, "k", "seq", chunks=1)
    b = cdc.scd2(ev, "k", "seq", chunks=16, hot_rows=0)
    assert rows(a) == rows(cdc.scd2(ev, "k", "seq", chunks=16, hot_rows=100))   # 400 > 100: split
    assert rows(a) == rows(cdc.scd2(ev, "k", "seq", chunks=16))                 # small: plain
    assert rows(a) == rows(b)
    splits = cdc.sequence_splits(ev, "seq", 16)
    assert len(splits) >= 8


def test_text_and_struct_sequences_split_like_plain(spark):
    import random
    random.seed(3)
    data = [(random.choice(["k", "k", "k", "x"]), f"{random.randrange(300):05d}" + random.choice(["", "a", "é"]), i) for i in range(200)]
    df = spark.createDataFrame(data, "id string, seq string, v int")
    nested = df.selectExpr("id", "named_struct('a', seq, 'b', v) AS seq", "v")
    for events in (df, nested):
        plain = cdc.scd2(events, "id", "seq").selectExpr("to_json(struct(*)) AS j")
        split = cdc.scd2(events, "id", "seq", chunks=4, hot_rows=0).selectExpr("to_json(struct(*)) AS j")
        assert rows(plain) == rows(split)


def test_partial_ties_take_one_common_order(spark):
    df = spark.createDataFrame([("k", 5, "a", 9), ("k", 5, "b", 1), ("j", 5, "a", 9), ("j", 5, "b", None), ("k", 6, None, 2)], "id string, seq int, x string, y int")
    for kw in ({}, {"chunks": 3, "hot_rows": 0}):
        out = cdc.scd2(df, "id", "seq", partial=True, **kw)
        assert rows(out, "id", "x", "y", cdc.START_AT) == [("j", "b", 9, 5), ("k", "b", 1, 5), ("k", "b", 2, 6)]


def test_scd2_partial_of_clustered_events_makes_no_other_shuffle(spark):
    ev = spark.createDataFrame([("x", T(1), "a1", 1), ("x", T(2), None, 2), ("y", T(2), "b", None), ("x", T(2), "a2", None), ("y", T(1), None, 7)], SCHEMA)
    build = lambda clustered: cdc.scd2(ev.repartition(3, "k"), "k", "seq", partial=True, except_cols=["seq"], clustered=clustered)
    assert rows(build(True)) == rows(build(False))
    plan = build(True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
