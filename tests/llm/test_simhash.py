"""SimHash: keys against all pairs, fingerprints against a plain version, classes against brute force."""

import random

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from stratum.llm import simhash as S

SCHEMA = "doc_id bigint, text string, component_id string, fp bigint"


def plain_fingerprint(text, shingle=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]), 42) for i in range(max(len(words) - shingle + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_close_fingerprints_share_a_key(fp, bits):
    other = fp
    for b in bits:
        other ^= 1 << b
    keys, owner = S.keys(np.array([fp, other], np.uint64).view(np.int64))
    assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_golay_code_is_perfect():
    leaders, fours, _ = S.golay()
    weights = np.bitwise_count(leaders.astype(np.uint64))
    assert sorted(np.bincount(weights).tolist()) == sorted([1, 23, 253, 1771])
    assert ((fours != 0).sum(1) == np.where(weights == 3, 5, 0)).all()


def test_classes_equal_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "one", "One", "a b c", "é É\tx\x0by z"]
    for _ in range(25):
        base = [random.choice(vocabulary) for _ in range(random.randint(150, 400))]
        for _ in range(random.randint(1, 6)):
            own = list(base)
            for _ in range(random.randint(0, 3)):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            texts.append(" ".join(own))
    texts.append(" ".join(random.choice(vocabulary) for _ in range(30_000)))
    rows = [(i * 3 + 1, t, "other", 7) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in S.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert [got[r[0]]["fingerprint"] for r in rows] == [f"{f:016x}" for f in fps]
    assert [got[r[0]]["component_id"] for r in rows] == [rows[c][0] for c in classes(fps)]


def test_repeated_and_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(5, "x y z"), (5, "x y z"), (None, "x y z"), (None, "something else entirely here now")], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in S.near_duplicates(df).collect() if r["component_id"] is not None)
    assert got == [(0, 5), (5, 5), (5, 5)]
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_large_groups_are_dealt_out_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**62))
    fps = sorted({centre ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(300)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    monkeypatch.setattr(S, "BLOCK", 16)
    links = [(r["a"], r["b"]) for r in S.linked_fingerprints(df, 4).collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 * 300 for a, b in links)
    from stratum.llm.common import Scratch
    from stratum.llm.components import components
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark, "t")).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = classes(fps)
    groups = {}
    for s, c in zip(signed, want):
        groups.setdefault(c, []).append(s)
    for members in groups.values():
        assert {roots.get(m, m) for m in members} == {min(members)}


def test_key_rows_are_not_broadcast(spark, monkeypatch):
    """The table of fingerprints is under Spark's limit, that of their keys many times above it, some groups are large."""
    from stratum.llm.common import Scratch
    monkeypatch.setattr(S, "BLOCK", 16)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300k")
    try:
        near = spark.range(60).selectExpr("bigint(1) << id AS fp")
        fps = Scratch(spark, "t").keep(spark.range(8000).selectExpr("xxhash64(id) AS fp").union(near), "fps")
        links = S.linked_fingerprints(fps, 4)
        assert links.count() >= 59
        links.collect()
        plan = links._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" not in plan and "MapInArrow" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_components_of_chains_stars_and_loops(spark):
    from stratum.llm.common import Scratch
    from stratum.llm.components import components
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 700)]
    df = spark.createDataFrame(chain + star + [(7, 7), (None, 3), (9, 8), (8, 9)], "x bigint, y bigint")
    got = {r["node"]: r["root"] for r in components(df, Scratch(spark, "t")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 700)}, 9: 8}


def test_links_of_a_hub_are_split_over_tasks(spark):
    from stratum.llm import components as C
    from stratum.llm.common import Scratch
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.enabled": "true",
             "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        scratch = Scratch(spark, "t")
        # the hub is the smallest of its neighbours in one table, the largest in the other
        for hub, star in ((0, C._large_star), (10**9, C._small_star)):
            links = scratch.keep(spark.range(0, 200_000, 1, 8).selectExpr(f"CAST({hub} AS BIGINT) u", "id + 1 v")
                                 .union(spark.range(300_000, 320_000).selectExpr("id + 1 u", "id v")), "links")
            joined = star(links, C._least(links.union(links.select("v", "u")), scratch) if star is C._large_star else C._least(links, scratch))
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
