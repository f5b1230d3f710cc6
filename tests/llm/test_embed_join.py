"""Embedding join: links and classes against all pairs, with pivots and small blocks."""

import numpy as np
import pytest

from stratum.llm import embed_join as E

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, n_links string"


def brute(rows):
    links, root = {r[0]: set() for r in rows if r[0] is not None}, {}
    good = [(i, np.array(v, np.float64), lab) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for k, (i, x, a) in enumerate(good):
        for j, y, b in good[:k]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                links[i].add(j)
                links[j].add(i)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root[i] = min(seen)
    return {i: (len(n), root[i], root[i] == i) for i, n in links.items()}


@pytest.mark.parametrize("cell,block", [(1024, 8192), (20, 8)])
def test_links_equal_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(E, "CELL", cell)
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(260):
        centre = np.random.default_rng(i % 30).normal(size=12)
        rows.append((i, [float(x) for x in (centre + rng.normal(size=12) * 0.25).astype(np.float32)], i % 2))
    same = rows[3][1]
    rows += [(300 + k, same, 1) for k in range(40)] + [(400, [2 * x for x in same], 1), (401, None, 1), (402, [0.0] * 12, 1), (403, [float("nan")] + same[1:], 1),
             (404, [None] + same[1:], 1), (405, [float("inf")] + same[1:], 1), (406, same, None), (407, same[:6], 1), (408, [], 1), (409, same, 7)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1)], "vec_id bigint, embedding array<float>, label int")
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in E.near_duplicates(df).collect()) == [(0, 0, 0), (5, 0, 5)]
    assert E.near_duplicates(df.limit(0)).count() == 0
