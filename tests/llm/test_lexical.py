import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from stratum.llm import lexical

DOCS = "doc_id long, text string, score string, item_id string, rank int"


def brute(docs, items, top=10):
    split = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), t or ""))
    tfs = [(i, Counter(split(t)), len(split(t))) for i, t in docs]
    tfs = [x for x in tfs if x[2]]
    n_all, df = sum(x[2] for x in tfs), Counter(w for x in tfs for w in x[1])
    asked, out = {}, []
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    for i, words in asked.items():
        found = []
        for doc, tf, n in tfs:
            m = 10 + 90 * n * len(tfs) // n_all
            s = sum(math.floor(1000 * math.log((2 * len(tfs) + 2) / (2 * df[w] + 1))) * (10 ** 9 * tf[w] // (1000 * tf[w] + 8 * m)) for w in words if tf[w])
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        out += [(i, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in lexical.search(d, q, **more).collect()), key=str)


def corpus(n):
    import random
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["Über", "naïve", "año"]
    return [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(63)], k=rng.randint(1, 60)))) for i in range(n)]


def test_equals_scores_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    monkeypatch.setattr(lexical, "ENTRIES", 300)
    docs = corpus(300) + [(900, None), (901, ""), (902, "..."), (7, "w1 w1 w2"), (None, "w1 w1 w2"), (903, "w3 " * 30_000)]
    items = [(1, "w1 w2 W3!"), (2, "über naïve; naïve"), (3, None), (4, "absent"), (5, "w40 w41 w0"), (5, "w9"), (6, " ".join(f"w{k}" for k in range(60)))]
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_queries_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_TERMS", 3)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 50)
    docs, items = corpus(80), [(k, f"w{k} w{k + 5} w1") for k in range(12)]
    assert run(spark, docs, items) == brute(docs, items)


def test_equal_scores_by_id_and_empty_tables(spark):
    docs = [(k, "same words") for k in range(25, 0, -1)] + [(99, "other"), (98, "more")] + [(100 + k, "filler") for k in range(40)]
    assert [r[2] for r in sorted(run(spark, docs, [(1, "same")]), key=lambda r: r[1])] == list(range(1, 11))
    assert run(spark, [], [(1, "same")]) == [] and run(spark, docs, []) == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=8), min_size=1, max_size=60), st.sets(st.integers(0, 12), min_size=1))
def test_no_better_document_is_skipped(lists, query):
    import numpy as np
    lexical_block, lexical.BLOCK = lexical.BLOCK, 3
    try:
        gains = [{t: 1 + (t * 7 + len(own) * 3) % 11 for t in own} for own in lists]
        shard = lexical.Shard(np.array([len(g) for g in gains], np.int64), np.array([t for g in gains for t in g], np.int64),
                              np.array([v for g in gains for v in g.values()], np.int64), 13,
                              lexical.partners([np.array(sorted(query)), np.arange(5)]))
        rows, scores = shard.search(np.array(sorted(query)), np.arange(len(gains)), 5)
    finally:
        lexical.BLOCK = lexical_block
    whole = sorted(((-sum(g.get(t, 0) for t in query), k) for k, g in enumerate(gains)))
    assert [(-s, k) for k, s in zip(rows.tolist(), scores.tolist())] == [w for w in whole if w[0] < 0][:5]


def test_blocks_are_left_out(spark):
    import numpy as np
    scored = []
    rng = np.random.default_rng(0)
    size = np.full(2000, 3, np.int64)
    term = np.concatenate([rng.choice(20, 3, False) for _ in size])
    shard = lexical.Shard(size, term, rng.integers(1, 1_000_000, len(term)) ** 2, 20, lexical.partners([np.array([3])]))
    shard.scores = lambda docs, asked: (scored.append(len(docs)), lexical.Shard.scores(shard, docs, asked))[1]
    shard.search(np.array([3]), np.arange(2000), 10)
    assert 10 <= sum(scored) < np.count_nonzero(term == 3)


@pytest.mark.parametrize("text, found", [("Ab-c_D 1x", ["ab", "c", "d", "1x"]), ("É é", ["É é"]), ("...", [])])
def test_terms(text, found):
    assert lexical.terms(text) == found
