import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from stratum.llm import repeats


def brute(docs, match=50):
    least = {}
    texts = [(i, (t or "").encode()) for i, t in docs]
    for i, t in texts:
        for p in range(len(t) - match + 1):
            if i is not None:
                least[t[p:p + match]] = min(i, least.get(t[p:p + match], i))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - match + 1):
            if i is not None and least[t[p:p + match]] < i:
                gone[p:p + match] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), int(np.count_nonzero(np.diff(np.r_[0, gone.astype(int)]) == 1)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs):
    df = spark.createDataFrame([(t, 1, "a", i) for i, t in docs], "text string, key int, keys string, doc_id long").repartition(3)
    return sorted((tuple(r) for r in repeats.cut_repeats(df).collect()), key=str)


def corpus(n):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 9))) for _ in range(300)]
    text = lambda k: " ".join(rng.choices(words, k=k))
    common = [text(30) for _ in range(4)]
    docs = []
    for i in range(n):
        t = text(rng.randint(0, 60))
        if i % 3:
            t = t[:len(t) // 2] + rng.choice(common) + t[len(t) // 2:]
        if i % 5 == 0 and docs:
            t = rng.choice(docs)[1].replace("a", "e", 1)
        docs.append((i, t))
    return docs


def test_equals_comparing_all_strings(spark):
    docs = corpus(90)
    docs += [(500, docs[3][1]), (2, docs[3][1]), (501, None), (502, ""), (503, "short"), (None, docs[4][1]), (504, docs[4][1]), (None, None),
             (505, "x" * 3000), (506, "x" * 49), (507, "y" + "x" * 60 + "z"), (508, docs[5][1] + docs[5][1]), (-1, docs[6][1][5:90])]
    assert run(spark, docs) == brute(docs)


def test_many_segments_and_small_pieces(spark, monkeypatch):
    docs = corpus(40) + [(600 + k, "q" * k + "the passage of many documents, word for word, that all of them hold " + "r" * k) for k in range(40)]
    whole = brute(docs)
    assert run(spark, docs) == whole
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", 4)
    assert run(spark, docs) == whole
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", 8192)
    monkeypatch.setattr(repeats, "INDEXED", 500)
    assert run(spark, docs) == whole


def test_pieces_of_a_long_text(spark, monkeypatch):
    docs = [(1, corpus(60)[7][1] * 3), (2, " ".join(t for _, t in corpus(60)))]
    texts = repeats.Texts(pa.array([t.encode() for _, t in docs] + [None, b"", b"x" * 50]))
    whole = texts.segments(50)
    monkeypatch.setattr(repeats, "PIECE", 333)
    cut = texts.segments(50)
    strings = lambda s: {(t, a + k, key) for t, a, n, key in zip(*(x.tolist() for x in s)) for k in range(n)}
    assert sum(n for n in whole[2].tolist()) == sum(len(t.encode()) - 49 for _, t in docs) + 1
    assert strings(whole) == strings(cut)


def test_segments_depend_on_their_text_alone(monkeypatch):
    """Texts are read in batches that differ from step to step; a segment has to be the same in all of them."""
    texts = [t.encode() for _, t in corpus(60)] + [b"x" * 300, None, b"", b"y" * 49]
    monkeypatch.setattr(repeats, "PIECE", 333)
    together = repeats.Texts(pa.array(texts, pa.binary()))
    text, start, count, key = together.segments(50)
    found = sorted(zip(text.tolist(), (start - together.at[text]).tolist(), count.tolist(), key.tolist()))
    alone = [(i, a, n, k) for i, t in enumerate(texts) for _, a, n, k in zip(*(x.tolist() for x in repeats.Texts(pa.array([t], pa.binary())).segments(50)))]
    assert found == sorted(alone)
    monkeypatch.setattr(repeats, "PIECE", 1 << 18)
    assert [x.tolist() for x in together.segments(50)] == [x.tolist() for x in (text, start, count, key)]


def test_empty_table(spark):
    assert run(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=8), st.integers(2, 9))
def test_index_against_suffixes(texts, match):
    body = [t.encode() for t in texts]
    size = np.array([len(b) for b in body])
    index = repeats.RunLengthIndex(np.frombuffer(b"".join(body), np.uint8), size)
    joined = [(c, 0) if c else (0, k) for k, b in enumerate(body) for c in [*(x + 1 for x in b), 0]]
    suffixes = sorted(range(len(joined)), key=lambda p: joined[p:])
    assert index.order.tolist() == suffixes
    assert index.run_size.sum() == len(joined)
    found = index.matches()
    for before, p in zip(suffixes, suffixes[1:]):
        same = 0
        while joined[before + same] == joined[p + same]:
            same += 1
        assert found[p] == same
    owner = np.arange(len(texts))[::-1]
    held = {(k, o) for k, o in zip(*(x.tolist() for x in repeats.held_earlier(np.frombuffer(b"".join(body), np.uint8), size, owner, match)))}
    assert held == {(k, o) for k, b in enumerate(body) for o in range(len(b) - match + 1)
                    if any(b[o:o + match] in other for j, other in enumerate(body) if owner[j] < owner[k])}
