"""Toxicity: marginals against enumeration, spans, edge cases, held-out quality."""

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from stratum.llm import toxicity as T
from stratum.llm.common import id_remainder, table

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    scores, a = rng.normal(size=7), rng.normal(size=(2, 2))
    chain = T.Chain.of(np.array([7]))
    got, expected, log_z = chain.marginals(scores, a, counts=True)
    total, ones, pairs = 0.0, np.zeros(7), np.zeros((2, 2))
    for tags in product((0, 1), repeat=7):
        w = np.exp(sum(s for s, t in zip(scores, tags) if t) + sum(a[x, y] for x, y in zip(tags, tags[1:]))) / 2
        total += w
        ones += w * np.array(tags)
        for x, y in zip(tags, tags[1:]):
            pairs[x, y] += w
    assert np.allclose(got, ones / total)
    assert np.allclose(expected, pairs / total)
    assert np.isclose(log_z, np.log(total))


def test_windows_are_independent_of_the_batch():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(2, 2))
    parts = [rng.normal(size=n) for n in (3, 0, T.WINDOW, T.WINDOW + 5, 1)]
    together = T.Chain.of(np.array([len(p) for p in parts])).marginals(np.concatenate(parts), a)
    alone = np.concatenate([T.Chain.of(np.array([len(p)])).marginals(p, a) for p in parts if len(p)])
    assert np.allclose(together, alone)


def test_overlapping_windows_give_the_marginals_of_the_whole_chain(monkeypatch):
    rng = np.random.default_rng(4)
    a, lengths = rng.normal(size=(2, 2)), np.array([3, 0, T.WINDOW, T.WINDOW + 1, 5 * T.WINDOW + 7, 1, 2 * T.MARGIN])
    scores = rng.normal(size=lengths.sum())
    words, size, place = T.overlapping(lengths)
    assert size.max() <= T.WINDOW and (words[place] == np.arange(lengths.sum())).all()
    got = T.Chain.of(size).marginals(scores[words], a)[place]
    monkeypatch.setattr(T, "WINDOW", 6 * T.WINDOW)
    assert np.allclose(got, T.Chain.of(lengths).marginals(scores, a), atol=1e-6)


def test_a_word_is_scored_alike_wherever_it_stands():
    tagger = T.Tagger({"=bad": 4.0}, -2.0, np.array([[0.5, -1.0], [-1.0, 1.5]]), 0.01, np.ones(T.EVIDENCE + 1))
    for at in (100, T.WINDOW - 2, T.WINDOW - 1, T.WINDOW, 400):
        text = " ".join(["fine"] * at + ["bad", "bad", "so", "bad"] + ["fine"] * 300)
        (_, m, _), = tagger.evidence([text], tagger.scorer())
        assert np.allclose(m[at - 5:at + 9], FIRST if at > 100 else (FIRST := m[at - 5:at + 9]), atol=1e-6)


def test_repeated_rows_and_very_long_texts():
    tagger = T.Tagger({"=bad": 6.0}, -3.0, np.zeros((2, 2)), 0.01, np.ones(T.EVIDENCE + 1))
    text = "fine " * 300_000 + "bad"
    out = tagger.predict([text, "bad", text, "bad"], tagger.scorer(), 0.7)
    assert out.score[0] == out.score[2] and out.score[1] == out.score[3] and [s["start"] for s in out.spans[0]] == [1_500_000]


def test_spans_are_code_point_offsets():
    text = "é bad  worse ok\tbad"
    spans = T._spans(text, np.array([0.1, 0.9, 0.8, 0.2, 0.7]))
    assert [text[s["start"]:s["end"]] for s in spans] == ["bad  worse", "bad"]


def test_marker_of_one_spelling_has_weight_and_span():
    """Every document writes 'zork' the same way; no other word shares a prefix with it."""
    rng = np.random.default_rng(3)
    plain = [f"w{i}x" for i in range(40)]
    texts = [" ".join(rng.choice(plain, 30)) for _ in range(60)]
    toxic = np.array([i % 2 for i in range(60)])
    texts = [f"{t} zork {rng.choice(plain)}" if y else t for t, y in zip(texts, toxic)]
    tagger = T.fit(texts, toxic, 0.5)
    assert tagger.weights["=zork"] > 1
    out = tagger.predict(["w1x w2x zork w3x", "w1x w2x w3x"], tagger.scorer(), 0.7)
    assert [[s["start"] for s in x] for x in out.spans] == [[8], []]
    assert out.score[0] > out.score[1]


def test_held_out_quality(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = id_remainder("doc_id", 3) == 1
    out = T.tag(docs, T.train(docs, labels, ~held)).where(held).join(labels, "doc_id").select("toxic", "toxicity.*").toPandas()
    toxic, clean = out[out.toxic == 1], out[out.toxic == 0]
    assert toxic.predicted.mean() > 0.7 and clean.predicted.mean() < 0.02
    assert all(len(s) for s in toxic[toxic.predicted == 1].spans)


def test_nulls_no_labels_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "you idiot", "a"), (2, None, "b"), (3, "", "c"), (None, "fine day", "d")], "doc_id bigint, text string, toxicity string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None)], "doc_id bigint, toxic int")
    out = T.tag(docs, T.train(docs, labels, F.lit(True))).collect()
    assert len(out) == 4 and all(0 <= r["toxicity"]["score"] <= 1 for r in out)
    elsewhere = T.train(docs, spark.createDataFrame([(77, 1), (78, 0)], "doc_id bigint, toxic int"), F.lit(True))
    assert [r["toxicity"]["predicted"] for r in T.tag(docs, elsewhere).collect()] == [0] * 4
    none = T.train(docs, labels.limit(0), F.lit(True))
    assert [r["toxicity"]["predicted"] for r in T.tag(docs, none).collect()] == [0] * 4
    assert T.tag(docs.limit(0), none).count() == 0
