"""Language ID: the model against a plain Kneser-Ney, edge cases, held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import functions as F

from stratum.llm import langid as L
from stratum.llm.common import id_remainder, table

SF = "/root/testdata/sf0.001"


def plain_grams(text):
    chars = []
    for c in text.lower():
        chars.append(c if c.isalpha() else " ")
    padded = "   " + " ".join("".join(chars).split()) + " "
    return [padded[i - 3:i + 1] for i in range(3, len(padded))] if padded.strip() else []


def plain_model(texts):
    level = Counter(g for t in texts for g in plain_grams(t))
    orders = {4: level}
    for k in (3, 2, 1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])

    def prob(gram):
        k = len(gram)
        if not k:
            return 1 / 4096
        counts = orders[k]
        once, twice = sum(v == 1 for v in counts.values()), sum(v == 2 for v in counts.values())
        d = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
        after = [v for g, v in counts.items() if g[:-1] == gram[:-1]]
        if not after:
            return prob(gram[1:])
        return max(counts.get(gram, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * prob(gram[1:])

    return prob


TEXTS = {"aa": ["the cat and the hat", "then there, THE end"], "bb": ["der die das und", "daß ich nicht lache"]}


def counts():
    rows = []
    for lang, texts in TEXTS.items():
        codes, n = np.unique(L.ngrams(texts)[0], return_counts=True)
        rows += [(lang, 0, c, k, k) for c, k in zip(codes.tolist(), n.tolist())]
    return pa.Table.from_pandas(pd.DataFrame(rows, columns=["lang", "slot", "code", "n", "n_fit"]))


def test_model_equals_plain_kneser_ney():
    model = L.Model(counts(), "n")
    tests = ["the dog", "ich und the zebra", "Über", "x"]
    chars, h = model.cross_entropies(tests)
    for i, lang in enumerate(model.langs):
        prob = plain_model(TEXTS[lang])
        for t, n, own in zip(tests, chars, h[:, i]):
            grams = plain_grams(t)
            assert len(grams) == n
            assert math.isclose(own, -sum(math.log(prob(g)) for g in grams) / n, rel_tol=1e-4), t


def test_every_counted_ngram_is_in_the_model(spark):
    """Through count_ngrams: 60,000 distinct n-grams a language and more, each with its own count."""
    rng = np.random.default_rng(4)
    letters = [chr(c) for c in range(0x400, 0x460)]
    rows = [(lang, "".join(rng.choice(letters, 40_000))) for lang in ("aa", "bb") for _ in range(2)]
    got = L.count_ngrams(spark.createDataFrame(rows, "lang string, text string"), "text", "lang", F.lit(False)).toArrow()
    for lang in ("aa", "bb"):
        codes, n = np.unique(L.ngrams([t for x, t in rows if x == lang])[0], return_counts=True)
        own = got.filter(pa.compute.equal(got["lang"], lang)).sort_by("code")
        assert len(codes) > 60_000
        assert np.array_equal(own["code"].to_numpy(), codes) and np.array_equal(own["n"].to_numpy(), n)


def test_counted_model_equals_plain_kneser_ney(spark):
    rows = [(lang, t) for lang, texts in TEXTS.items() for t in texts]
    got = L.count_ngrams(spark.createDataFrame(rows, "lang string, text string"), "text", "lang", F.lit(False)).toArrow()
    model = L.Model(got, "n")
    text = "ich und the zebra"
    own = model.cross_entropies([text])[1][0]
    for i, lang in enumerate(model.langs):
        prob, grams = plain_model(TEXTS[lang]), plain_grams(text)
        assert math.isclose(own[i], -sum(math.log(prob(g)) for g in grams) / len(grams), rel_tol=1e-4)


def test_long_texts_are_cut_without_losing_characters(monkeypatch):
    monkeypatch.setattr(L, "PIECE", 50)
    model = L.Model(counts(), "n")
    assert model.cross_entropies(["the cat " * 100])[0][0] >= 700


def test_probabilities_sum_to_one():
    codes, n = np.unique(L.ngrams(TEXTS["aa"])[0], return_counts=True)
    orders = L._orders(codes, n)
    context = codes[3] >> 12 << 12
    assert math.isclose(L._prob(orders, context + np.arange(4096), 4).sum(), 1, rel_tol=1e-9)


def test_held_out_accuracy_and_rejection(spark):
    docs = table(spark, SF, "documents")
    held = id_remainder("doc_id", 4) == 2
    model = L.train(docs, ~held)
    out = L.identify(docs, model).where(held & (F.length("text") > 40)).select("lang", "prediction.*").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.95
    assert not out.rejected.mean() > 0.05
    odd = model.predict(["qzx kjv wvq zzk xqj " * 20, None, "", "123 !!", "the " * 30])
    assert odd.rejected.tolist()[:4] == [True] * 4
    assert odd.lang_pred.tolist()[1:4] == ["und"] * 3 and odd.score.tolist()[1:4] == [0.0] * 3


def test_nulls_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "hello there", "en", "x"), (2, None, "en", "x"), (3, "bonjour", None, "x"), (None, "hello there", "en", "x")],
                               "doc_id bigint, text string, lang string, prediction string")
    out = L.identify(df, L.train(df, F.lit(True))).collect()
    assert len(out) == 4 and [r["prediction"]["lang_pred"] for r in out] == ["en", "und", "en", "en"]
    empty = L.train(df.limit(0), F.lit(True))
    assert {r["prediction"]["lang_pred"] for r in L.identify(df, empty).collect()} == {"und"}
    assert L.identify(df.limit(0), empty).count() == 0


def test_rare_language_has_its_own_threshold(spark):
    """0.6 % of the rows, and of many letters: its normal cross-entropy lies far above the majority's."""
    rng = np.random.default_rng(5)
    wide = [chr(c) for c in range(0x400, 0x460)]
    rows = [(i, "aa", " ".join(rng.choice(["the", "cat", "and", "hat", "then", "there"], 12))) for i in range(40_000)]
    rows += [(40_000 + i, "bb", "".join(rng.choice(wide, 40))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = L.train(docs, F.lit(True))
    assert not model.predict([t for _, lang, t in rows if lang == "bb"] + [t for _, _, t in rows[:50]]).rejected.any()


def test_calibration_sample_is_bounded_and_holds_every_language(spark):
    rows = [(i * 7919 * 2**40 % 2**64 - 2**63, "aa", f"t{i}") for i in range(3000)] + [(-2**63 + 1, "aa", "same")] * 500 + [(2**62, "bb", "x"), (2**61, "bb", "y")]
    got = L.calibration_sample(spark.createDataFrame(rows, "draw bigint, lang string, text string"), 100, 30)
    assert got.overall.sum() == 100 and len(got) <= 100 + 30 + 2
    assert len(got[(got.lang == "aa") & (got.text == "same")]) <= 100
    assert sorted(got[got.lang == "bb"].text) == ["x", "y"]
    own = got[got.lang == "aa"].draw.to_numpy()         # a row repeated 500 times takes one place
    assert set(sorted({d for d, x, _ in rows if x == "aa"})[:30]) <= set(own.tolist())


def test_thresholds_and_slope_come_from_every_row(spark):
    """Also from rows that lie beyond any bound of a sample: all rows of all folds are scored, and all scores count."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'aa', 'bb') AS lang", "concat('the cat and the hat number ', hex(id * 7919)) AS text")
    fold = F.pmod(F.col("doc_id"), F.lit(L.FOLDS))
    counts = L.count_ngrams(docs, "text", "lang", fold).toArrow()
    scores = L.fold_scores(docs, [L.Model(counts, f"n_{k}") for k in range(L.FOLDS)], "text", "lang", fold).toPandas()
    assert len(scores) == 6000
    got = L.calibrated(L.Model(counts, "n"), spark.createDataFrame(scores), 8.0, 0.6)
    for i, lang in enumerate(("aa", "bb")):
        own = scores[(scores.lang == lang) & (scores.chars >= 20)]
        middle = np.quantile(own.own, 0.5, method="inverted_cdf")
        assert math.isclose(got.mean[i], middle)
        y = (own.own - middle) ** 2 / 0.455
        assert math.isclose(got.per_char[i], max(np.quantile(y * own.chars, 0.5, method="inverted_cdf"), 0.25))
    assert got.slope == L.SLOPES[np.argmin(np.stack(scores.losses.to_list()).mean(0))]
