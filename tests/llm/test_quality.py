"""Quality: the additive model on planted interactions, figures, edge cases, held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from stratum.llm import quality as Q
from stratum.llm.common import id_remainder, table

SF = "/root/testdata/sf0.01"


def test_model_learns_main_effects_and_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (6000, 4))
    y = ((x[:, 0] > 0.3) | (x[:, 1] * x[:, 2] > 0.05)).astype(float)
    model = Q.fit(x[:4000], y[:4000])
    assert (1, 2) in model.pairs
    assert ((model.score(x[4000:]) > 0.5) == y[4000:]).mean() > 0.93
    one = sum(t[b] for t, b in zip(model.tables, model.bins(x[:1])[0])) + model.level
    one += sum(t[model.coarse[i][model.bins(x[:1])[0, i]], model.coarse[j][model.bins(x[:1])[0, j]]] for (i, j), t in zip(model.pairs, model.pair_tables))
    assert np.isclose(model.log_odds(x[:1])[0], one)


def test_figures():
    f = dict(zip(Q.FEATURES, Q.figures(b"AB ab ab\nab!\n\nab! |")))
    assert f["words"] == np.log1p(6) and f["repeated_next"] == 2 / 6 and f["capitals"] == 2 / 10 and f["repeated_lines"] == 0
    assert Q.figures(None) == Q.figures(b" \n") == [0.0] * len(Q.FEATURES)
    assert len(Q.figures(b"word " * 300_000)) == len(Q.FEATURES)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = id_remainder("doc_id", 3) == 1
    out = Q.classify(docs, labels, ~held).where(held).join(labels, "doc_id").toPandas()
    assert (out.predicted == out.quality).mean() > 0.97


def test_nulls_ties_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, "a b", 3.0), (1, "a b", 3.0), (2, None, 3.0), (None, "", 3.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id bigint, quality int")
    out = Q.classify(docs, labels, F.lit(True)).collect()
    assert len(out) == 4 and all(r["score"] > 0.99 for r in out)
    assert {r["score"] for r in Q.classify(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert Q.classify(docs.limit(0), labels, F.lit(True)).count() == 0
