"""Mixing: weights against a plain raking, probabilities, draws."""

import hashlib

import pytest

from stratum.llm import mixing as M
from stratum.llm.common import Scratch

ROWS = [(i, "word " * (3 + i % 17), ["a", "b", "c", None][i % 4], ["en", "fr"][i % 3 == 0]) for i in range(400)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "t" + str((r[0] or 0) // 7 % 2), 1.0) for r in rows], "doc_id bigint, text string, source string, lang string, topic string, weight double")


def plain_rake(cells, targets, rounds=200):
    w = {c: float(t) for c, t in cells.items()}
    for _ in range(rounds):
        for d, name in enumerate(M.DIMENSIONS):
            have = {}
            for c, v in w.items():
                have[c[d]] = have.get(c[d], 0) + v
            w = {c: v * targets[name][c[d]] / have[c[d]] for c, v in w.items()}
    return w


def test_weights_and_probabilities_equal_a_plain_raking(spark):
    out = M.mix(frame(spark), topic="topic", powers={"source": 0.5, "lang": 0.0, "topic": 1.0}, keep=0.6).toPandas()
    cells = out.groupby(list(M.DIMENSIONS)).n_words.sum().to_dict()
    total, targets = sum(cells.values()), {}
    for d, power in zip(M.DIMENSIONS, (0.5, 0.0, 1.0)):
        own = {v: t ** power for v, t in out.groupby(d).n_words.sum().items()}
        targets[d] = {v: x / sum(own.values()) for v, x in own.items()}
    want = plain_rake(cells, targets)
    got = out.groupby(list(M.DIMENSIONS)).weight.first().to_dict()
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-5 for c in want)
    lo, hi = 0.0, 100.0 * total
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(t, mid * want[c]) for c, t in cells.items()) < 0.6 * total else (lo, mid)
    prob = out.groupby(list(M.DIMENSIONS)).prob.first().to_dict()
    assert all(abs(prob[c] - min(1, hi * want[c] / cells[c])) < 1e-3 for c in want)
    assert abs((out.prob * out.n_words).sum() - 0.6 * total) < 1e-3 * total
    draw = lambda i: int(hashlib.md5(f"5:{i}".encode()).hexdigest()[:13], 16) / 16**13
    assert (out.sampled == [draw(i) < p for i, p in zip(out.doc_id, out.prob)]).all()


def test_sample_keeps_columns_and_rows_of_mix(spark):
    df = frame(spark)
    kept = M.sample(df, topic="topic")
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in M.mix(df, topic="topic").where("sampled").collect())


def test_targets_for_absent_values_are_ignored(spark):
    targets = spark.createDataFrame([("source", "a", 0.5), ("source", "zz", 0.25), ("source", "b", 0.25), ("lang", "en", 1.0), ("lang", "fr", 1.0), ("topic", "t0", 1.0), ("topic", "t1", 1.0)],
                                    "dimension string, value string, share double")
    out = M.mix(frame(spark), topic="topic", targets=targets).toPandas()
    share = out.drop_duplicates(list(M.DIMENSIONS)).groupby("source").weight.sum()
    assert share["a"] == pytest.approx(2 / 3, abs=1e-4) and share["c"] == 0


def test_nulls_empty_texts_and_empty_table(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "", "a", "en"), (2, "x y", "a", "en")]
    out = M.mix(frame(spark, rows)).toPandas()
    assert len(out) == 4 and out.n_words.tolist().count(0) == 3 and out.prob.between(0, 1).all()
    assert M.mix(frame(spark).limit(0)).count() == 0 and M.sample(frame(spark).limit(0)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = M.mix(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_rake_of_cells_without_tokens(spark):
    cells = spark.createDataFrame([("a", "en", "t", 1, 0)], "source string, lang string, topic string, docs bigint, tokens bigint")
    out, worst = M.rake(cells, M.power_targets(cells, {"source": 1, "lang": 1, "topic": 1}), Scratch(spark, "t"))
    assert out.first()["weight"] == 0 and worst == 0


def test_targets_that_cannot_be_met(spark):
    rows = [(1, "word " * 30, "a", "en"), (2, "word " * 10, "b", "fr")]
    targets = spark.createDataFrame([("source", "a", 0.5), ("source", "b", 0.5), ("lang", "en", 0.9), ("lang", "fr", 0.1), ("topic", "t0", 1.0)], "dimension string, value string, share double")
    with pytest.raises(ValueError, match="no weights meet the targets"):
        M.mix(frame(spark, rows), topic="topic", targets=targets)
    # powers that contradict each other: widened to the shares as they are
    out = {r["source"]: r["weight"] for r in M.mix(frame(spark, rows), topic="topic", powers={"source": 0.0, "lang": 1.0, "topic": 1.0}).collect()}
    assert out["a"] == pytest.approx(0.75, abs=1e-5) and out["b"] == pytest.approx(0.25, abs=1e-5)


def test_very_long_text(spark):
    out = M.mix(frame(spark, [(999, "w " * 400_000, "a", "en")])).first()
    assert out["n_words"] == 400_000 and out["topic"] == "long"


def test_plans_of_raking_read_the_cells_twice_at_most(spark, monkeypatch):
    """A round that joins the cells to their sums by three marginals in one plan reads them eight times."""
    reads = []
    keep = M.Scratch.keep

    def counted(self, df, name, *args):
        if name == "raked":
            reads.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return keep(self, df, name, *args)

    monkeypatch.setattr(M.Scratch, "keep", counted)
    M.sample(frame(spark)).count()
    assert len(reads) > 3 and max(reads) <= 3       # the cells, their sums, the targets
