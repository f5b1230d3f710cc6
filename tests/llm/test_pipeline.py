"""The corpus pipeline and the registered queries."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stratum.llm import queries
from stratum.llm.common import Scratch, table
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_decisions(spark):
    docs = table(spark, SF, "documents")
    columns, seen, scratch = docs.columns, [docs.count()], Scratch(spark, "t")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, SF), name)
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[2] < seen[1] and 0 < seen[4] < seen[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == seen[4]


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, None, "p"), (1, None, "en", None, 0, "p"), (2, "", None, "s", 0, "p"), (3, "The same words here, and there.", "en", "s", 31, "p"),
            (3, "The same words here, and there.", "en", "s", 31, "p"), (None, "Other words without an id at all", "en", "s", 32, "p"), (5, "long " * 50_000, "en", "s", 1, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, prediction string")
    for frame in (docs, docs.limit(0)):
        now = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns, name
            now = Scratch(spark, "t").keep(now, name)
        corpus_pipeline.STAGES[-1][1](spark, now, SF).count()


def test_one_row_of_repeated_documents_stays(spark):
    docs = spark.createDataFrame([(4, "a b c d e"), (4, "a b c d e"), (2, "a b c d e"), (None, "x y z"), (None, "x y z")], "doc_id bigint, text string")
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "x y z"), (2, "a b c d e")]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name] == "OK"


def test_every_operator_is_registered_once():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
