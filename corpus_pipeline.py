"""The corpus pipeline: stages of training-data operators over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm.common import Scratch, table
from stratum.llm.stages import drop_toxic, keep_known_languages, one_of_each_class, pack_sequences, sample_mixture

# (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
STAGES = [
    ("language_id", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_class),
    ("mixing", sample_mixture),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.release()
    return STAGES[-1][1](spark, docs, sf_dir)
