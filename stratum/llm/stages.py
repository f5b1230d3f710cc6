"""Stages of the corpus pipeline: each applies one operator and its decision to a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.llm import langid, mixing, packing, simhash, toxicity
from stratum.llm.common import Scratch, free_name, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; texts that language ID rejects go.

    The model learns from every labelled row of the stage's input.
    """
    model = langid.train(docs, F.lit(True))
    verdict = free_name(docs, "prediction")
    return langid.identify(docs, model, into=verdict).where(~F.col(f"{verdict}.rejected")).drop(verdict)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject; the tagger learns from all labels of the stage's input."""
    tagger = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    verdict = free_name(docs, "toxicity")
    return toxicity.tag(docs, tagger, into=verdict).where(F.col(f"{verdict}.predicted") == 0).drop(verdict)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near-duplicates.

    Rows that share an id count as one document and one of them stays; a null id is replaced
    by a negative number made from the text while classes are found.
    """
    key = free_name(docs, "document_key")
    stand_in = -(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 62)) + 2)
    keyed = docs.withColumn(key, F.coalesce("doc_id", stand_in))
    classes = simhash.near_duplicates(keyed.select(key, "text"), id=key, shingle=4, max_bits=4)
    scratch = Scratch(spark, "classes")
    first = scratch.keep(classes.where(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count("*").alias("rows")), "first")
    # ids are few bytes: they are the side that is hashed, so texts are neither sorted nor held
    once = keyed.join(first.where("rows = 1").select(key).hint("shuffle_hash"), key, "left_semi")
    # written by itself, so that Spark knows how small it is and shuffles no text for it
    often = scratch.keep(first.where("rows > 1").select(key), "repeated")
    return once.union(keyed.join(often, key, "left_semi").dropDuplicates([key])).select(*docs.columns)


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens follow the target weights of source, language and form."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
