"""The registered queries opN_<name>: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.llm import embed_join, html_text, langid, lexical, line_rules, mixing, oracle, packing, quality, repeats, simhash, spelling, toxicity, warc
from stratum.llm.common import id_remainder, table


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.train(docs, ~held_out)
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "prediction.*")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, max_bits=4)


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    manifest = warc.archived(table(spark, sf, "pages"))
    return warc.read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op4_embedding_join(spark: SparkSession, sf: str) -> DataFrame:
    return embed_join.near_duplicates(table(spark, sf, "embeddings"), threshold=0.93)


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    held_out = id_remainder("doc_id", 3) == 1
    scored = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_line_rules(spark: SparkSession, sf: str) -> DataFrame:
    return line_rules.judge(table(spark, sf, "documents"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    tagger = toxicity.train(docs, table(spark, sf, "labels"), ~held_out)
    return toxicity.tag(docs.select("doc_id", "text"), tagger).select("doc_id", held_out.alias("held_out"), "toxicity.*")


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), top=10)


def op12_cut_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.cut_repeats(table(spark, sf, "documents"), match=50)


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_language_id": op3_language_id,
    "op4_embedding_join": op4_embedding_join,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_quality": op8_quality,
    "op9_line_rules": op9_line_rules,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_cut_repeats": op12_cut_repeats,
    "op13_spelling": op13_spelling,
}


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
