"""Registered queries of this subpackage: one ``opN_<name>`` for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import (
    block_search,
    crf_language,
    decontaminate,
    lm_scoring,
    near_duplicates,
    oracle,
    overlap_join,
    quality_rules,
    quality_trees,
    shared_prefix,
    suffix_dedup,
    warc,
    whitening,
)
from attrition.llm.common import crc_mod, read_table, shared_path
from attrition.llm.token_counts import count_tokens

TOKEN_LIMIT = 1024  # op8: texts above it are over the limit


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return shared_prefix.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.score(docs, quality_rules.fit(docs, read_table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    pages = warc.read_archive(spark, path)
    response = F.col("record_type") == "response"
    return pages.select(
        warc.page_id_of("record_id").alias("page_id"),
        "payload_bytes",
        F.when(response, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        warc.page_id_of("refers_to").alias("refers_to"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(read_table(spark, sf_dir, "documents")).drop("spans")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.components(read_table(spark, sf_dir, "documents"), n=4)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(read_table(spark, sf_dir, "documents"), training=crc_mod("doc_id", 5) != 1)
    return scored.withColumn("held_out", crc_mod("doc_id", 5) == 1)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


GOOD_AT = 0.3  # op9: scores from here on predict label 1


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trees = quality_trees.fit(docs, read_table(spark, sf_dir, "labels"), where=crc_mod("doc_id", 5) != 0)
    return quality_trees.score(docs, trees).select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_AT).cast("int").alias("predicted"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = crf_language.fit(docs, where=crc_mod("doc_id", 4) != 2)
    return crf_language.predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.join(read_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_counts": op8_token_counts,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_language_id": op10_language_id,
    "op11_ngram_join": op11_ngram_join,
    "op12_ranked_search": op12_ranked_search,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
