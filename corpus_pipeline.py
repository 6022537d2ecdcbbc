"""Training-data pipeline over ``documents``: five stages, each an operator of ``attrition.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes
each stage's result as Parquet in the shared folder and reads it back as the
next one's documents, so a lost executor never costs more than the stage at
hand.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import decontaminate, near_duplicates, quality_rules, shared_prefix, suffix_dedup
from attrition.llm.common import materialize, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the model is fitted on the labelled ones."""
    model = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (5-word shingles, similarity 0.8)."""
    return near_duplicates.keep_one(docs, n=5)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; ``n_chars`` follows the text."""
    out = suffix_dedup.drop_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids, checked by decoding them."""
    import public_tokenizers

    return shared_prefix.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_dedup),
    ("suffix_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", pieces),
]

# SQL can express neither the fitted model nor the pieces; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
