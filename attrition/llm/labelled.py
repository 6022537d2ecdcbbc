"""Bounded samples of labelled documents for fitting the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    rows: int,
    where: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """At most ``rows`` labelled documents as (doc_id, text, label 0/1).

    The sample is the labelled ids of smallest hash, so it is the same for any
    partitioning; ids that are labelled twice take the larger label, and of the
    rows of a document id the one with the shortest text (ties: the smaller text) is used.  ``where``
    is a condition on the column ``doc_id``.  Only the ids, at most ``rows`` of
    them, are broadcast; the documents are filtered where they are read, so only
    the sampled texts are shuffled.
    """
    ids = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    ids = ids.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        ids = ids.where(where)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return one_text(texts.join(F.broadcast(ids), "doc_id"), "label")


def one_text(rows: DataFrame, *others: str) -> DataFrame:
    """One row for each doc_id: its shortest text (ties: the smallest), nulls last, with the other columns of that row."""
    order = F.struct(F.col("text").isNull(), F.coalesce(F.octet_length("text"), F.lit(0)), "text", *others)
    first = rows.groupBy("doc_id").agg(F.min(order).alias("r"))
    return first.select("doc_id", *[F.col(f"r.{c}").alias(c) for c in ("text", *others)])
