"""Bounded samples of labelled rows, for the operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, max_rows: int) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of about ``max_rows`` labelled rows at most, chosen by a hash of
    ``doc_id``. ``learn_from`` is a condition on ``doc_id``.

    Of an id labelled more than once the largest label counts; a NULL label is none. The sample's
    ids are broadcast, their number is bounded by ``max_rows``.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn_from)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    rows = marked.count()
    if rows > max_rows:
        place = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1_000_000))
        marked = marked.where(place < int(1_000_000 * max_rows / rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.join(F.broadcast(marked), "doc_id")
