"""A training corpus out of raw documents: toxic ones go, near duplicates are joined, benchmark passages
are found, sources are mixed, and what is left is written as token ids.

Every stage takes all that the one before it kept. Learning is done on the labelled rows of the
folder's own tables. The token files hold the documents in the order of their turns in the mixture.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesmith.llm import ftrl_toxicity, huffman_ids, jaccard_join, temperature_mixing, winnowing
from tablesmith.llm.shared import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.7 or more go."""
    everything = _table(spark, sf_dir, "documents")
    model = ftrl_toxicity.fit(everything, _table(spark, sf_dir, "labels"), "toxic", F.lit(True))
    return ftrl_toxicity.acceptable(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return jaccard_join.one_of_each(docs, jaccard_join.Settings(width=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return winnowing.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays at least once; those of small sources may come twice. Rows follow each other by turn."""
    return temperature_mixing.in_turn(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the token files, which keep the order of the mixture."""
    path = huffman_ids.encoded_documents(docs, public_tokenizers.path("word_bpe_49k.json"), in_order=True)
    return huffman_ids.read_ids(spark, path, huffman_ids.digest, huffman_ids.DIGEST)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: SQL can't express the classifier and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
