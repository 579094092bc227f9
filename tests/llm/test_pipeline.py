from __future__ import annotations

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tablesmith.llm import checked, temperature_mixing
from tablesmith.llm.shared import written

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(checked.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(checked.queries()[name](spark, DATA), connect(DATA), checked.oracle_sql()[name]) is None


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = written(stage(spark, docs, DATA), "test")
        assert docs.columns == columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and len(after) > 0.85 * len(before), name
        before = after
    ids, _ = written(corpus_pipeline.STAGES[-1][1](spark, docs, DATA), "test")
    assert ids.count() == docs.count()


def test_every_operator_is_registered_once():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()


def test_token_files_keep_the_order_of_the_mixture(spark):
    text = F.concat_ws(" ", F.lit("words of"), F.col("id"), F.repeat(F.lit("more "), (F.col("id") % 7).cast("int")))
    source = F.when(F.col("id") % 5 == 0, "a").otherwise("b")
    docs, _ = written(spark.range(400).select(F.col("id").alias("doc_id"), text.alias("text"), source.alias("source")), "test")
    mixed = temperature_mixing.mixed_documents(docs)
    order = [r.doc_id for r in mixed.orderBy("mix_turn", F.xxhash64("doc_id", "text")).collect()]
    assert order != sorted(order) and len(order) > 400
    kept, _ = written(corpus_pipeline.mixing(spark, docs, ""), "test")
    files = corpus_pipeline.token_ids(spark, kept, "")
    assert [r.doc_id for r in files.orderBy("start").collect()] == order
