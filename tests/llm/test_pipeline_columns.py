"""Pipeline stages on documents whose extra columns bear the names that the stages use themselves."""

from pyspark.sql import functions as F

import corpus_pipeline
from locusframe.llm.common import table

CLASHING = ["kept", "_copy", "cut", "_th", "score", "matches", "component_id", "text_hash", "_in0"]


def test_join_and_cut_keep_clashing_columns(spark, sf):
    shared = "".join(chr(97 + i * i % 23) + str(i) + " " for i in range(80))
    texts = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "left " + shared), (4, shared + " quite other words at this end"), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHING:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id")))
    one = corpus_pipeline.keep_one_of_similar(spark, docs, sf)
    cut = corpus_pipeline.cut_repeated(spark, one, sf)
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == docs.columns
    assert 1 in rows and 2 not in rows and 5 in rows
    assert all(r[name] == f"{name}{i}" for i, r in rows.items() for name in CLASHING)


def test_leaks_keep_clashing_columns(spark, sf):
    docs = table(spark, sf, "documents").withColumn("matches", F.lit("mine")).withColumn("score", F.lit("mine"))
    kept = corpus_pipeline.reject_leaks(spark, docs, sf)
    assert kept.columns == docs.columns
    assert kept.filter("matches != 'mine' OR score != 'mine'").isEmpty() and not kept.isEmpty()
