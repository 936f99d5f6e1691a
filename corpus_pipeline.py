"""A corpus cleaned in five stages; each works on all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet under the
shared folder and reads it back for the next. All but the last return the columns of ``documents``.

Rows with a null text stay in every filtering stage (nothing is known against them); rows with a null id are
kept and never stand for a group of others. Rows that repeat with id and text are one row after the join stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.llm import decontamination, ngramjoin, packing, suffixarray, toxicity
from locusframe.llm.common import column, marked, stored, table

TOXIC_FROM = 0.5
WORDS, PERCENT = 5, 80
REPEATED_BYTES = 200


def _own_columns(stage: Callable) -> Callable:
    """The stage with all columns it has no use for under names of their own, so that none clashes with those it adds."""

    @wraps(stage)
    def renamed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in ("doc_id", "text", "n_chars") else f"_in{i}" for i, c in enumerate(docs.columns)}
        kept = stage(spark, docs.select(*(column(c).alias(n) for c, n in names.items())), sf_dir)
        return kept.select(*(column(n).alias(c) for c, n in names.items()))

    return renamed


@_own_columns
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score of being toxic is below ``TOXIC_FROM``."""
    scored = toxicity.score_toxicity(docs, docs, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") < TOXIC_FROM).select(*(column(c) for c in docs.columns))


@_own_columns
def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by n-gram similarity."""
    found = ngramjoin.near_duplicates(docs, WORDS, PERCENT)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept")).distinct()
    rows = docs.join(kept, column("doc_id").eqNullSafe(F.col("kept")), "left_semi")
    # A row that repeats another's id and text is a copy of it; rows without an id are told apart by text alone.
    copies = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    first = rows.withColumn("_copy", F.when(F.col("text").isNull(), 1).otherwise(F.row_number().over(copies)))
    return first.filter(F.col("_copy") == 1).select(*(column(c) for c in docs.columns))


def _without_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[str]:
    """The text less its spans; characters that a span only touches stay."""

    def inside(at: int, step: int) -> int:
        while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
            at += step
        return at

    whole = [(inside(a, 1), inside(b, -1)) for a, b in spans]
    return (suffixarray.kept_bytes(data, [(a, b) for a, b in whole if a < b]).decode("utf-8", "replace"),)


@_own_columns
def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of ``REPEATED_BYTES`` bytes or more that occur again."""
    spans = suffixarray.repeated_spans(docs, REPEATED_BYTES)
    changed = suffixarray.per_text(docs, spans, _without_spans, "cut string").withColumnRenamed("th", "_th")
    # Only rows whose text may have spans are shuffled.
    touched, rest = (marked(docs, F.xxhash64("text"), spans.select("th"), inside) for inside in (True, False))
    rows = touched.join(changed, F.xxhash64("text") == F.col("_th"), "left")
    new = {"text": F.coalesce("cut", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("cut").isNotNull(), F.length("cut").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns(new).select(*(column(c) for c in docs.columns)).union(rest)


@_own_columns
def reject_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    matched = decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return matched.filter(F.size("matches") == 0).select(*(column(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences and offsets."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("suffix_array_dedup", cut_repeated),
    ("benchmark_decontamination", reject_leaks),
    ("best_fit_packing", pack_sequences),
]

#: No stage but a part of the last could be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
