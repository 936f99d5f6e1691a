"""Gathering per-partition outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.operators.sinks import PART, PIECE


def _part_number(path: Column) -> Column:
    """Partition of a file: its ``part_id=<n>`` folder (above one of a piece or not), or else the number in its name."""
    folder = F.regexp_extract(path, rf"{PART}=(-?\d+)/(?:{PIECE}=[^/]*/)?[^/]*$", 1)
    name = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(name, F.lit("")), F.lit("0")).cast("int")


def concat_text(spark: SparkSession, path: str) -> DataFrame:
    """(part_id, fqn, result): the lines of each file joined without a separator.

    A file is one input split, read whole by one task, so nothing is shuffled. An empty file
    gives no row.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    fqn = F.col("_metadata.file_path")
    return files.filter(F.col("value") != "").select(
        _part_number(fqn).alias(PART),
        fqn.alias("fqn"),
        F.regexp_replace("value", "\r?\n", "").alias("result"),
    )


def concat_text_keep_empty(spark: SparkSession, path: str, num_parts: int) -> DataFrame:
    """Like :func:`concat_text`, with an empty ``result`` for each partition without any text.

    File listings skip empty files, so the partitions that ought to be there are named by their
    number. Only file names are compared; the texts are not shuffled.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(_part_number(F.col("path")).alias(PART))
    )
    expected = spark.range(num_parts).select(F.col("id").cast("int").alias(PART))
    missing = expected.join(listed, PART, "left_anti").select(
        PART, F.lit(None).cast("string").alias("fqn"), F.lit("").alias("result")
    )
    return concat_text(spark, path).unionByName(missing)


def join_pieces(texts: DataFrame) -> DataFrame:
    """(part_id, result): the texts of a region's files joined in the order of their paths.

    Meant for short texts, such as a command gives per piece; a region has as many as it has pieces. One task
    makes a region's whole text, which a value's limit of 2 GB bounds.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("fqn", F.lit("")).alias("fqn"), "result")))
    return texts.groupBy(PART).agg(F.array_join(F.transform(ordered, lambda t: t["result"]), "").alias("result"))


def collect_results(df: DataFrame, order: str = "part_id", result: str = "result") -> DataFrame:
    """All ``result`` values as one array in ``order``.

    Meant for one result per region or file: the array has as many elements as the layout has
    partitions, however many rows those stand for.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(result))))
    return df.agg(F.transform(pairs, lambda p: p[result]).alias("results"))


def sum_ints(df: DataFrame, text: str = "result") -> DataFrame:
    """Sum of the whole numbers that per-partition outputs hold; other text counts for nothing."""
    return df.agg(F.sum(F.trim(F.col(text)).try_cast("bigint")).alias("total"))
