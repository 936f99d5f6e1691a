"""Consecutive row numbers without a single-task sort.

The rows are written once to the shared folder as Parquet. A row's place is then its file's
offset plus its row number inside the file, both stored facts: they do not change when the file
splits are planned differently or when a task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.operators.lookup import lookup_join
from locusframe.session import shared_path


def row_index(
    df: DataFrame,
    starts_from: int = 0,
    order_by: Sequence[str | Column] | None = None,
    name: str = "index",
) -> DataFrame:
    """Append ``index = position + starts_from``, a gap-free long.

    Position is the place in ``order_by`` (which should name a total order), or in the frame's
    present partition order. The result's rows are in no particular order; sort by the index
    where that matters.
    """
    path = shared_path(df.sparkSession, "row-index")
    (df.orderBy(*order_by) if order_by else df).write.parquet(path)
    return table_index(df.sparkSession, path, starts_from, name)


def table_index(
    spark: SparkSession, path: str, starts_from: int = 0, name: str = "index"
) -> DataFrame:
    """Row numbers for a Parquet table as written: by file, then by place in the file.

    No shuffle of the rows. The per-file counts come from the Parquet footers, since the scan
    reads no column. Files written by one Spark job are ordered by their task number, and files of equal number, as
    partition folders and later appends have them, by their whole path.
    """
    table = spark.read.parquet(path)
    columns = table.columns
    file_no = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    located = table.select(
        "*",
        F.when(file_no != "", file_no.cast("long")).alias("file_no"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_in_file"),
    )
    counts = located.groupBy("file_no", "file_path").count()
    # The running sum sees one row per file of the table, not the rows of the table.
    offsets = counts.select(
        F.col("file_path").alias("offset_file"),
        F.expr(
            "coalesce(sum(count) over (order by file_no, file_path "
            "rows between unbounded preceding and 1 preceding), 0)"
        ).alias("offset"),
    )
    joined = lookup_join(
        located, offsets, on=[("file_path", "offset_file")], table_rows=len(table.inputFiles())
    )
    place = F.col("offset") + F.col("row_in_file") + F.lit(starts_from)
    return joined.select(*columns, place.cast("long").alias(name))


def rank_in_group(
    df: DataFrame, group: str, order_by: Sequence[str | Column], groups: int, name: str = "rank"
) -> DataFrame:
    """1-based rank inside each group, for groups that may hold most of the rows.

    A window over the group would sort it in one task. Here the whole table is range-sorted by
    (group, order), numbered, and the number of the group's first row is taken off.
    """
    numbered = row_index(df, 0, [F.col(group), *order_by], "place")
    firsts = numbered.groupBy(F.col(group).alias("first_group")).agg(F.min("place").alias("first"))
    joined = lookup_join(numbered, firsts, on=[(group, "first_group")], table_rows=groups)
    return joined.withColumn(name, F.col("place") - F.col("first") + 1).drop("place", "first")
