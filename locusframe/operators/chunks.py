"""Cutting reads into chunks of nearly equal size by their running number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.operators.index import row_index

# Fixed value: default number of reads in a chunk.
READS_PER_CHUNK = 1_048_576


def chunk_count(total: int, reads_per_chunk: int = READS_PER_CHUNK) -> int:
    """Whole chunks, plus one for a remainder of at least half a chunk; never fewer than one."""
    if reads_per_chunk < 1:
        raise ValueError("reads_per_chunk must be positive")
    whole, rest = divmod(total, reads_per_chunk)
    if whole == 0:
        return 1
    return whole + (1 if rest >= reads_per_chunk // 2 else 0)


def read_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_reads"))


def with_chunk(df: DataFrame, total: int, reads_per_chunk: int = READS_PER_CHUNK, idx: str = "idx") -> DataFrame:
    """Add ``part_id`` from the read's 0-based number; a short tail joins the last chunk."""
    last = chunk_count(total, reads_per_chunk) - 1
    chunk = F.floor(F.col(idx) / F.lit(reads_per_chunk))
    return df.withColumn("part_id", F.least(chunk, F.lit(last)).cast("int"))


def chunk_reads(
    df: DataFrame,
    reads_per_chunk: int = READS_PER_CHUNK,
    idx: str | None = None,
    id_column: str = "id",
    order_by: list | None = None,
) -> DataFrame:
    """Reads with ``idx`` and ``part_id``, task i holding chunk i sorted by read id.

    The chunk follows from the number alone, so two files of mates stay aligned. No chunk has
    more than one and a half times ``reads_per_chunk`` rows. ``idx`` names an existing 0-based
    number; without one the rows are numbered in ``order_by`` or in their present order.
    """
    if idx is None:
        df, idx = row_index(df, 0, order_by, "idx"), "idx"
    total = df.count()
    chunked = with_chunk(df, total, reads_per_chunk, idx)
    parts = chunk_count(total, reads_per_chunk)
    return chunked.repartitionById(parts, "part_id").sortWithinPartitions("part_id", id_column)
