"""Writers: per-region line files, reads, alignments, delimited files, partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import lines
from locusframe.operators.placement import CELL_WIDTH, SPREAD, place, with_pieces

PART = "part_id"
PIECE = "piece"
HEADER_PIECE = "000000-0000000-000"
"""Comes before the pieces of all contigs."""


def write_region_lines(
    df: DataFrame,
    path: str,
    num_parts: int,
    line: Column,
    header: Sequence[str] = (),
    rank: str = "contig_rank",
    pos: str = "pos",
    order: Sequence[str] = (),
    compression: str | None = None,
    cell_width: int = CELL_WIDTH,
    spread: int = SPREAD,
    header_when_empty: bool = True,
) -> None:
    """Text files ``path/part_id=<n>/piece=<k>/``: first the header's, then one per piece, rows in order.

    A region's files in order of their paths are its whole text, the header once at its top; gzip
    files can be joined as they are. The lanes of a cell are sorted runs; ``spread=1`` gives one run,
    so that the whole text is sorted. A region without rows has the header's file alone; it has one empty file
    if there is no header, or none for it (``header_when_empty=False``).
    """
    body = with_pieces(df, rank, pos, cell_width, spread).select(
        PART,
        PIECE,
        F.lit(1).alias("section"),
        F.lit(0).alias("number"),
        F.col(rank).alias("at_rank"),
        F.col(pos).alias("at_pos"),
        *[F.col(c).alias(f"then_{i}") for i, c in enumerate(order)],
        line.alias("value"),
    )
    headed = header and header_when_empty
    if headed:
        body = body.unionByName(_headers(_all_regions(df.sparkSession, num_parts), header), allowMissingColumns=True)
    keys = [PART, PIECE, "section", "number", "at_rank", "at_pos", *[f"then_{i}" for i in range(len(order))]]
    placed = body.repartition(PART, PIECE).sortWithinPartitions(*keys)
    options = {"compression": compression} if compression else {}
    placed.select(PART, PIECE, "value").write.partitionBy(PART, PIECE).options(**options).text(path)
    if not headed:
        _add_headers_and_empty_files(df.sparkSession, path, num_parts, header, options)


def _all_regions(spark: SparkSession, num_parts: int) -> DataFrame:
    return spark.range(num_parts).select(F.col("id").cast("int").alias(PART))


def _headers(parts: DataFrame, header: Sequence[str]) -> DataFrame:
    return parts.select(
        PART,
        F.lit(HEADER_PIECE).alias(PIECE),
        F.lit(0).alias("section"),
        F.posexplode(F.array(*[F.lit(h) for h in header])).alias("number", "value"),
    )


def _add_headers_and_empty_files(
    spark: SparkSession, path: str, num_parts: int, header: Sequence[str], options: dict[str, str]
) -> None:
    """Adds the header to regions that have files and an empty file to the others.

    Only file names are read to tell which regions have files, so the rows are not computed again.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    number = F.regexp_extract("path", rf"/{PART}=(-?\d+)/{PIECE}=[^/]*/[^/]*$", 1)
    filled = listed.select(number.cast("int").alias(PART)).distinct()
    bare = _all_regions(spark, num_parts).join(filled, PART, "left_anti")
    # A row with a null alone opens its file, and the delimited format writes nothing for it, not even a line's end.
    marked = bare.select(PART, F.lit(HEADER_PIECE).alias(PIECE), F.lit(None).cast("string").alias("value"))
    if header:
        heads = _headers(filled.filter(F.col(PART) >= 0), header)
        ordered = heads.repartition(PART).sortWithinPartitions(PART, PIECE, "number").select(PART, PIECE, "value")
        ordered.write.mode("append").partitionBy(PART, PIECE).options(**options).text(path)
    marked.repartition(PART).write.mode("append").partitionBy(PART, PIECE).options(emptyValue="", **options).csv(path)


def region_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of all regions, empty ones included; as many as the layout has pieces."""
    return list(spark.read.text(path).inputFiles())


def write_region_vcf(
    df: DataFrame, path: str, num_parts: int, header: Sequence[str], row: str = "row", **options
) -> None:
    """Variant lines with their header, gzip-compressed."""
    write_region_lines(df, path, num_parts, F.col(row), header, compression="gzip", **options)


def write_region_bed(
    df: DataFrame, path: str, num_parts: int, header: Sequence[str] = (), row: str = "row", **options
) -> None:
    write_region_lines(df, path, num_parts, F.col(row), header, **options)


def write_region_tsv(
    df: DataFrame, path: str, num_parts: int, columns: Sequence[str], **options
) -> None:
    """Tab-separated values with the column names as header."""
    write_region_lines(
        df, path, num_parts, lines.join_fields(list(columns)), ["\t".join(columns)], **options
    )


def fastq_record(id_: str = "id", seq: str = "seq", qual: str = "qual") -> Column:
    """The four lines of one read."""
    return F.concat_ws("\n", F.concat(F.lit("@"), F.col(id_)), F.col(seq), F.lit("+"), F.col(qual))


def write_fastq(df: DataFrame, path: str) -> None:
    """Chunked reads (see ``chunk_reads``) as gzip FASTQ, one file per chunk, rows as placed."""
    chunked = df.select(PART, fastq_record().alias("value"))
    chunked.write.partitionBy(PART).option("compression", "gzip").text(path)


def write_alignments(
    df: DataFrame,
    path: str,
    rank: str = "contig_rank",
    pos: str = "alignmentStart",
    cell_width: int = CELL_WIDTH,
    spread: int = SPREAD,
) -> None:
    """Alignment table as Parquet, one directory per region and piece, sorted inside each file."""
    placed = place(df, rank=rank, pos=pos, cell_width=cell_width, spread=spread)
    placed.drop(rank, "region_key").write.partitionBy(PART, PIECE).parquet(path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", header: bool = True) -> None:
    """Delimited files; an existing path is an error."""
    df.write.option("sep", delimiter).option("header", header).csv(path)


def write_partitioned_table(
    df: DataFrame, table: str, partition_by: Sequence[str], path: str | None = None
) -> None:
    """Overwrite a Parquet table laid out by partition columns.

    Rows are rebalanced by partition value first, so a value does not get one small file from
    every input task. Adaptive execution cuts a value that holds many rows into several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").partitionBy(*partition_by).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
