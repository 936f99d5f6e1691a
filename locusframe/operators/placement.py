"""Putting rows into pieces of regions, in genome order.

A piece is a stretch of one region: a cell of fixed width on the genome, dealt over a fixed number
of lanes. It follows from the row and the layout alone, never from how many rows there are, so
small and large inputs give the same pieces and no pass over the data is needed to choose them.
``part_id`` and ``piece`` are columns; tasks hold whole pieces, one after another, and nothing may
be read off a task's number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions import lines
from locusframe.functions.intervals import normalize_contig
from locusframe.operators import regions
from locusframe.operators.lookup import lookup_join
from locusframe.sources.layouts import Layout

CELL_WIDTH = 10_000_000
"""Bases of a cell."""
SPREAD = 4
"""Lanes of a cell, which keep a position that holds very many rows from being one task's work."""


def with_pieces(
    df: DataFrame, rank: str = "contig_rank", pos: str = "pos", cell_width: int = CELL_WIDTH, spread: int = SPREAD
) -> DataFrame:
    """Add ``piece``, a text of contig, cell and lane whose order is that of the genome.

    Rows without contig rank or position (an unmapped read placed by its mate) are in cells of
    number 0. The lanes of a cell are sorted runs of it; with ``spread=1`` the pieces of a region
    in order hold its rows in order.
    """
    number = F.coalesce(F.col(rank) + 1, F.lit(0)).cast("long")
    cell = F.coalesce(F.floor(F.col(pos) / F.lit(cell_width)), F.lit(0)).cast("long")
    lane = F.pmod(lines.spread_key(*df.columns), F.lit(spread)).cast("long")
    return df.withColumn("piece", F.format_string("%06d-%07d-%03d", number, cell, lane))


def place(
    df: DataFrame,
    order: Sequence[str | Column] | None = None,
    rank: str = "contig_rank",
    pos: str = "pos",
    cell_width: int = CELL_WIDTH,
    spread: int = SPREAD,
) -> DataFrame:
    """Rows with their ``piece``, a piece in one task only, sorted by (part_id, piece, ``order``).

    ``order`` is contig rank and position by default. Rows of part id -1 have pieces of their own.
    """
    keys = [rank, pos] if order is None else list(order)
    pieces = with_pieces(df, rank, pos, cell_width, spread)
    return pieces.repartition("part_id", "piece").sortWithinPartitions("part_id", "piece", *keys)


def place_in_order(
    df: DataFrame, order: Sequence[str], rank: str = "contig_rank", pos: str = "pos", cell_width: int = CELL_WIDTH
) -> DataFrame:
    """Rows with their ``piece`` of one lane, in ranges of (part_id, piece, ``order``), sorted.

    A hot cell, or a hot position if ``order`` goes on behind it, is cut into several tasks. A piece's files in
    order of their names hold its rows in order.
    """
    keys = ["part_id", "piece", *order]
    return with_pieces(df, rank, pos, cell_width, 1).repartitionByRange(*keys).sortWithinPartitions(*keys)


def partition_lines(df: DataFrame, layout: Layout, row: str = "row", cell_width: int = CELL_WIDTH, spread: int = SPREAD) -> DataFrame:
    """Variant lines to regions by their first two fields; gives (row, part_id, piece).

    Here and below, ``cell_width`` and ``spread`` are those of :func:`with_pieces`: smaller cells make more and smaller tasks.
    """
    assigned = regions.assign_lines(df.select(row), layout, row)
    return place(assigned, cell_width=cell_width, spread=spread).select(row, "part_id", "piece")


def partition_alignments(
    df: DataFrame,
    layout: Layout,
    contig: str = "referenceName",
    pos: str = "alignmentStart",
    cell_width: int = CELL_WIDTH,
    spread: int = SPREAD,
) -> DataFrame:
    """Alignments to regions by their start; every input column is kept, ``part_id`` and ``piece`` are added."""
    assigned = regions.assign_regions(df, layout, contig, pos)
    return place(assigned, pos=pos, cell_width=cell_width, spread=spread).drop("region_key", "contig_rank")


def partition_bed(df: DataFrame, layout: Layout, row: str = "row", cell_width: int = CELL_WIDTH, spread: int = SPREAD) -> DataFrame:
    """BED lines to the regions of their two end points; gives (row, part_id, piece)."""
    parsed = df.select(
        row,
        lines.field(F.col(row), 0).alias("contig"),
        lines.int_field(F.col(row), 1).alias("start"),
        lines.int_field(F.col(row), 2).alias("end"),
    )
    assigned = with_rank(regions.assign_endpoints(parsed, layout), layout, "contig")
    return place(assigned, pos="start", cell_width=cell_width, spread=spread).select(row, "part_id", "piece")


def partition_pairs(
    df: DataFrame,
    layout: Layout,
    contig: str = "referenceName",
    pos: str = "alignmentStart",
    mate_contig: str = "mateReferenceName",
    mate_pos: str = "mateAlignmentStart",
    cell_width: int = CELL_WIDTH,
    spread: int = SPREAD,
) -> DataFrame:
    """Read pairs to every region either mate falls in, sorted by the read's own position."""
    assigned = regions.assign_pairs(
        df, layout, contig=contig, pos=pos, mate_contig=mate_contig, mate_pos=mate_pos
    )
    ranked = with_rank(assigned, layout, contig)
    return place(ranked, pos=pos, cell_width=cell_width, spread=spread).drop("region_key", "contig_rank")


def with_rank(df: DataFrame, layout: Layout, contig: str) -> DataFrame:
    """Add the contig's rank in the layout's dictionary; null for an unknown contig."""
    ranks = layout.regions.select(
        normalize_contig(F.col("contig")).alias("rank_contig"), "contig_rank"
    ).distinct()
    return rank_contigs(df, ranks, contig, layout.num_regions)


def rank_contigs(df: DataFrame, ranks: DataFrame, contig: str, rows: int | None = None) -> DataFrame:
    keyed = df.withColumn("at_contig", normalize_contig(F.col(contig)))
    return lookup_join(
        keyed, ranks, on=[("at_contig", "rank_contig")], how="left", table_rows=rows
    ).drop("at_contig")


def genome_sort(
    df: DataFrame, contigs: DataFrame, contig: str = "referenceName", pos: str = "alignmentStart"
) -> DataFrame:
    """Global order by contig rank and position; unmapped reads and unknown contigs come last.

    Spark cuts the order into ranges. The last sort key tells equal positions apart, so the
    unmapped reads, which all share one position, are spread over many ranges as well.
    """
    ranks = contigs.select(normalize_contig(F.col("contig")).alias("rank_contig"), "contig_rank")
    ranked = rank_contigs(df, ranks, contig).withColumn("tie", lines.spread_key(*df.columns))
    ordered = ranked.orderBy(F.col("contig_rank").asc_nulls_last(), F.col(pos), F.col("tie"))
    return ordered.drop("tie", "contig_rank")


def unmapped(df: DataFrame, flags: Column | None = None) -> DataFrame:
    """Reads with flag bit 0x4. Without a flag column the bit is read from ``raw``."""
    return df.filter(lines.is_unmapped(lines.raw_flags(F.col("raw")) if flags is None else flags))
