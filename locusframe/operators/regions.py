"""Assigning positions, intervals and read pairs to the regions of a layout.

A region covers ``[start - pad, end + pad]``, so a position near a boundary belongs to both
neighbours, and regions of a layout may also overlap by themselves: every lookup is one-to-many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.functions import lines, matches
from locusframe.functions.intervals import normalize_contig
from locusframe.functions.sharing import compute_here
from locusframe.operators.lookup import lookup_join
from locusframe.sources.layouts import Layout

UNASSIGNED = -1


def assign_regions(
    df: DataFrame, layout: Layout, contig: str = "contig", pos: str = "pos", unmatched: str = "drop"
) -> DataFrame:
    """One output row per region that covers the row's position.

    Adds ``part_id``, ``region_key`` and ``contig_rank``. Rows outside every region are left out,
    or get part id -1 with ``unmatched="keep"``.

    The lookup joins on (contig, bin) with the range test as residual: a position meets only the
    regions of its own bin and the input is not shuffled.
    """
    if unmatched not in ("drop", "keep"):
        raise ValueError("unmatched must be 'drop' or 'keep'")
    _reject_clash(df, "part_id", "region_key", "contig_rank")
    keyed = df.withColumn("at_contig", normalize_contig(F.col(contig))).withColumn(
        "at_bin", F.floor(F.col(pos) / F.lit(layout.bin_width))
    )
    joined = lookup_join(
        keyed,
        layout.bins(),
        on=[("at_contig", "bin_contig"), ("at_bin", "bin")],
        how="inner" if unmatched == "drop" else "left",
        residual=F.col(pos).between(F.col("bin_low"), F.col("bin_high")),
        table_rows=layout.bin_rows,
    ).drop("at_contig", "at_bin", "bin_low", "bin_high")
    if unmatched == "keep":
        joined = joined.withColumn("part_id", F.coalesce("part_id", F.lit(UNASSIGNED)))
    return joined


def assign_lines(df: DataFrame, layout: Layout, row: str = "row", unmatched: str = "drop") -> DataFrame:
    """:func:`assign_regions` for tab-separated lines: contig and position are fields 0 and 1.

    Adds ``contig`` and ``pos`` too. A position that is not a number fails the query.
    """
    parsed = df.select(
        "*",
        lines.field(F.col(row), 0).alias("contig"),
        lines.int_field(F.col(row), 1).alias("pos"),
    )
    return assign_regions(parsed, layout, unmatched=unmatched)


def region_matches(df: DataFrame, layout: Layout, contig: str, pos: str, into: str) -> DataFrame:
    """Add the covering regions as ``array<struct<region_key, part_id>>``, in region order.

    The layout is folded to one array per (contig, bin) first. Such an array holds the regions
    that meet in one bin of average region width, which the layout bounds, not the data.
    """
    candidates = (
        layout.bins()
        .groupBy("bin_contig", "bin")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("region_key", "part_id", "bin_low", "bin_high"))
            ).alias("near")
        )
    )
    keyed = df.withColumn("at_contig", normalize_contig(F.col(contig))).withColumn(
        "at_bin", F.floor(F.col(pos) / F.lit(layout.bin_width))
    )
    joined = lookup_join(
        keyed,
        candidates,
        on=[("at_contig", "bin_contig"), ("at_bin", "bin")],
        how="left",
        table_rows=layout.bin_rows,
    )
    position = F.col(pos)
    covering = F.transform(
        F.filter("near", lambda m: position.between(m["bin_low"], m["bin_high"])),
        lambda m: F.struct(m["region_key"].alias("region_key"), m["part_id"].alias("part_id")),
    )
    nothing = F.array().cast("array<struct<region_key:bigint,part_id:int>>")
    return joined.withColumn(into, F.coalesce(covering, nothing)).drop(
        "at_contig", "at_bin", "near"
    )


def endpoint_matches(
    df: DataFrame, layout: Layout, contig: str, start: str, end: str, into: str = "matches"
) -> DataFrame:
    """Regions of an interval's two end points, one per partition; the start's region wins.

    Regions strictly between the end points are not part of the result.
    """
    both = region_matches(
        region_matches(df, layout, contig, start, "first_end"), layout, contig, end, "second_end"
    )
    kept = matches.first_per_part(F.concat("first_end", "second_end"))
    return compute_here(both, into, kept).drop("first_end", "second_end")


def pair_matches(
    df: DataFrame,
    layout: Layout,
    contig: str = "contig",
    pos: str = "pos",
    mate_contig: str = "mate_contig",
    mate_pos: str = "mate_pos",
    into: str = "matches",
) -> DataFrame:
    """Regions of a read and of its mate, one per partition; the read's region wins."""
    both = region_matches(
        region_matches(df, layout, contig, pos, "of_read"), layout, mate_contig, mate_pos, "of_mate"
    )
    kept = matches.first_per_part(F.concat("of_read", "of_mate"))
    return compute_here(both, into, kept).drop("of_read", "of_mate")


def pair_regions(df: DataFrame, layout: Layout, into: str = "parts", **columns: str) -> DataFrame:
    """Distinct partition ids that either mate falls in."""
    found = pair_matches(df, layout, into="found", **columns)
    return found.withColumn(into, matches.part_ids(F.col("found"))).drop("found")


def pair_region_keys(df: DataFrame, layout: Layout, into: str = "keys", **columns: str) -> DataFrame:
    """Region keys of both mates, one per partition."""
    found = pair_matches(df, layout, into="found", **columns)
    return found.withColumn(into, matches.region_keys(F.col("found"))).drop("found")


def assign_endpoints(
    df: DataFrame, layout: Layout, contig: str = "contig", start: str = "start", end: str = "end"
) -> DataFrame:
    """One row per partition of the interval's end points, with part_id and region_key."""
    _reject_clash(df, "part_id", "region_key")
    return _explode_matches(endpoint_matches(df, layout, contig, start, end, "found"))


def assign_pairs(df: DataFrame, layout: Layout, **columns: str) -> DataFrame:
    """One row per partition of a read pair, so both mates appear wherever either falls."""
    _reject_clash(df, "part_id", "region_key")
    return _explode_matches(pair_matches(df, layout, into="found", **columns))


def _explode_matches(df: DataFrame) -> DataFrame:
    kept = [c for c in df.columns if c != "found"]
    return df.select(*kept, F.explode("found").alias("hit")).select(*kept, "hit.part_id", "hit.region_key")


def _reject_clash(df: DataFrame, *names: str) -> None:
    taken = [n for n in names if n in df.columns]
    if taken:
        raise ValueError(f"input already has columns {taken}")
