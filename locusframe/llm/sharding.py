"""Proportional stratified interleaving: shards of near-equal row counts that each match the mixture.

Rows of a source are ranked in a seeded shuffle; the rank ``r`` of ``n`` rows becomes the fraction
``(r + 1/2) / n``. In the order of these fractions all sources are spread evenly, so cutting the order into
runs of equal length gives every shard the sources in their proportions. Counts differ by one at most.

Neither ranking sorts a source, or the whole table, in one task. The shuffle key is cut into fixed ranges;
rows are numbered inside a (source, range) or a range of fractions, and the small table of counts per
range gives each range its first number. A source with a third of all rows is thus many groups, and the
tables of counts have at most sources x ranges rows. Ranges are chosen from the row count; which rows are
where depends on the order alone, never on the ranges.

Rows with equal hashes are ordered by the key columns; rows equal in these, too, are interchangeable. A null source is a source of its own. An empty table gives an empty result. Columns of
the input pass through; ``shard`` and ``slot`` are added and replace input columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.common import column, unpacked, whole_row

#: Rows that one range holds on average.
ROWS_PER_RANGE = 20_000


def _numbered(frame: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Adds each row's number, from 0, in the order of ``_range`` and then ``order``, for each group."""
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    counts = frame.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")
    firsts = counts.select(*(F.col(c).alias(f"{c}_of") for c in [*group, "_range"]), first)
    numbered = frame.withColumn("_inside", F.row_number().over(inside) - 1)
    on = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in [*group, "_range"]]
    return numbered.join(firsts, on).select(*frame.columns, (F.col("_first") + F.col("_inside")).alias(name))


def interleave(
    rows: DataFrame, shards: int, source: str = "source", key: tuple[str, ...] = ("doc_id",),
    seed: int = 20, ranges: int | None = None,
) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (gapless from 0 in a shard); ``key`` decides the seeded shuffle.

    One job counts the rows while the plan is built.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    total = rows.count()
    ranges = ranges or max(1, total // ROWS_PER_RANGE)
    frame = rows.select(
        whole_row(rows, ("shard", "slot")),
        column(source).cast("string").alias("_source"),
        F.xxhash64(F.lit(seed), *(column(c) for c in key)).alias("_hash"),
        F.struct(*(column(c) for c in key)).alias("_key"),
    )
    # The upper half of the hash, unsigned, comes first in the order, so its ranges follow the order.
    frame = frame.withColumn("_upper", F.shiftrightunsigned("_hash", 32))
    frame = frame.withColumn("_range", F.expr(f"(_upper * {ranges}L) div {1 << 32}L"))
    shuffled = [F.col("_upper"), F.col("_hash"), F.col("_key")]
    frame = _numbered(frame, ["_source"], shuffled, "_rank")
    sizes = frame.groupBy(F.col("_source").alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    frame = frame.join(sizes, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    # (2 r + 1) / (2 n) in double: order is kept, and equal fractions give equal doubles.
    fraction = (2 * F.col("_rank") + 1) / (2 * F.col("_size"))
    frame = frame.withColumn("_fraction", fraction).withColumn("_range", F.floor(F.col("_fraction") * ranges))
    order = [F.col("_fraction"), F.xxhash64(F.lit(seed), "_source"), F.col("_source"), *shuffled]
    frame = _numbered(frame.withColumn("_all", F.lit(0)), ["_all"], order, "_place")
    # Shard s holds the places from ceil(s * total / shards) on.
    shard = f"(_place * {shards}L) div {max(1, total)}L"
    first = f"(({shard}) * {total}L + {shards - 1}L) div {shards}L"
    return frame.select(
        *unpacked(frame), F.expr(shard).cast("int").alias("shard"), (F.col("_place") - F.expr(first)).alias("slot")
    )
