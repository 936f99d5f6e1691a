"""Keeping the rows that overlap any of a set of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.functions.intervals import normalize_contig
from locusframe.functions.lines import spread_key
from locusframe.operators.lookup import MAX_BROADCAST_ROWS, lookup_join

BIN_WIDTH = 100_000
#: Intervals of a range of the sweep, on average, and rows of one of its tasks.
INTERVALS_PER_RANGE = 100_000
ROWS_PER_TASK = 1_000_000


def overlap_filter(
    df: DataFrame,
    intervals: DataFrame,
    contig: str = "contig",
    start: str = "start",
    end: str = "end",
    bin_width: int = BIN_WIDTH,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``df`` whose closed interval overlaps one of ``intervals`` (contig, start, end).

    Row [a, b] overlaps some interval exactly when, among the intervals that start at or before
    b, the largest end reaches a. Intervals that a broadcast can hold are looked up by bins, and the rows are not
    shuffled; more of them, or intervals so sparse that bins outnumber them, go through :func:`sweep_filter`.
    """
    starts = _starts(intervals)
    per_bin = (
        starts.withColumn("iv_bin", F.floor(F.col("iv_start") / F.lit(bin_width)))
        .groupBy("iv_contig", "iv_bin")
        .agg(F.max("iv_end").alias("bin_end"), F.count("*").alias("bin_rows"))
    )
    # One row per non-empty bin; a window group is one contig's bins, not its intervals.
    ahead = "over (partition by iv_contig order by iv_bin"
    reach = per_bin.select(
        "iv_contig",
        "bin_rows",
        (F.col("iv_bin") + 1).alias("from_bin"),
        F.expr(f"coalesce(lead(iv_bin) {ahead}), iv_bin + 1)").alias("to_bin"),
        F.expr(f"max(bin_end) {ahead} rows between unbounded preceding and current row)").alias("iv_end"),
    )
    size = reach.agg(F.sum(F.col("bin_rows") + F.col("to_bin") - F.col("from_bin") + 1)).first()[0]
    if size is None:
        return df.filter(F.lit(False))
    if size <= max_broadcast_rows:
        return _looked_up(df, starts, reach, contig, start, end, bin_width, size)
    return sweep_filter(df, intervals, contig, start, end)


def _starts(intervals: DataFrame) -> DataFrame:
    """Intervals of equal contig and start as the longest of them."""
    return intervals.groupBy(
        normalize_contig(F.col("contig")).alias("iv_contig"), F.col("start").alias("iv_start")
    ).agg(F.max("end").alias("iv_end"))


def _looked_up(
    df: DataFrame, starts: DataFrame, reach: DataFrame, contig: str, start: str, end: str, bin_width: int, size: int
) -> DataFrame:
    """Each bin holds the intervals that start in it and one "carry" row with the largest end before it.

    So a row is looked up in one bin only, that of its end, or the bin after its contig's last one. Neither side is exploded over
    the length of its intervals, and no contig has bins beyond its own intervals.
    """
    width = F.lit(bin_width)
    lows = starts.withColumn("iv_bin", F.floor(F.col("iv_start") / width))
    carries = reach.select(
        "iv_contig",
        F.lit(0).cast("long").alias("iv_start"),
        "iv_end",
        F.explode(F.sequence("from_bin", "to_bin")).alias("iv_bin"),
    )
    contigs = reach.groupBy(F.col("iv_contig").alias("of_contig")).agg(F.max("to_bin").alias("past_bin"))
    keyed = df.withColumn("at_contig", normalize_contig(F.col(contig)))
    keyed = lookup_join(keyed, contigs, on=[("at_contig", "of_contig")], table_rows=size, max_broadcast_rows=size)
    keyed = keyed.withColumn("at_bin", F.least(F.floor(F.col(end) / width), F.col("past_bin")))
    return lookup_join(
        keyed,
        lows.unionByName(carries),
        on=[("at_contig", "iv_contig"), ("at_bin", "iv_bin")],
        how="left_semi",
        residual=(F.col("iv_start") <= F.col(end)) & (F.col("iv_end") >= F.col(start)),
        table_rows=size,
        max_broadcast_rows=size,
    ).drop("at_contig", "at_bin", "past_bin")


def _range_of(pos: Column, cuts: Column) -> Column:
    """How many of the sorted cuts lie at or before a position, by halving; null cuts are none."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(24))))
    known = F.coalesce(cuts, F.array().cast("array<bigint>"))

    def step(at: Column, size: Column) -> Column:
        return F.when((at + size <= F.size(known)) & (F.get(known, at + size - 1) <= pos), at + size).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def sweep_filter(
    df: DataFrame,
    intervals: DataFrame,
    contig: str = "contig",
    start: str = "start",
    end: str = "end",
    intervals_per_range: int = INTERVALS_PER_RANGE,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The rows that overlap an interval, for interval sets that no broadcast can hold; nothing is binned.

    1. Cuts. Starts whose hash is a multiple of ``intervals_per_range`` cut a contig into ranges; a contig without one is
       one range. The table of ranges grows with the number of contigs and, by that factor less, of intervals.
    2. Carries. The largest end before a range, of its contig, goes to the range as an interval at its front.
    3. Sweep. Rows, at their ends, and intervals, at their starts, are sorted together in each range, and the largest end
       so far tells whether a row is met. A range with more than ``rows_per_task`` rows is swept in several tasks,
       each with a part of the rows and all of the range's intervals, so a hot position is not one task's work.
    """
    starts = _starts(intervals)
    sampled = F.pmod(F.xxhash64("iv_contig", "iv_start"), F.lit(intervals_per_range)) == 0
    cuts = starts.filter(sampled).groupBy(F.col("iv_contig").alias("cut_contig")).agg(F.array_sort(F.collect_list("iv_start")).alias("cuts"))

    def ranged(frame: DataFrame, name: str, pos: str) -> DataFrame:
        joined = lookup_join(frame, cuts, on=[(name, "cut_contig")], how="left")
        return joined.withColumn("range", _range_of(F.col(pos), F.col("cuts"))).drop("cuts")

    steps = ranged(starts, "iv_contig", "iv_start")
    keyed = df.select(
        normalize_contig(F.col(contig)).alias("at_contig"),
        F.col(start).cast("long").alias("at_start"),
        F.col(end).cast("long").alias("at"),
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("whole"),
    )
    rows = ranged(keyed, "at_contig", "at")
    of_rows = rows.groupBy(F.col("at_contig").alias("r_contig"), F.col("range").alias("r_range")).agg(
        F.ceil(F.count("*") / F.lit(rows_per_task)).cast("int").alias("parts")
    )
    ends = steps.groupBy("iv_contig", "range").agg(F.max("iv_end").alias("most"))
    # A window group has the ranges of one contig; ranges without an interval of their own carry on what came before.
    both = of_rows.join(ends, (F.col("r_contig") == F.col("iv_contig")) & (F.col("r_range") == F.col("range")), "full").select(
        F.coalesce("r_contig", "iv_contig").alias("r_contig"), F.coalesce("r_range", "range").alias("r_range"), "parts", "most"
    )
    before = Window.partitionBy("r_contig").orderBy("r_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = both.withColumn("carry", F.max("most").over(before)).filter("parts > 0 AND (carry IS NOT NULL OR most IS NOT NULL)")
    keys = [("at_contig", "r_contig"), ("range", "r_range")]
    parted = lookup_join(rows, ranges.select("r_contig", "r_range", "parts"), on=keys)
    part = F.pmod(spread_key("at_contig", "at", "at_start", "whole"), F.col("parts")).cast("int")
    of_row = parted.select("at_contig", "range", part.alias("part"), "at", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("reach"), "at_start", "whole")

    def at_front(frame: DataFrame, contig_of: str, at: Column, reach: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        nothing = F.lit(None).cast(of_row.schema["whole"].dataType).alias("whole")
        return frame.select(
            F.col(contig_of).alias("at_contig"), "range", every, at.alias("at"), F.lit(0).alias("kind"),
            F.col(reach).cast("long").alias("reach"), F.lit(None).cast("long").alias("at_start"), nothing,
        )

    known = steps.join(
        ranges.select("r_contig", "r_range", "parts"), (F.col("iv_contig") == F.col("r_contig")) & (F.col("range") == F.col("r_range"))
    )
    carries = ranges.filter("carry IS NOT NULL").withColumnRenamed("r_range", "range")
    events = (
        of_row.unionByName(at_front(known, "iv_contig", F.col("iv_start").cast("long"), "iv_end"))
        .unionByName(at_front(carries, "r_contig", F.lit(-(2**63)), "carry"))
    )
    sweep = Window.partitionBy("at_contig", "range", "part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = events.withColumn("best", F.max("reach").over(sweep)).filter("kind = 1 AND best >= at_start")
    return met.select(*(F.col("whole").getField(c).alias(c) for c in df.columns))
