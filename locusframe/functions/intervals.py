"""Interval predicates and arithmetic as Column expressions (1-based, closed intervals)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Interval(NamedTuple):
    """The three columns that make up one interval."""

    contig: Column
    start: Column
    end: Column

    @classmethod
    def of(cls, contig: str, start: str, end: str) -> "Interval":
        return cls(F.col(contig), F.col(start), F.col(end))


def normalize_contig(contig: Column) -> Column:
    """One spelling per contig: without the ``chr`` prefix, mitochondria as ``M``."""
    bare = F.when(contig.startswith("chr"), F.substring(contig, 4, 1_000_000)).otherwise(contig)
    return F.when(contig.isin("MT", "chrMT"), F.lit("M")).otherwise(bare)


def is_valid(iv: Interval) -> Column:
    return (iv.start > 0) & (iv.end >= iv.start)


def checked(iv: Interval) -> Interval:
    """Same interval, but a row with ``start <= 0`` or ``end < start`` fails the query."""
    problem = F.concat_ws(
        " ", F.lit("invalid interval"), iv.contig, iv.start.cast("string"), iv.end.cast("string")
    )
    start = F.when(is_valid(iv), iv.start).otherwise(F.raise_error(problem).cast("long"))
    return Interval(iv.contig, start, iv.end)


def overlaps(a: Interval, b: Interval) -> Column:
    return (a.contig == b.contig) & (a.start <= b.end) & (b.start <= a.end)


def intersect(a: Interval, b: Interval, strict: bool = False) -> Column:
    """Common part as a struct; null for disjoint intervals, or an error when ``strict``."""
    common = F.struct(
        a.contig.alias("contig"),
        F.greatest(a.start, b.start).alias("start"),
        F.least(a.end, b.end).alias("end"),
    )
    result = F.when(overlaps(a, b), common)
    if strict:
        result = F.when(F.coalesce(overlaps(a, b), F.lit(False)), common).otherwise(
            _fail(common, "intervals do not overlap")
        )
    return result


def span(a: Interval, b: Interval, strict: bool = False) -> Column:
    """Smallest interval holding both; null (or an error when ``strict``) across contigs."""
    both = F.struct(
        a.contig.alias("contig"),
        F.least(a.start, b.start).alias("start"),
        F.greatest(a.end, b.end).alias("end"),
    )
    same = a.contig == b.contig
    if strict:
        return F.when(F.coalesce(same, F.lit(False)), both).otherwise(
            _fail(both, "intervals lie on different contigs")
        )
    return F.when(same, both)


def _fail(like: Column, message: str) -> Column:
    """An expression that raises, shaped like ``like`` so both CASE branches have one type."""
    return F.when(F.raise_error(F.lit(message)).isNull(), F.lit(None)).otherwise(like)
