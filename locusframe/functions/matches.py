"""Set-like expressions over ``array<struct<region_key, part_id>>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locusframe.functions.sharing import once


def part_ids(matches: Column) -> Column:
    return F.array_distinct(F.transform(matches, lambda m: m["part_id"]))


def first_per_part(matches: Column) -> Column:
    """Keep the first match of every partition, in array order."""

    def firsts(found: Column, parts: Column) -> Column:
        return F.filter(
            found, lambda m, i: F.array_position(parts, m["part_id"]) == i.cast("long") + 1
        )

    return once(
        matches,
        lambda found: once(
            F.transform(found, lambda m: m["part_id"]), lambda parts: firsts(found, parts)
        ),
    )


def region_keys(matches: Column) -> Column:
    return F.transform(matches, lambda m: m["region_key"])
