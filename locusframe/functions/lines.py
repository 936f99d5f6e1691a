"""Column expressions for tab-separated text lines and fixed-width binary fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED_FLAG = 4


def field(row: Column, position: int) -> Column:
    """0-based tab field; null when the line is too short."""
    return F.get(F.split(row, "\t"), F.lit(position))


def int_field(row: Column, position: int) -> Column:
    """0-based tab field as a long, null on a short line. Text that is not a number fails the query.

    The error names the class that a cast in ANSI mode gives, and is raised without that mode, too.
    """
    text = field(row, position)
    wrong = F.raise_error(F.concat(F.lit("CAST_INVALID_INPUT, not an integer: "), text)).cast("long")
    return F.when(text.isNotNull(), F.coalesce(text.try_cast("long"), wrong))


def is_header(row: Column) -> Column:
    """Header lines are empty or start with ``#``."""
    return (row == "") | row.startswith("#")


def join_fields(columns: Sequence[str | Column], sep: str = "\t") -> Column:
    """All values in one line. A null prints as ``null`` (``concat_ws`` would drop the field)."""
    texts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(sep, *[F.coalesce(t.cast("string"), F.lit("null")) for t in texts])


def u16_le(raw: Column, offset: int) -> Column:
    """Unsigned little-endian 16-bit number at a 0-based byte offset."""
    low, high = F.substring(raw, offset + 1, 1), F.substring(raw, offset + 2, 1)
    return F.conv(F.concat(F.hex(high), F.hex(low)), 16, 10).cast("int")


def raw_flags(raw: Column) -> Column:
    """Flag word of a raw alignment record."""
    return u16_le(raw, 18)


def is_unmapped(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(UNMAPPED_FLAG)) != 0


def spread_key(*columns: str | Column) -> Column:
    """Hash that differs between copies of a row held by different input partitions.

    Used as a salt and as the last sort key. It is a function of the row and its input
    partition, so a recomputed task gives every row the same value again.
    """
    return F.xxhash64(F.spark_partition_id(), *columns)
