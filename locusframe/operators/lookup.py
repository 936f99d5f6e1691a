"""Equi join against a lookup table: broadcast if it is small, else by shuffle with only the heavy keys salted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, NumericType, StringType

from locusframe.functions.lines import spread_key

MAX_BROADCAST_ROWS = 1_000_000
"""Rows of a few numbers and a short name, so about 100 MB in an executor at the limit."""

MAX_BROADCAST_BYTES = 100_000_000

SALTS = 64
"""Tasks that one heavy key's rows are spread over, at most."""

HEAVY_SHARE = 1_000
"""A key is heavy if it holds more than one in so many rows; so there are at most so many of them."""


def _width(name: str, kind: DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, NumericType):
        return F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 8


def fits_broadcast(table: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether rows and bytes, both counted, are within the limits; reads at most one row past the first."""
    width = reduce(lambda a, b: a + b, [_width(f.name, f.dataType) for f in table.schema.fields], F.lit(16))
    size = table.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return size[0] <= max_rows and size[1] <= max_bytes


def heavy_keys(keys: DataFrame, share: int = HEAVY_SHARE, salts: int = SALTS) -> list[tuple[int, int]]:
    """(key, parts) of the values of a one-column frame of longs that hold more than one in ``share`` rows.

    One pass with a sketch of bounded size for each task; no key is shuffled. The sketch misses no such value. ``parts``
    grows with the value's rows, up to ``salts``.
    """
    top = F.expr(f"approx_top_k(`{keys.columns[0]}`, {share}, {20 * share})")
    found = keys.agg(top.alias("top"), F.count("*").alias("n")).first()
    light = found["n"] / share
    return [(e["item"], min(salts, int(e["count"] // light) + 1)) for e in found["top"] or [] if e["item"] is not None and e["count"] > light]


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    residual: Column | None = None,
    table_rows: int | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
    share: int = HEAVY_SHARE,
) -> DataFrame:
    """Join ``big`` to ``table`` on column pairs; ``how`` is inner, left or left_semi.

    ``table_rows`` is an upper bound on the size of a table of narrow rows. Without one the table's rows and bytes are
    counted, at most one row past the limit. A table within the limits is broadcast and ``big`` is not shuffled.

    A larger one is joined by shuffle. A sketch of the keys of ``big`` tells the heavy ones, at most ``share``: their rows are
    dealt over several parts, and only their rows of ``table`` are repeated for each part. All other rows of both
    sides are sent once, by their key.

    Key columns of ``table`` are dropped from the result. Column names must not clash.
    """
    if table_rows is None:
        small = fits_broadcast(table, max_broadcast_rows)
    else:
        small = table_rows <= max_broadcast_rows
    same = [F.col(left) == F.col(right) for left, right in on]
    dropped = [right for _, right in on]
    if small:
        table = F.broadcast(table)
    else:
        # A key's hash has to be that of the type it has in ``big``, or equal keys would be told apart.
        kinds = [big.schema[left].dataType for left, _ in on]
        of_big = F.xxhash64(*(F.col(left) for left, _ in on))
        of_table = F.xxhash64(*(F.col(right).try_cast(kind) for (_, right), kind in zip(on, kinds, strict=True)))
        heavy = heavy_keys(big.select(of_big.alias("key_hash")), share, salts)
        if heavy:
            parts = big.sparkSession.createDataFrame(heavy, "heavy_hash long, heavy_parts int")
            big = big.join(F.broadcast(parts), of_big == F.col("heavy_hash"), "left")
            part = F.pmod(spread_key(*(c for c in big.columns if not c.startswith("heavy_"))), F.col("heavy_parts"))
            big = big.withColumn("salt_big", F.coalesce(part, F.lit(0)).cast("int")).drop("heavy_hash", "heavy_parts")
            table = table.join(F.broadcast(parts), of_table == F.col("heavy_hash"), "left")
            every = F.sequence(F.lit(0), F.coalesce("heavy_parts", F.lit(1)) - 1)
            table = table.withColumn("salt_table", F.explode(every)).drop("heavy_hash", "heavy_parts")
            same.append(F.col("salt_big") == F.col("salt_table"))
            dropped += ["salt_big", "salt_table"]
    condition = reduce(lambda a, b: a & b, same + ([] if residual is None else [residual]))
    return big.join(table, condition, how).drop(*dropped)
