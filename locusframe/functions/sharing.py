"""Keeping a value from being computed once per mention."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.transform(F.array(value), body)[0]


def compute_here(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set a column that filters further up name instead of repeating its expression.

    The optimizer moves a filter below a projection by writing out the projected expressions
    inside it, once per mention. It does not do so across a generator, so the value goes through
    ``explode`` of a one-element array. The array holds a finished column, since a generator
    evaluates its input anew for each mention.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    held = df.select(*kept, value.alias(name))
    return held.select(*kept, F.explode(F.array(F.col(f"`{name}`"))).alias(name))
