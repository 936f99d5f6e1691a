"""The sparse-matrix join: long values against two indexed dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.functions.lines import spread_key
from locusframe.operators.lookup import lookup_join


def matrix_join(
    matrix: DataFrame,
    features: DataFrame,
    barcodes: DataFrame,
    gene: str = "gene",
    cell: str = "cell",
    feature_index: str = "feature_index",
    barcode_index: str = "barcode_index",
) -> DataFrame:
    """Matrix rows with their feature and barcode, ordered by cell, then gene descending.

    The last sort key only spreads rows of one (cell, gene) over several sort ranges.
    """
    named = lookup_join(matrix, features, on=[(gene, feature_index)])
    named = lookup_join(named, barcodes, on=[(cell, barcode_index)])
    columns = named.columns
    spread = named.withColumn("tie", spread_key(*columns))
    return spread.orderBy(F.col(cell).asc(), F.col(gene).desc(), "tie").select(*columns)
