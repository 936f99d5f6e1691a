"""SQL over named tables: localisation, parameterised scripts, inserts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from locusframe.operators.sinks import write_partitioned_table

_NAME = re.compile(r"^[A-Za-z_]\w*$")


def _split_name(name: str) -> tuple[str, str]:
    parts = name.split(".")
    if len(parts) != 2 or not all(_NAME.match(p) for p in parts):
        raise ValueError(f"table name must be <namespace>.<table>: {name!r}")
    return parts[0], parts[1]


def localize_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Make the frame known to SQL as ``namespace.table`` and as a global temporary view.

    The view ``global_temp.namespace_table`` is replaced. A table of that name that exists
    already is left as it is. Returns the input.
    """
    namespace, table = _split_name(name)
    spark = df.sparkSession
    view = f"{namespace}_{table}"
    df.createOrReplaceGlobalTempView(view)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{namespace}`")
    place = "LOCATION '{}'".format(path.replace("'", "\\'")) if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{table}` USING parquet {place} "
        f"AS SELECT * FROM global_temp.`{view}`"
    )
    return df


def sql_task(
    spark: SparkSession,
    sql: str,
    tables: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
    output: str | None = None,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Run a script's statement over input frames, known to it as temporary views.

    ``params`` are bound to ``:name`` markers; ``IDENTIFIER(:name)`` takes a column or table
    name. With ``output`` the result is stored as that table and read back from it.
    """
    for view, frame in (tables or {}).items():
        frame.createOrReplaceTempView(view)
    result = spark.sql(sql, args=dict(params)) if params else spark.sql(sql)
    if output is None:
        return result
    namespace, _ = _split_name(output)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{namespace}`")
    write_partitioned_table(result, output, partition_by, path)
    return spark.table(output)
