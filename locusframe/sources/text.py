"""Delimited text, line tables, directories of part files, and unions of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.functions import lines


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines as one ``row`` column."""
    return spark.read.text(path).withColumnRenamed("value", "row")


def split_header(df: DataFrame, row: str = "row") -> tuple[DataFrame, DataFrame]:
    """(header lines, data lines). An empty line counts as header and holds no data."""
    header = lines.is_header(F.col(row))
    return df.filter(header), df.filter(~header)


def read_bed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """BED data lines as ``row`` plus contig, start and end."""
    _, data = split_header(read_lines(spark, path))
    row = F.col("row")
    return data.select(
        "row",
        lines.field(row, 0).alias("contig"),
        lines.int_field(row, 1).alias("start"),
        lines.int_field(row, 2).alias("end"),
    )


def header_lines(spark: SparkSession, path: str | Sequence[str], first: int = 1000) -> list[str]:
    """The leading ``#`` lines of one file, by name order the first.

    Headers stand at the top, so only the start of that file is read, not the data set.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        return []
    wanted = first
    while True:
        top = [r["value"] for r in spark.read.text(files[0]).head(wanted)]
        header: list[str] = []
        for line in top:
            if not line.startswith("#"):
                return header
            header.append(line)
        if len(top) < wanted:
            return header
        wanted *= 8


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    header: bool = False,
    sep: str = ",",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Delimited files; without header and schema the columns are strings ``_c0``, ``_c1``, …"""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def positional_schema(spec: Mapping[str, object]) -> T.StructType:
    """Schema from ``{"1:CHROM": "String", "2:POS": 0, ...}``.

    The number is the column's 1-based position and the value an example of its type.
    """
    kinds = ((bool, T.BooleanType()), (int, T.LongType()), (float, T.DoubleType()), (str, T.StringType()))
    placed: list[tuple[int, T.StructField]] = []
    for key, example in spec.items():
        position, _, name = key.partition(":")
        kind = next((t for python, t in kinds if isinstance(example, python)), None)
        if not position.isdigit() or not name or kind is None:
            raise ValueError(f"bad column specification {key!r}: {example!r}")
        if isinstance(kind, T.LongType) and abs(int(example)) < 2**31:
            kind = T.IntegerType()
        placed.append((int(position), T.StructField(name, kind)))
    placed.sort(key=lambda item: item[0])
    if [p for p, _ in placed] != list(range(1, len(placed) + 1)):
        raise ValueError("column positions must run from 1 without a gap")
    return T.StructType([f for _, f in placed])


def read_typed_tsv(
    spark: SparkSession, path: str | Sequence[str], spec: Mapping[str, object], header: bool = False
) -> DataFrame:
    return read_csv(spark, path, header, "\t", positional_schema(spec))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """One row (part_id, fqn) per file. Only names are listed; contents are not read.

    ``part-00007-x.txt`` belongs to partition 7. A single file is partition 0.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    number = F.regexp_extract(F.col("path"), r"part-(\d+)[^/]*$", 1)
    return files.select(
        F.when(number == "", F.lit(0)).otherwise(number.try_cast("int")).alias("part_id"),
        F.col("path").alias("fqn"),
    )


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, duplicates kept; a column missing from a table is null there."""
    if not tables:
        raise ValueError("no tables to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
