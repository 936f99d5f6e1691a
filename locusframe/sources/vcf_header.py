"""Column plan for a variant table, read from the header lines of the text form."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.sources.text import header_lines

# Column names of the genotype fields that have one of their own.
GENOTYPE_NAMES = {
    "AD": "alleleDepths",
    "DP": "depth",
    "EC": "expectedAlleleCounts",
    "FT": "filters",
    "GL": "genotypeLikelihoods",
    "GP": "posteriorProbabilities",
    "GQ": "conditionalQuality",
    "HQ": "haplotypeQualities",
    "MQ": "mappingQuality",
    "PL": "phredLikelihoods",
}

# Header type names.
SCALAR_TYPES = {
    "Integer": "int",
    "Float": "double",
    "String": "string",
    "Character": "string",
    "Flag": "boolean",
}


@dataclass(frozen=True)
class HeaderField:
    """One INFO or FORMAT declaration: its key and the Spark type of its column."""

    key: str
    kind: str
    is_array: bool


@dataclass(frozen=True)
class VcfHeader:
    info: tuple[HeaderField, ...]
    formats: tuple[HeaderField, ...]
    samples: tuple[str, ...]


def parse_header(lines: Iterable[str]) -> VcfHeader:
    """Header lines to fields. A key declared twice counts once; GT and END have columns already."""
    found: dict[str, dict[str, HeaderField]] = {"INFO": {}, "FORMAT": {}}
    samples: tuple[str, ...] = ()
    for line in lines:
        declared = re.match(r"##(INFO|FORMAT)=<(.*)>\s*$", line)
        if declared:
            field = _field(declared.group(2))
            found[declared.group(1)].setdefault(field.key, field)
        elif line.startswith("#CHROM"):
            samples = tuple(line.rstrip("\r\n").split("\t")[9:])
    found["INFO"].pop("END", None)
    found["FORMAT"].pop("GT", None)
    return VcfHeader(tuple(found["INFO"].values()), tuple(found["FORMAT"].values()), samples)


def _field(body: str) -> HeaderField:
    parts = dict(re.findall(r"(ID|Number|Type)=([^,\"]*)", body.split("Description=")[0]))
    kind = SCALAR_TYPES.get(parts.get("Type", ""))
    if "ID" not in parts or kind is None:
        raise ValueError(f"header line without a usable ID and Type: <{body}>")
    if parts.get("Number") == "0":
        kind = "boolean"
    return HeaderField(parts["ID"], kind, kind != "boolean" and parts.get("Number") != "1")


def read_header(spark: SparkSession, path: str) -> VcfHeader:
    """The fields that any file declares and the samples that all files name.

    The ``#`` lines of all files are read in one pass; only their distinct texts come to the driver. Fields
    keep the order of the first file by name, those of other files follow. Files with different samples
    or with different types for a key fail: their lines need a table each.
    """
    first = header_lines(spark, path)
    distinct = spark.read.text(path).filter(F.col("value").startswith("#")).distinct()
    others = sorted({r["value"] for r in distinct.collect()} - set(first))
    header = parse_header(first)
    known = {("INFO", f.key): f for f in header.info} | {("FORMAT", f.key): f for f in header.formats}
    for line in others:
        more = parse_header([line])
        if line.startswith("#CHROM") and more.samples != header.samples:
            raise ValueError(f"files name different samples: {header.samples} and {more.samples}")
        for place, fields in (("INFO", more.info), ("FORMAT", more.formats)):
            for field in fields:
                if known.setdefault((place, field.key), field) != field:
                    raise ValueError(f"{place} {field.key} is declared with different types")
    return parse_header([*first, *others])


def widened(one: HeaderField, other: HeaderField) -> HeaderField:
    """The narrowest field that both declarations fit: numbers become ``double``, other pairs text, single values lists."""
    if (one.kind == "boolean") != (other.kind == "boolean"):
        raise ValueError(f"{one.key} is a flag in one file and has values in another")
    kinds = {one.kind, other.kind}
    kind = one.kind if len(kinds) == 1 else "double" if kinds == {"int", "double"} else "string"
    return HeaderField(one.key, kind, one.is_array or other.is_array)


def merged_header(spark: SparkSession, path: str) -> VcfHeader:
    """The fields that any file declares, each as wide as all its declarations need; no samples.

    Unlike :func:`read_header` it takes files whose declarations differ. Their samples are those of
    :func:`file_samples`. Only distinct declarations come to the driver.
    """
    first = header_lines(spark, path)
    declared = F.col("value").startswith("##INFO=") | F.col("value").startswith("##FORMAT=")
    distinct = {r["value"] for r in spark.read.text(path).filter(declared).distinct().collect()}
    info: dict[str, HeaderField] = {}
    formats: dict[str, HeaderField] = {}
    for line in [*(h for h in first if h in distinct), *sorted(distinct - set(first))]:
        more = parse_header([line])
        for known, fields in ((info, more.info), (formats, more.formats)):
            for field in fields:
                known[field.key] = widened(known.get(field.key, field), field)
    return VcfHeader(tuple(info.values()), tuple(formats.values()), ())


def file_samples(spark: SparkSession, path: str) -> DataFrame:
    """(sample_file, sample_ids) of each file: the names in its own ``#CHROM`` line.

    A file without such a line, as a table written in parts has them, takes that of the nearest file before it by name in
    its folder; ``sample_ids`` is null if there is none. A file with different ``#CHROM`` lines fails. The
    window sees one row per file, not the rows of the files.
    """
    cells = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    named = (
        spark.read.text(path)
        .filter(F.col("value").startswith("#CHROM"))
        .select(F.col("_metadata.file_path").alias("of_file"), cells.alias("cells"))
        .groupBy("of_file")
        .agg(F.min("cells").alias("cells"), F.max("cells").alias("other"))
    )
    differ = F.raise_error(F.concat(F.lit("different #CHROM lines in "), F.col("of_file")))
    checked = F.when(F.col("cells") != F.col("other"), differ.cast("array<string>")).otherwise(
        F.slice("cells", 10, F.greatest(F.size("cells") - 9, F.lit(0)))
    )
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("sample_file"))
    own = files.join(named.select("of_file", checked.alias("own")), F.col("of_file") == F.col("sample_file"), "left")
    before = Window.partitionBy(F.regexp_extract("sample_file", "^(.*)/[^/]*$", 1)).orderBy("sample_file")
    return own.select("sample_file", F.last("own", ignorenulls=True).over(before).alias("sample_ids"))
