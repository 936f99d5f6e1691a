"""Variant text lines to typed rows, in Column expressions only.

Coordinates of the result are 0-based and half-open: ``start = POS - 1`` and
``end = start + length(REF)`` unless INFO has an ``END``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import lines
from locusframe.functions.sharing import compute_here, once
from locusframe.operators.lookup import lookup_join
from locusframe.operators.overlap import overlap_filter
from locusframe.sources.vcf_header import GENOTYPE_NAMES, HeaderField, VcfHeader, file_samples, merged_header

MISSING_ALLELE = -1
# The leading columns of a variant line.
FIXED_COLUMNS = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO")


def _known(text: Column) -> Column:
    """Null for an empty text or a lone dot."""
    return F.when((text != "") & (text != "."), text)


def _number(text: Column, kind: str) -> Column:
    """Typed value of a known text, null when it cannot be read.

    A failing cast costs an exception, so frequent non-numbers such as a dot are to be null already.
    """
    if kind == "string":
        return text
    if kind == "double":
        # The cast reads nan, inf, +inf and -inf in any case, but no signed nan.
        return F.when(F.lower(text).isin("+nan", "-nan"), F.lit(float("nan"))).otherwise(
            text.try_cast("double")
        )
    # Whole numbers written with a fraction lose it.
    return F.coalesce(
        text.try_cast(kind),
        F.when(text.rlike(r"^[+-]?\d+\.\d*$"), F.substring_index(text, ".", 1)).try_cast(kind),
    )


def _without_last(text: Column, sep: str) -> Column:
    return F.when(text.endswith(sep), F.left(text, F.length(text) - 1)).otherwise(text)


def _list(text: Column, kind: str = "string", sep: str = ",", strict: bool = False) -> Column:
    """A separated list. With ``strict`` one unreadable element voids the whole list.

    One trailing separator adds no element. A lone missing element is no list at all; several
    missing ones are an empty list.
    """
    tokens = F.transform(F.split(_without_last(text, sep), sep), _known)

    def tidy(values: Column) -> Column:
        return F.when(F.size(F.array_compact(values)) > 0, values).when(
            F.size(values) > 1, F.slice(values, 1, 0)
        )

    def typed(known: Column) -> Column:
        values = F.transform(known, lambda t: _number(t, kind))
        if not strict:
            return once(values, tidy)
        return once(
            values,
            lambda v: F.when(F.size(F.array_compact(v)) == F.size(F.array_compact(known)), tidy(v)),
        )

    if kind == "string":
        return once(tokens, tidy)
    return once(tokens, typed)


def _value(text: Column, field: HeaderField, strict: bool) -> Column:
    """A field's typed value; ``text`` is null when the field is missing."""
    if field.is_array:
        return _list(text, field.kind, strict=strict)
    return _number(text, field.kind)


def _info_text(info: Column, key: str) -> Column:
    """Text after the key's last ``key=``; empty when there is none."""
    return F.regexp_extract(info, rf"^(?:.*;)?\Q{key}\E=([^;]*)", 1)


def _info_flag(info: Column, key: str) -> Column:
    return F.coalesce(info.rlike(rf"(?:^|;)\Q{key}\E(?:[=;]|$)"), F.lit(False))


def parse_variants(
    df: DataFrame,
    header: VcfHeader,
    row: str = "row",
    list_sep: str = ",",
    mode: str = "failfast",
    intervals: DataFrame | None = None,
    partitions: int | None = None,
    genotypes: bool = True,
    samples: str | None = None,
) -> DataFrame:
    """Typed variant table of text lines; header lines and empty lines give no row.

    Columns: contigName, start, end, names, referenceAllele, alternateAlleles, qual, filters,
    splitFromMultiAllelic, one ``INFO_<key>`` per declared key, and ``genotypes``, an array of
    structs (sampleId, calls, phased, one field per declared FORMAT key).

    A line without a readable position, reference allele or quality, or with too few fields,
    fails the query, or with ``mode="permissive"`` keeps its text in ``_corrupt``. A value of an
    INFO or FORMAT field that does not fit its type is null. ``list_sep`` separates names,
    alternates and filters. ``intervals`` (contig, start, end) drops variants that overlap none
    of them before genotypes are parsed. ``partitions`` asks for a round-robin shuffle.
    ``genotypes=False`` leaves the genotypes out; unlike the other columns they are parsed even
    where a query does not use them. ``samples`` names a column with the sample ids of each line, which
    then stand for those of the header; a line with genotypes but without ids fails.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    # One select per stage: each later expression names a column instead of repeating its text.
    ids = [F.col(samples).alias("line_samples")] if samples and genotypes else []
    cells = df.filter(~lines.is_header(F.col(row))).select(
        F.col(row).alias("line"), F.split(row, "\t").alias("cell"), *ids
    )

    def cell(i: int) -> Column:
        return F.get("cell", F.lit(i))

    def blank(i: int) -> Column:
        return F.coalesce(cell(i).isin("", "."), F.lit(True))

    broken = (
        (F.size("cell") < 8)
        | (F.size("cell") == 9)
        | blank(1)
        | cell(1).try_cast("long").isNull()
        | blank(3)
        | (~blank(5) & _number(cell(5), "double").isNull())
    )
    if mode == "failfast":
        # Part of the value all columns come from, so no column can be read past a bad line.
        message = F.concat(F.lit("unreadable variant line: "), F.col("line"))
        checked = F.when(broken, F.raise_error(message)).otherwise(F.col("cell"))
        corrupt = []
    else:
        checked = F.col("cell")
        corrupt = ["_corrupt"]
    flagged = [F.when(broken, F.col("line")).alias(c) for c in corrupt]
    if ids:
        flagged.append(F.col("line_samples"))
        corrupt = [*corrupt, "line_samples"]
    cells = compute_here(cells.select(*flagged, checked.alias("cell")), "cell", F.col("cell"))

    valued = [f for f in header.info if f.kind != "boolean"]
    texts = cells.select(
        "cell",
        *corrupt,
        *[cell(i).alias(f"text_{name}") for i, name in enumerate(FIXED_COLUMNS)],
        _info_text(cell(7), "END").alias("text_END"),
        *[_info_text(cell(7), f.key).alias(f"text_INFO_{f.key}") for f in valued],
    )
    as_is = ["cell", *corrupt, "text_INFO"]
    known = texts.select(
        *as_is, *[_known(F.col(f"`{c}`")).alias(c) for c in texts.columns if c not in as_is]
    )
    parsed = known.withColumn("start", F.col("text_POS").try_cast("long") - 1)
    info = {
        f.key: _info_flag(F.col("text_INFO"), f.key)
        if f.kind == "boolean"
        else _value(F.col(f"`text_INFO_{f.key}`"), f, strict=True)
        for f in header.info
    }
    core = parsed.select(
        "cell",
        *corrupt,
        F.col("text_CHROM").alias("contigName"),
        "start",
        F.coalesce(_number(F.col("text_END"), "long"), F.col("start") + F.length("text_REF")).alias("end"),
        _list(F.col("text_ID"), sep=list_sep).alias("names"),
        F.col("text_REF").alias("referenceAllele"),
        _list(F.col("text_ALT"), sep=list_sep).alias("alternateAlleles"),
        _number(F.col("text_QUAL"), "double").alias("qual"),
        _list(F.col("text_FILTER"), sep=list_sep).alias("filters"),
        F.lit(False).alias("splitFromMultiAllelic"),
        *[value.alias(f"INFO_{key}") for key, value in info.items()],
    )
    if intervals is not None:
        core = overlap_filter(
            core.withColumn("first_base", F.col("start") + 1),
            intervals,
            contig="contigName",
            start="first_base",
            end="end",
        ).drop("first_base")
    table = _with_genotypes(core, header) if genotypes and (header.samples or ids) else core.drop("cell")
    return table.repartition(partitions) if partitions else table


def parse_variant_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """:func:`parse_variants` of files that need not agree in samples or in the types of their fields.

    A field has the type that fits all declarations. A line's genotypes carry the sample ids of its own file; the
    table of files is joined to the lines by file name, by broadcast while it is small.
    """
    data = spark.read.text(path).select(F.col("value").alias("row"), F.col("_metadata.file_path").alias("line_file"))
    data = data.filter(~lines.is_header(F.col("row")))
    if not options.get("genotypes", True):
        return parse_variants(data, merged_header(spark, path), **options)
    named = lookup_join(data, file_samples(spark, path), on=[("line_file", "sample_file")], how="left")
    return parse_variants(named.select("row", "sample_ids"), merged_header(spark, path), samples="sample_ids", **options)


def _with_genotypes(core: DataFrame, header: VcfHeader) -> DataFrame:
    """Replace ``cell`` by the parsed genotypes of the samples present on the line."""
    names = F.split(F.get("cell", F.lit(8)), ":")
    kept = [c for c in core.columns if c not in ("cell", "line_samples")]
    sample_ids = F.array(*[F.lit(s) for s in header.samples])
    count: Column | int = len(header.samples)
    own = [F.col("line_samples")] if "line_samples" in core.columns else []
    if own:
        sample_ids = F.col("line_samples")
        unnamed = F.raise_error(F.lit("a variant line has genotypes, but its file has no #CHROM line"))
        count = F.coalesce(F.size("line_samples"), unnamed.cast("int"))

    def place(key: str) -> Column:
        """1-based place of a key in FORMAT, null when it is not there."""
        found = F.array_position(names, key).cast("int")
        return F.when(found > 0, found)

    split_samples = F.when(
        F.size("cell") > 9,
        F.transform(F.slice("cell", 10, count), lambda s: F.split(s, ":")),
    )
    opened = core.select(
        *kept,
        *own,
        split_samples.alias("sample_values"),
        place("GT").alias("place_GT"),
        *[place(f.key).alias(f"place_{f.key}") for f in header.formats],
    )

    def at(values: Column, key: str) -> Column:
        return F.try_element_at(values, F.col(f"place_{key}"))

    def missing_or(values: Column, field: HeaderField) -> Column:
        if field.is_array:
            return once(at(values, field.key), lambda t: _value(_known(t), field, strict=False))
        return once(_known(at(values, field.key)), lambda t: _value(t, field, strict=False))

    def genotype(values: Column, i: Column) -> Column:
        # A sample without any text has no genotype; one with an empty GT has a missing allele.
        gt = F.when((F.size(values) > 1) | (values[0] != ""), at(values, "GT"))
        # Splitting at one plain character needs no regular expression.
        calls = F.transform(
            F.split(F.translate(gt, "|", "/"), "/"),
            lambda a: F.coalesce(_number(_known(a), "int"), F.lit(MISSING_ALLELE)),
        )
        return F.struct(
            F.get(sample_ids, i).alias("sampleId"),
            calls.alias("calls"),
            F.substring_index(gt, "/", 1).contains("|").alias("phased"),
            *[missing_or(values, f).alias(GENOTYPE_NAMES.get(f.key, f.key)) for f in header.formats],
        )

    typed = opened.select(*kept, F.transform("sample_values", genotype).alias("genotypes"))
    return compute_here(typed, "genotypes", F.col("genotypes"))
