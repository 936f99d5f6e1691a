"""Queries over variant text, typed variant tables and genotype statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import genetics, sqlfunctions
from locusframe.operators import regions, sinks, sqltask, variants
from locusframe.plans import inputs
from locusframe.plans.registry import query
from locusframe.session import shared_path
from locusframe.sources import layouts, text
from locusframe.sources.vcf_header import parse_header, read_header


def _written_vcf(spark: SparkSession, sf: str) -> str:
    """The variant lines as a directory of text files, the header in the first of them."""
    path = shared_path(spark, "vcf")
    header = spark.createDataFrame([("\n".join(inputs.VCF_HEADER),)], "value string").coalesce(1)
    data = inputs.vcf_lines(spark, sf).select(F.col("row").alias("value"))
    header.unionByName(data).write.text(path)
    return path


@query("vcf_scan", f"WITH {inputs.VCF_LINES_SQL} SELECT row FROM vcf")
def vcf_scan(spark: SparkSession, sf: str) -> DataFrame:
    _, data = text.split_header(text.read_lines(spark, _written_vcf(spark, sf)))
    return data


@query(
    "header_filter",
    f"""WITH {inputs.VCF_LINES_SQL}
SELECT true AS is_header, {len(inputs.VCF_HEADER)} AS n_lines UNION ALL SELECT false, count(*) FROM vcf""",
)
def header_filter(spark: SparkSession, sf: str) -> DataFrame:
    header, data = text.split_header(text.read_lines(spark, _written_vcf(spark, sf)))
    return header.agg(F.lit(True).alias("is_header"), F.count("*").alias("n_lines")).unionByName(
        data.agg(F.lit(False).alias("is_header"), F.count("*").alias("n_lines"))
    )


@query(
    "bed_scan",
    f"""WITH {inputs.BED_LINES_SQL} SELECT row, contig, s AS "start", e AS "end" FROM bed""",
)
def bed_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "bed")
    comment = spark.createDataFrame([("# contig start end name",), ("",)], "value string").coalesce(1)
    data = inputs.bed_lines(spark, sf).select(F.col("row").alias("value"))
    comment.unionByName(data).write.text(path)
    return text.read_bed(spark, path)


def _parsed(spark: SparkSession, sf: str, genotypes: bool = False) -> DataFrame:
    header = parse_header(inputs.VCF_HEADER)
    return variants.parse_variants(inputs.vcf_lines(spark, sf), header, genotypes=genotypes)


def _list_text(values: Column) -> Column:
    """A list as ``[a,b]`` with ``null`` for missing elements; null for no list."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ",", "null"), F.lit("]"))


CORE_SQL = """contig AS "contigName", p - 1 AS "start",
  CASE WHEN k % 10 = 3 AND k % 8 <> 0 THEN p + 100
       ELSE p - 1 + CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END END AS "end",
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '[rs' || k || ',alt' || k || ']' ELSE '[rs' || k || ']' END AS names,
  CASE k % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'AT' ELSE 'GCC' END AS "referenceAllele",
  CASE k % 3 WHEN 0 THEN '[G]' WHEN 1 THEN '[T,C]' END AS "alternateAlleles",
  CASE WHEN k % 7 <> 0 THEN k % 100 + 0.5::DOUBLE END AS qual,
  CASE k % 3 WHEN 0 THEN '[PASS]' WHEN 1 THEN '[q10,s50]' ELSE '[]' END AS filters"""


def _core_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "contigName",
        "start",
        "end",
        _list_text(F.col("names")).alias("names"),
        "referenceAllele",
        _list_text(F.col("alternateAlleles")).alias("alternateAlleles"),
        "qual",
        _list_text(F.col("filters")).alias("filters"),
    )


@query("vcf_core_fields", f"WITH {inputs.VCF_LINES_SQL} SELECT {CORE_SQL} FROM vcf")
def vcf_core_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _core_columns(_parsed(spark, sf))


INFO_SQL = """
  CASE WHEN k % 8 <> 0 AND k % 13 <> 0 THEN k % 50 END AS "INFO_DP",
  CASE WHEN k % 8 <> 0 THEN '[0.25,' || CASE WHEN k % 3 = 0 THEN 'null' ELSE '0.5' END || ']' END AS "INFO_AF",
  CASE WHEN k % 8 <> 0 AND k % 17 <> 0 THEN '[' || (k % 5) || ',7]' END AS "INFO_AC",
  k % 8 <> 0 AND k % 6 = 1 AS "INFO_DB",
  CASE WHEN k % 8 <> 0 THEN st END AS "INFO_KIND" """


@query(
    "vcf_info_fields",
    f"""WITH {inputs.VCF_LINES_SQL} SELECT contig AS "contigName", p - 1 AS "start", {INFO_SQL} FROM vcf""",
)
def vcf_info_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        "contigName",
        "start",
        "INFO_DP",
        _list_text(F.col("INFO_AF")).alias("INFO_AF"),
        _list_text(F.col("INFO_AC")).alias("INFO_AC"),
        "INFO_DB",
        "INFO_KIND",
    )


GENOTYPES_SQL = """
SELECT contig AS "contigName", p - 1 AS "start", 'S' || (i + 1) AS "sampleId",
  CASE (k + i) % 4 WHEN 0 THEN '[0,0]' WHEN 1 THEN '[0,1]' WHEN 2 THEN '[1,1]' ELSE '[-1,-1]' END AS calls,
  (k + i) % 4 = 1 AS phased,
  CASE WHEN (k + i) % 9 <> 0 THEN (k + i) % 30 END AS depth,
  CASE WHEN (k + i) % 9 <> 0 THEN '[' || (k % 7) || ',null,' || (k % 11) || ']' END AS "alleleDepths"
FROM vcf, range(0, 3) t(i)"""


@query("vcf_genotypes", f"WITH {inputs.VCF_LINES_SQL} {GENOTYPES_SQL}")
def vcf_genotypes(spark: SparkSession, sf: str) -> DataFrame:
    samples = _parsed(spark, sf, genotypes=True).select("contigName", "start", F.explode("genotypes").alias("g"))
    return samples.select(
        "contigName",
        "start",
        "g.sampleId",
        _list_text(F.col("g.calls")).alias("calls"),
        "g.phased",
        "g.depth",
        _list_text(F.col("g.alleleDepths")).alias("alleleDepths"),
    )


@query(
    "vcf_to_table",
    f"""WITH {inputs.VCF_LINES_SQL},
g AS (
  SELECT k, string_agg('S' || (i + 1) || CASE (k + i) % 4 WHEN 0 THEN '[0,0]' WHEN 1 THEN '[0,1]'
                       WHEN 2 THEN '[1,1]' ELSE '[-1,-1]' END, ';' ORDER BY i) AS genotypes
  FROM vcf, range(0, 3) t(i) GROUP BY k)
SELECT {CORE_SQL}, false AS "splitFromMultiAllelic", {INFO_SQL}, genotypes FROM vcf JOIN g USING (k)""",
)
def vcf_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """From text files on: header read from the files, then every column of the typed table."""
    path = _written_vcf(spark, sf)
    typed = variants.parse_variants(text.read_lines(spark, path), read_header(spark, path))
    calls = F.transform("genotypes", lambda g: F.concat(g["sampleId"], _list_text(g["calls"])))
    return typed.select(
        "contigName",
        "start",
        "end",
        _list_text(F.col("names")).alias("names"),
        "referenceAllele",
        _list_text(F.col("alternateAlleles")).alias("alternateAlleles"),
        "qual",
        _list_text(F.col("filters")).alias("filters"),
        "splitFromMultiAllelic",
        "INFO_DP",
        _list_text(F.col("INFO_AF")).alias("INFO_AF"),
        _list_text(F.col("INFO_AC")).alias("INFO_AC"),
        "INFO_DB",
        "INFO_KIND",
        F.array_join(calls, ";").alias("genotypes"),
    )


#: What the files of odd keys declare instead: other samples, a wider type, one more field.
OTHER_HEADER = [
    *(h.replace("ID=DP,Number=1,Type=Integer", "ID=DP,Number=1,Type=Float") for h in inputs.VCF_HEADER[:-1]),
    '##INFO=<ID=OTHER,Number=1,Type=Integer,Description="Other">',
    inputs.VCF_HEADER[-1].replace("S1\tS2\tS3", "S3\tS9\tS1"),
]


@query(
    "vcf_multi_header",
    f"""WITH {inputs.VCF_LINES_SQL}
SELECT contig AS "contigName", p - 1 AS "start",
  CASE WHEN k % 8 <> 0 AND k % 13 <> 0 THEN (k % 50)::DOUBLE END AS "INFO_DP",
  CASE WHEN k % 8 <> 0 THEN 1 END AS "INFO_OTHER",
  CASE WHEN k % 2 = 0 THEN ['S1', 'S2', 'S3'][i + 1] ELSE ['S3', 'S9', 'S1'][i + 1] END AS "sampleId",
  CASE (k + i) % 4 WHEN 0 THEN '[0,0]' WHEN 1 THEN '[0,1]' WHEN 2 THEN '[1,1]' ELSE '[-1,-1]' END AS calls,
  CASE WHEN (k + i) % 9 <> 0 THEN ((k + i) % 30)::DOUBLE END AS depth
FROM vcf, range(0, 3) t(i)""",
)
def vcf_multi_header(spark: SparkSession, sf: str) -> DataFrame:
    """Two sets of files, in parts, that name different samples and declare DP differently."""
    path = shared_path(spark, "vcf-sets")
    data = inputs.vcf_lines(spark, sf)
    for folder, header, odd in (("a", inputs.VCF_HEADER, 0), ("b", OTHER_HEADER, 1)):
        top = spark.createDataFrame([("\n".join(header),)], "value string").coalesce(1)
        rows = data.filter(F.col("id") % 2 == odd).select(F.col("row").alias("value"))
        top.unionByName(rows).write.text(f"{path}/{folder}")
    typed = variants.parse_variant_files(spark, f"{path}/*")
    samples = typed.select("contigName", "start", "INFO_DP", "INFO_OTHER", F.explode("genotypes").alias("g"))
    return samples.select(
        "contigName", "start", "INFO_DP", "INFO_OTHER", "g.sampleId", _list_text(F.col("g.calls")).alias("calls"), "g.depth"
    )


@query("hwe_counts", f"WITH {inputs.COHORT_SQL} SELECT * FROM counts")
def hwe_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = inputs.cohort(spark, sf).select("id", genetics.genotype_counts(F.col("genotypes")).alias("n"))
    return counted.select("id", "n.*")


HWE_SQL = f"""WITH {inputs.COHORT_SQL},
sizes AS (
  SELECT *, hom_ref + het + hom_alt AS n, 2 * least(hom_ref, hom_alt) + het AS m FROM counts),
outcomes AS (
  SELECT *, unnest(range(m % 2, m + 1, 2)) AS h FROM sizes),
logs AS (
  SELECT *, h * ln(2) + lgamma(n + 1) - lgamma((m - h) // 2 + 1) - lgamma(h + 1)
            - lgamma((2 * n - m - h) // 2 + 1) + lgamma(m + 1) + lgamma(2 * n - m + 1)
            - lgamma(2 * n + 1) AS lp
  FROM outcomes),
tails AS (
  SELECT id, n, m, lp, max(lp) FILTER (h = het) OVER (PARTITION BY id) AS seen FROM logs)
SELECT id, round(m * (2 * n - m) / (2.0 * n - 1.0) / n, 6) AS het_freq,
       round(least(1.0, sum(exp(lp)) FILTER (lp <= seen + 1e-9)), 6) AS p_value
FROM tails GROUP BY id, n, m"""


def _rounded(tested: DataFrame) -> DataFrame:
    return tested.select(
        "id",
        F.round("hwe.hetFreqHwe", 6).alias("het_freq"),
        F.round("hwe.pValueHwe", 6).alias("p_value"),
    )


@query("hwe_test", HWE_SQL)
def hwe_test(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(genetics.add_hardy_weinberg(inputs.cohort(spark, sf)))


@query("sql_hardy_weinberg", HWE_SQL)
def sql_hardy_weinberg(spark: SparkSession, sf: str) -> DataFrame:
    """The test called by name from a script's statement, over a column that a parameter names."""
    cohort = inputs.cohort(spark, sf)
    sqlfunctions.register_genetics(spark, cohort.schema["genotypes"].dataType)
    script = "SELECT id, hardy_weinberg(IDENTIFIER(:col)) AS hwe FROM cohort"
    return _rounded(sqltask.sql_task(spark, script, {"cohort": cohort}, {"col": "genotypes"}))


def _region_files_sql(lines: str, header: int) -> str:
    """Lines per region of the 23-partition layout, whose last region has no rows."""
    return f"""{lines},
parts AS (SELECT p0 AS part_id FROM range(0, 23) t(p0)),
n AS (SELECT c - 1 AS part_id, count(*) AS n FROM source GROUP BY 1)
SELECT parts.part_id, {header} AS n_header, coalesce(n, 0) AS n_rows FROM parts LEFT JOIN n USING (part_id)"""


def _read_back(spark: SparkSession, path: str, is_header: Column) -> DataFrame:
    lines = spark.read.text(path)
    return lines.groupBy("part_id").agg(
        F.count_if(is_header).alias("n_header"), F.count_if(~is_header).alias("n_rows")
    )


@query(
    "region_vcf_files",
    _region_files_sql(f"WITH {inputs.VCF_LINES_SQL}, source AS (SELECT c FROM vcf)", len(inputs.VCF_HEADER)),
)
def region_vcf_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "region-vcf")
    layout = layouts.preset(spark, "grch38part23")
    assigned = regions.assign_lines(inputs.vcf_lines(spark, sf), layout)
    sinks.write_region_vcf(assigned, path, layout.num_parts, inputs.VCF_HEADER)
    return _read_back(spark, path, F.col("value").startswith("#"))


@query(
    "region_bed_files",
    _region_files_sql(f"WITH {inputs.BED_LINES_SQL}, source AS (SELECT c FROM bed)", 1),
)
def region_bed_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "region-bed")
    layout = layouts.preset(spark, "grch38part23")
    assigned = regions.assign_lines(inputs.bed_lines(spark, sf), layout)
    sinks.write_region_bed(assigned, path, layout.num_parts, ["# contig start end name"])
    return _read_back(spark, path, F.col("value").startswith("#"))


@query(
    "region_tsv_files",
    _region_files_sql(f"WITH {inputs.POSITIONS_SQL}, source AS (SELECT c FROM positions)", 1),
)
def region_tsv_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "region-tsv")
    layout = layouts.preset(spark, "grch38part23")
    assigned = regions.assign_regions(inputs.positions(spark, sf), layout)
    sinks.write_region_tsv(assigned, path, layout.num_parts, ["l_orderkey", "contig", "pos"])
    return _read_back(spark, path, F.col("value").startswith("l_orderkey"))


@query(
    "region_empty_files",
    f"""WITH {inputs.BED_LINES_SQL}, {inputs.POSITIONS_SQL},
parts AS (SELECT p0 AS part_id FROM range(0, 23) t(p0)),
source AS (SELECT 'bed' AS kind, c - 1 AS part_id FROM bed UNION ALL SELECT 'tsv', c - 1 FROM positions),
n AS (SELECT kind, part_id, count(*) AS n FROM source GROUP BY 1, 2),
kinds AS (SELECT unnest(['bed', 'tsv']) AS kind)
SELECT kind, part_id, true AS has_file, coalesce(n, 0) + CASE WHEN kind = 'tsv' AND n > 0 THEN 1 ELSE 0 END AS n_lines
FROM kinds CROSS JOIN parts LEFT JOIN n USING (kind, part_id)""",
)
def region_empty_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every region has a file; that of a region without rows is empty, without a header too."""
    layout = layouts.preset(spark, "grch38part23")
    bed, tsv = shared_path(spark, "empty-bed"), shared_path(spark, "empty-tsv")
    lines_ = regions.assign_lines(inputs.bed_lines(spark, sf), layout)
    sinks.write_region_bed(lines_, bed, layout.num_parts)
    positions = regions.assign_regions(inputs.positions(spark, sf), layout)
    columns = ["l_orderkey", "contig", "pos"]
    sinks.write_region_tsv(positions, tsv, layout.num_parts, columns, header_when_empty=False)

    def counted(kind: str, path: str) -> DataFrame:
        n = spark.read.text(path).groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
        files = spark.createDataFrame([(f,) for f in sinks.region_files(spark, path)], "file string")
        listed = files.select(F.regexp_extract("file", r"/part_id=(\d+)/", 1).cast("int").alias("part_id"), F.lit(True).alias("has_file"))
        return listed.distinct().join(n, "part_id", "full").select(
            F.lit(kind).alias("kind"), "part_id", F.coalesce("has_file", F.lit(False)).alias("has_file"), F.coalesce("n", F.lit(0)).alias("n_lines")
        )

    return counted("bed", bed).unionByName(counted("tsv", tsv))


@query(
    "alignment_files",
    f"""WITH {inputs.PAIRS_SQL}
SELECT id, contig AS "referenceName", p AS "alignmentStart", mate_contig AS "mateReferenceName",
       mp AS "mateAlignmentStart", hex(repeat(chr(0), 18)) || lpad(hex(flags % 256), 2, '0')
       || lpad(hex(flags // 256), 2, '0') AS raw_hex, c - 1 AS part_id
FROM pairs""",
)
def alignment_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "alignments")
    layout = layouts.preset(spark, "grch38part23")
    assigned = regions.assign_regions(inputs.pairs(spark, sf), layout, "referenceName", "alignmentStart")
    sinks.write_alignments(assigned, path)
    return spark.read.parquet(path).withColumn("raw_hex", F.hex("raw")).drop("raw", "piece")
