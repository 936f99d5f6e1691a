"""Parsing rules of variant text, one hand-written line per rule."""

import math

import pytest
from pyspark.sql import functions as F

from locusframe.operators.variants import parse_variants
from locusframe.sources.vcf_header import parse_header, read_header

HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="a, b=c">',
    '##INFO=<ID=DP,Number=1,Type=String,Description="again">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="x">',
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="x">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="x">',
    '##INFO=<ID=NS,Number=.,Type=String,Description="x">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="x">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="x">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="x">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="x">',
    '##FORMAT=<ID=XX,Number=1,Type=String,Description="x">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb",
]
FIXED = "chr1\t100\trs1\tAC\tG\t50\tPASS\t"


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(line,) for line in lines], "row string")
    return parse_variants(df, parse_header(HEADER), **options)


def one(spark, line, **options):
    (row,) = parse(spark, line, **options).collect()
    return row


def test_header(spark, tmp_path):
    header = parse_header(HEADER)
    assert [(f.key, f.kind, f.is_array) for f in header.info] == [
        ("DP", "int", False), ("AF", "double", True), ("AC", "int", True), ("DB", "boolean", False), ("NS", "string", True)
    ]
    assert [f.key for f in header.formats] == ["DP", "AD", "XX"] and header.samples == ("a", "b")
    path = tmp_path / "x.vcf"
    path.write_text("\n".join([*HEADER, FIXED + ".", FIXED + "DP=3"]) + "\n")
    assert read_header(spark, str(path)) == header


def test_schema_is_the_declared_one(spark):
    schema = parse(spark, FIXED + ".").schema
    assert schema.names == [
        "contigName", "start", "end", "names", "referenceAllele", "alternateAlleles", "qual", "filters",
        "splitFromMultiAllelic", "INFO_DP", "INFO_AF", "INFO_AC", "INFO_DB", "INFO_NS", "genotypes",
    ]
    assert schema["genotypes"].dataType.elementType.names == ["sampleId", "calls", "phased", "depth", "alleleDepths", "XX"]


def test_headers_and_empty_lines_give_no_row(spark):
    assert parse(spark, "##x", "", "#CHROM", FIXED + ".").count() == 1


def test_coordinates_and_end(spark):
    row = one(spark, FIXED + "DP=1")
    assert (row.contigName, row.start, row.end, row.referenceAllele) == ("chr1", 99, 101, "AC")
    assert row.splitFromMultiAllelic is False
    assert one(spark, FIXED + "END=500").end == 500
    assert one(spark, FIXED + "END=x").end == 101


@pytest.mark.parametrize(
    ("text", "want"),
    [(".", None), ("", None), ("a", ["a"]), ("a,b", ["a", "b"]), ("a,.", ["a", None]), (".,.", []), ("q10;s50", ["q10;s50"]), ("a,", ["a"])],
)
def test_text_lists(spark, text, want):
    line = f"chr1\t100\t{text}\tA\t{text}\t.\t{text}\t."
    row = one(spark, line)
    assert row.names == row.alternateAlleles == row.filters == want and row.qual is None


def test_list_separator_option(spark):
    assert one(spark, "chr1\t1\tx;y\tA\tG\t.\tq10;s50\t.", list_sep=";").filters == ["q10", "s50"]


@pytest.mark.parametrize(
    ("text", "want"), [("12.5", 12.5), ("1e3", 1000.0), ("+inf", math.inf), ("-INF", -math.inf), ("NaN", math.nan), ("-nan", math.nan), ("+NAN", math.nan)]
)
def test_quality(spark, text, want):
    got = one(spark, f"chr1\t1\t.\tA\tG\t{text}\t.\t.").qual
    assert math.isnan(got) if math.isnan(want) else got == want


@pytest.mark.parametrize(
    ("info", "column", "want"),
    [
        ("DP=7", "INFO_DP", 7),
        ("DP=.", "INFO_DP", None),
        ("DP=", "INFO_DP", None),
        ("DP=x", "INFO_DP", None),
        ("DP=7.9", "INFO_DP", 7),
        ("DP=1;DP=2", "INFO_DP", 2),
        ("XDP=1;DPX=3", "INFO_DP", None),
        ("AF=0.5,.", "INFO_AF", [0.5, None]),
        ("AF=.", "INFO_AF", None),
        ("AF=.,.", "INFO_AF", []),
        ("AC=1,x,3;DP=5", "INFO_AC", None),
        ("AC=1,2", "INFO_AC", [1, 2]),
        ("DB", "INFO_DB", True),
        ("DP=1;DB;NS=a", "INFO_DB", True),
        ("NODB", "INFO_DB", False),
        (".", "INFO_DB", False),
        ("NS=a=b,c", "INFO_NS", ["a=b", "c"]),
    ],
)
def test_info_values(spark, info, column, want):
    assert one(spark, FIXED + info)[column] == want


def samples(spark, format_and_samples):
    return one(spark, FIXED + ".\t" + format_and_samples).genotypes


def test_genotypes(spark):
    first, second = samples(spark, "GT:DP:AD:ZZ\t0|1:12:3,.,4:q\t./.")
    assert (first.sampleId, first.calls, first.phased, first.depth, first.alleleDepths, first.XX) == ("a", [0, 1], True, 12, [3, None, 4], None)
    assert (second.sampleId, second.calls, second.phased, second.depth, second.alleleDepths) == ("b", [-1, -1], False, None, None)


@pytest.mark.parametrize(
    ("gt", "calls", "phased"),
    [("0/1", [0, 1], False), ("0|1/2", [0, 1, 2], True), ("0/1|2", [0, 1, 2], False), ("1", [1], False), (".", [-1], False), ("a/1", [-1, 1], False)],
)
def test_calls_and_phase(spark, gt, calls, phased):
    got = samples(spark, f"GT\t{gt}")[0]
    assert (got.calls, got.phased) == (calls, phased)


def test_unusual_samples(spark):
    assert one(spark, FIXED + ".").genotypes is None
    assert len(samples(spark, "GT\t0/0")) == 1  # fewer samples than the header names
    assert len(samples(spark, "GT\t0/0\t0/1\t1/1")) == 2  # more samples than the header names
    assert samples(spark, "DP\t3")[0].calls is None
    empty, gt_missing = samples(spark, "GT:DP\t\t:5")
    assert empty.calls is None and (gt_missing.calls, gt_missing.depth) == ([-1], 5)
    assert samples(spark, "GT:DP:AD\t0/1:x:1,x,3")[0].alleleDepths == [1, None, 3]


@pytest.mark.parametrize("line", ["chr1\t.\t.\tA\tG\t.\t.\t.", "chr1\tx\t.\tA\tG\t.\t.\t.", "chr1\t5\t.\tA\tG", "chr1\t5\t.\tA\tG\tbad\t.\t.", "chr1\t5\t.\t.\tG\t.\t.\t."])
def test_unreadable_lines(spark, line):
    with pytest.raises(Exception, match="unreadable variant line"):
        parse(spark, line).collect()
    row = one(spark, line, mode="permissive")
    assert row._corrupt == line
    assert one(spark, FIXED + ".", mode="permissive")._corrupt is None


def test_interval_prefilter(spark):
    intervals = spark.createDataFrame([("1", 101, 101), ("chr2", 1, 9)], "contig string, start long, end long")
    lines = [f"chr1\t{p}\t.\tAC\tG\t.\t.\t." for p in (99, 100, 101, 102)]
    got = parse(spark, *lines, intervals=intervals)
    assert sorted(r.start + 1 for r in got.collect()) == [100, 101]


def test_filters_on_parsed_columns_stay_small(spark):
    """A filter above must not write the whole parser out again below."""
    df = parse(spark, FIXED + ".\tGT\t0/1\t1/1")

    def splits(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("split(")

    samples_ = df.select(F.explode("genotypes").alias("g"))
    assert splits(samples_.filter("g.sampleId = 'a'")) == splits(samples_)
    assert splits(df.filter("contigName = 'chr1' and qual > 1")) <= splits(df)
