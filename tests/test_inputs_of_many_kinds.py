"""Inputs wider than the driver tables: partitioned tables, several headers, carriage returns, bad records."""

import pytest
from pyspark.sql import functions as F

from locusframe.functions import lines
from locusframe.operators.index import table_index
from locusframe.operators.pipe import pipe_partitions
from locusframe.operators.variants import parse_variant_files
from locusframe.sources.fastq import read_fastq
from locusframe.sources.vcf_header import HeaderField, file_samples, merged_header, read_header, widened

HEAD = "##INFO=<ID=DP,Number=1,Type=Integer,Description=\"x\">\n"


def test_index_of_a_partitioned_and_appended_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 500, numPartitions=3).withColumn("g", F.col("id") % 3)
    rows.write.partitionBy("g").parquet(path)
    rows.write.mode("append").partitionBy("g").parquet(path)
    found = sorted(r["index"] for r in table_index(spark, path).select("index").collect())
    assert found == list(range(1000))


def test_headers_of_all_files(spark, tmp_path):
    columns = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\n"
    (tmp_path / "a.vcf").write_text(HEAD + columns)
    (tmp_path / "b.vcf").write_text(HEAD.replace("DP", "AF").replace("Integer", "Float") + columns)
    header = read_header(spark, str(tmp_path))
    assert [f.key for f in header.info] == ["DP", "AF"] and header.samples == ("A",)
    (tmp_path / "c.vcf").write_text(HEAD.replace("Integer", "String") + columns)
    with pytest.raises(ValueError, match="different types"):
        read_header(spark, str(tmp_path))
    (tmp_path / "c.vcf").write_text(HEAD + columns.replace("\tA\n", "\tB\n"))
    with pytest.raises(ValueError, match="different samples"):
        read_header(spark, str(tmp_path))


COLUMNS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"


def line(pos, info, *genotypes):
    return "\t".join(["1", str(pos), ".", "A", "C", ".", ".", info, "GT", *genotypes]) + "\n"


def test_files_with_different_samples_and_types(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(HEAD + COLUMNS + "A\tB\r\n" + line(1, "DP=3", "0/1", "1/1"))
    (tmp_path / "b.vcf").write_text(HEAD.replace("Integer", "Float").replace("Number=1", "Number=.") + COLUMNS + "C\n" + line(2, "DP=0.5,2", "1/1"))
    (tmp_path / "b2.vcf").write_text(line(3, "DP=7", "0/0"))
    (tmp_path / "c.vcf").write_text(COLUMNS.replace("\tFORMAT\t", "\n") + "1\t4\t.\tA\tC\t.\t.\tDP=1\n")
    found = {r["start"]: r for r in parse_variant_files(spark, str(tmp_path)).collect()}
    assert [found[i]["INFO_DP"] for i in range(4)] == [[3.0], [0.5, 2.0], [7.0], [1.0]]
    assert [[g["sampleId"] for g in found[i]["genotypes"] or []] for i in range(4)] == [["A", "B"], ["C"], ["C"], []]
    assert "genotypes" not in parse_variant_files(spark, str(tmp_path), genotypes=False).columns


def test_genotypes_without_names_fail(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(HEAD + line(1, "DP=3", "0/1"))
    with pytest.raises(Exception, match="no #CHROM line"):
        parse_variant_files(spark, str(tmp_path)).collect()


def test_one_file_with_two_sample_lines_fails(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(COLUMNS + "A\n" + COLUMNS + "B\n")
    with pytest.raises(Exception, match="different #CHROM lines"):
        file_samples(spark, str(tmp_path)).collect()


def test_widened_fields(spark, tmp_path):
    def field(kind, is_array=False):
        return HeaderField("X", kind, is_array)

    assert widened(field("int"), field("double", True)) == field("double", True)
    assert widened(field("int"), field("string")) == field("string")
    assert widened(field("boolean"), field("boolean")) == field("boolean")
    with pytest.raises(ValueError, match="flag"):
        widened(field("boolean"), field("int"))
    (tmp_path / "a.vcf").write_text(HEAD + HEAD.replace("DP", "AF"))
    (tmp_path / "b.vcf").write_text("")
    assert [f.key for f in merged_header(spark, str(tmp_path)).info] == ["DP", "AF"]


def test_pipe_keeps_bytes(spark):
    rows = ["a\rb", "c\r", "d\x85e", ""]
    frame = spark.createDataFrame([(r,) for r in rows], "row string").coalesce(1)
    assert [r["row"] for r in pipe_partitions(frame, ["cat"]).collect()] == rows
    assert len(pipe_partitions(spark.range(50_000).select(F.col("id").cast("string").alias("row")), ["cat"]).take(1)) == 1


@pytest.mark.parametrize("text", ["@a\nAC\n+\nII\n\n@b\nA\n+\nI\n", "@a\nAC\n+\nII\n@b\nA\n", "a\nA\n+\nI\n"])
def test_bad_fastq_fails(spark, tmp_path, text):
    (tmp_path / "r.fq").write_text(text)
    with pytest.raises(Exception, match="bad FASTQ record"):
        read_fastq(spark, str(tmp_path)).collect()


def test_fastq_may_end_in_empty_lines(spark, tmp_path):
    (tmp_path / "r.fq").write_text("@a\nAC\n+\nII\n\n\n")
    assert [tuple(r)[:3] for r in read_fastq(spark, str(tmp_path)).collect()] == [("a", "AC", "II")]


def test_wrong_number_fails(spark):
    frame = spark.createDataFrame([("chr1\tx",)], "row string")
    with pytest.raises(Exception, match="not an integer"):
        frame.select(lines.int_field(F.col("row"), 1)).collect()
