"""Text sources, files, collectors, commands, tables and SQL tasks."""

import gzip
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from locusframe.operators import collect, pipe, sinks, sqltask
from locusframe.session import shared_path
from locusframe.sources import fastq, text


def new_name(label):
    return f"tests.{label}_{uuid.uuid4().hex}"


def test_fastq_with_at_signs_in_qualities(spark, tmp_path):
    path = tmp_path / "fq"
    path.mkdir()
    for name, lo, hi in (("a.fastq", 0, 900), ("b.fastq", 900, 1000)):
        (path / name).write_text("".join(f"@r{i} x\nACGT{'A' * (i % 50)}\n+r{i}\n@+{'I' * (i % 50)}\n" for i in range(lo, hi)))
    with gzip.open(path / "c.fastq.gz", "wt") as f:
        f.write("@z\nA\n+\n@\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many blocks per file
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        rows = fastq.read_fastq(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {r.id: (r.seq, r.qual, r.read_no) for r in rows}
    want = {f"r{i} x": ("ACGT" + "A" * (i % 50), "@+" + "I" * (i % 50), i if i < 900 else i - 900) for i in range(1000)}
    assert got == {**want, "z": ("A", "@", 0)} and len(rows) == 1001


@pytest.mark.parametrize("block", [60, 333])
def test_fastq_blocks_smaller_than_records(spark, tmp_path, block, capsys):
    chance = random.Random(block)
    sizes = [chance.choice([0, 1, 3, 30, 200]) for _ in range(20)]
    for name, first, end in (("a.fq", 0, "\n\n\n\n\n"), ("b.fq", 20, ""), ("c.fq", 40, "\n")):
        records = "".join(f"@r{first + i}\n{'A' * n}\n+\n{'@' * n}\n" for i, n in enumerate(sizes))
        (tmp_path / name).write_text(records + end)
    (tmp_path / "d.fq").write_text("\n" * 9)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = fastq.read_fastq(spark, str(tmp_path))
        rows = read.collect()
        read.explain()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted((f"r{20 * f + i}", "A" * n, "@" * n, i) for f in range(3) for i, n in enumerate(sizes))
    assert sorted((r.id, r.seq, r.qual, r.read_no) for r in rows) == want
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"a.fq", "b.fq", "c.fq"}
    assert "MapInArrow" in capsys.readouterr().out


def test_fastq_split_otherwise_in_the_second_pass_fails(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r\nACGT\n+\nIIII\n" * 500)
    read = fastq.read_fastq(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        with pytest.raises(Exception, match="split otherwise"):
            read.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert read.count() == 500


def test_positional_schema():
    schema = text.positional_schema({"2:POS": 0, "1:CHROM": "String", "3:Q": 1.5, "4:OK": True, "5:BIG": 2**40})
    kinds = [T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.LongType()]
    assert [f.dataType for f in schema] == kinds and schema.names == ["CHROM", "POS", "Q", "OK", "BIG"]
    for bad in ({"1:A": 0, "3:B": 0}, {"A": 0}, {"1:A": None}):
        with pytest.raises(ValueError):
            text.positional_schema(bad)


def test_part_files(spark, tmp_path):
    for name in ("part-00007-x.txt", "part-00000-x.txt", "part-123456-y.txt"):
        (tmp_path / name).write_text("x\n")
    got = sorted((r.part_id, r.fqn.rsplit("/", 1)[1]) for r in text.read_parts(spark, str(tmp_path)).collect())
    assert got == [(0, "part-00000-x.txt"), (7, "part-00007-x.txt"), (123456, "part-123456-y.txt")]
    single = tmp_path / "single"
    single.mkdir()
    (single / "ref.txt").write_text("x")
    assert [r.part_id for r in text.read_parts(spark, str(single / "ref.txt")).collect()] == [0]


def test_header_lines_read_on_past_the_first_guess(spark, tmp_path):
    path = tmp_path / "x.vcf"
    path.write_text("".join(f"##{i}\n" for i in range(50)) + "data\n##not header\n")
    assert text.header_lines(spark, str(path), first=3) == [f"##{i}" for i in range(50)]


def test_union_keeps_duplicates_and_fills_columns(spark):
    a = spark.createDataFrame([(i, "x") for i in range(63)], "id int, name string")
    assert text.union_tables([a, a, a]).count() == 189
    b = spark.createDataFrame([(1, 2.5)], "id int, extra double")
    assert {tuple(r) for r in text.union_tables([a.limit(1), b]).collect()} == {(0, "x", None), (1, None, 2.5)}
    assert text.union_tables([a, b]).columns == ["id", "name", "extra"]
    with pytest.raises(ValueError):
        text.union_tables([])


def test_concatenated_text(spark, tmp_path):
    (tmp_path / "part-00000.txt").write_text("part-0.vcf\npart-1.vcf\n")
    (tmp_path / "part-00001.txt").write_text("")
    (tmp_path / "part-00002.txt").write_text("\n")
    (tmp_path / "part-00003.txt").write_text("a\r\nb")
    got = {r.part_id: r.result for r in collect.concat_text(spark, str(tmp_path)).collect()}
    assert got == {0: "part-0.vcfpart-1.vcf", 2: "", 3: "ab"}
    kept = {r.part_id: r.result for r in collect.concat_text_keep_empty(spark, str(tmp_path), 5).collect()}
    assert kept == {**got, 1: "", 4: ""}


def test_results_and_sums(spark):
    df = spark.createDataFrame([(2, "c"), (0, "a"), (1, "b")], "part_id int, result string").repartition(3)
    assert collect.collect_results(df).first().results == ["a", "b", "c"]
    ones = spark.createDataFrame([(i, " 1\n" if i else "no") for i in range(24)], "part_id int, result string")
    assert collect.sum_ints(ones).first().total == 23


def test_pipe_streams_each_partition(spark):
    df = spark.range(50_000).select(F.format_string("row %d é", "id").alias("row")).repartition(5)
    got = pipe.pipe_partitions(df, ["cat"])
    assert sorted(r.row for r in got.collect()) == sorted(r.row for r in df.collect())
    assert sorted(int(r.row) for r in pipe.pipe_partitions(df, ["wc", "-l"]).collect()) == [10_000] * 5
    assert pipe.pipe_partitions(df, ["head", "-n", "1"]).count() == 5
    with pytest.raises(Exception, match="exit code"):
        pipe.pipe_partitions(df, ["false"]).collect()
    with pytest.raises(ValueError):
        pipe.pipe_partitions(df, "cat")


def test_csv_writer(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, name string")
    path = str(tmp_path / "csv")
    sinks.write_csv(df, path)
    assert sorted(text.read_csv(spark, path, header=True, schema=df.schema).collect()) == sorted(df.collect())
    with pytest.raises(AnalysisException):
        sinks.write_csv(df, path)


def test_tsv_lines_print_null(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, 5, "x", None)], "part_id int, contig_rank int, pos long, a string, b string")
    sinks.write_region_tsv(df, str(tmp_path / "out"), 1, ["a", "b"])
    files = sorted((tmp_path / "out" / "part_id=0").glob("piece=*/part-*"))
    assert [file.read_text() for file in files] == ["a\tb\n", "x\tnull\n"]


def test_partitioned_table_layout(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tests")
    df = spark.range(100).select("id", (F.col("id") % 8).alias("gene"))
    name = new_name("parts")
    sinks.write_partitioned_table(df, name, ["gene"], str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("gene=*"))) == 8
    assert sorted(spark.table(name).select("id", "gene").collect()) == sorted(df.collect())


def test_localized_table_is_not_refreshed(spark, tmp_path):
    name = new_name("loc")
    view = name.replace(".", "_")
    sqltask.localize_table(spark.range(5), name, str(tmp_path / "t"))
    sqltask.localize_table(spark.range(9), name, str(tmp_path / "t"))
    assert spark.table(name).count() == 5
    assert spark.table(f"global_temp.{view}").count() == 9
    for bad in ("one", "a.b.c", "a.b-c", "a.`b"):
        with pytest.raises(ValueError):
            sqltask.localize_table(spark.range(1), bad)


def test_insert_and_missing_table(spark, tmp_path):
    name = new_name("ins")
    rows = spark.range(3830)
    sqltask.localize_table(rows, name, str(tmp_path / "t"))
    sqltask.sql_task(spark, "INSERT INTO IDENTIFIER(:t) SELECT * FROM src ORDER BY id LIMIT 10", {"src": rows}, {"t": name})
    assert spark.table(name).count() == 3840
    with pytest.raises(AnalysisException):
        sqltask.sql_task(spark, "INSERT INTO tests.no_such_table SELECT * FROM src", {"src": rows})


def test_sql_task_output(spark, tmp_path):
    name = new_name("out")
    out = sqltask.sql_task(
        spark, "SELECT IDENTIFIER(:c) AS v, id % 2 AS p FROM src WHERE id < :n", {"src": spark.range(50)},
        {"c": "id", "n": 20}, name, ["p"], str(tmp_path / "t"),
    )
    assert out.count() == 20 and len(list((tmp_path / "t").glob("p=*"))) == 2


def test_shared_path_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first != second and (not base or first.startswith(base.rstrip("/")))
