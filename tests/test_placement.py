"""Physical placement, hot regions, global order and row numbers."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import chunks, collect, index, pipe, placement, regions, sinks
from locusframe.plans import read_queries
from locusframe.sources import layouts

LENGTHS = {"chr1": 400_000, "chr2": 400_000}


def reads(spark, n=6000, hot=0.5):
    """Half of the reads lie in one region, and many of those at a single position."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 10 < 10 * hot, "chr1").otherwise(F.concat(F.lit("chr"), F.col("id") % 2 + 1)).alias("contig"),
        F.when(F.col("id") % 10 < 3, 55_555).when(F.col("id") % 10 < 10 * hot, F.col("id") * 7919 % 100_000 + 1)
        .otherwise(F.col("id") * 7919 % 400_000 + 1).alias("pos"),
    )


def located(df):
    return df.withColumn("task", F.spark_partition_id()).withColumn("row_no", F.monotonically_increasing_id())


def pieces_of(rows):
    found = {}
    for r in rows:
        found.setdefault((r.part_id, r.piece), []).append(r)
    return found


def test_a_piece_is_in_one_task_and_in_order(spark):
    layout = layouts.fixed(spark, LENGTHS, 100_000)
    assigned = regions.assign_regions(reads(spark), layout)
    rows = located(placement.place(assigned, cell_width=10_000)).orderBy("row_no").collect()
    assert sorted(r.id for r in rows) == list(range(6000))
    assert [(r.part_id, r.piece) for r in rows if r.task == rows[0].task] == sorted((r.part_id, r.piece) for r in rows if r.task == rows[0].task)
    for members in pieces_of(rows).values():
        assert len({r.task for r in members}) == 1
        keys = [(r.contig_rank, r.pos) for r in members]
        assert keys == sorted(keys)
        assert members[0].pos // 10_000 == members[-1].pos // 10_000


def test_pieces_do_not_depend_on_the_number_of_rows(spark):
    layout = layouts.fixed(spark, LENGTHS, 100_000)
    one = regions.assign_regions(reads(spark), layout)
    many = one.crossJoin(spark.range(50).select(F.col("id").alias("copy")))
    few, lot = (placement.place(df, cell_width=10_000).groupBy("part_id", "piece").count().collect() for df in (one, many))
    assert {(r.part_id, r.piece) for r in few} == {(r.part_id, r.piece) for r in lot}
    # The position with three tenths of all rows is in several pieces.
    assert max(r["count"] for r in lot) < 0.15 * 300_000


def test_placing_runs_no_job_while_it_is_planned(spark):
    assigned = regions.assign_regions(reads(spark), layouts.fixed(spark, LENGTHS, 100_000))
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        placement.place(assigned)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_without_rank_are_split_too(spark):
    df = spark.range(4000).select("id", F.lit(0).alias("part_id"), F.lit(None).cast("int").alias("contig_rank"), F.lit(None).cast("long").alias("pos"))
    rows = placement.place(df, spread=8).collect()
    assert sorted(r.id for r in rows) == list(range(4000))
    assert len(pieces_of(rows)) == 8 and max(map(len, pieces_of(rows).values())) <= 1000


def test_unassigned_rows_share_no_piece_with_a_region(spark):
    layout = layouts.fixed(spark, LENGTHS, 100_000)
    df = reads(spark, 300).withColumn("pos", F.col("pos") * 4)
    placed = placement.place(regions.assign_regions(df, layout, unmatched="keep"))
    counted = pipe.pipe_partitions(placed.withColumn("row", F.col("id").cast("string")), ["wc", "-l"])
    got = {r.part_id: r.n for r in counted.groupBy("part_id").agg(F.sum(F.col("row").cast("int")).alias("n")).collect()}
    want = {r.part_id: r["count"] for r in placed.groupBy("part_id").count().collect()}
    assert got == want and -1 in got


@pytest.mark.parametrize("spread", [1, 3])
def test_region_files(spark, tmp_path, spread):
    layout = layouts.fixed(spark, LENGTHS, 100_000)
    assigned = regions.assign_regions(reads(spark).filter("pos < 300000"), layout)
    line = F.concat_ws("\t", "contig", "pos", "id")
    path = str(tmp_path / "out")
    sinks.write_region_lines(assigned, path, layout.num_parts, line, ["#a", "#b"], cell_width=20_000, spread=spread)
    files = {}
    for file in sorted((tmp_path / "out").glob("part_id=*/piece=*/part-*")):
        files.setdefault(int(file.parts[-3].split("=")[1]), []).append(file.read_text().splitlines())
    assert set(files) == set(range(layout.num_parts))
    assert files[3] == [["#a", "#b"]]  # a region without rows
    assert len(files[0]) > 2
    for parts in files.values():
        assert parts[0] == ["#a", "#b"]
        runs = [[int(x.split("\t")[1]) for x in part] for part in parts[1:]]
        assert all(run == sorted(run) for run in runs)
        if spread == 1:
            whole = [p for run in runs for p in run]
            assert whole == sorted(whole)
    data = [line for parts in files.values() for part in parts[1:] for line in part]
    assert sorted(data) == sorted(r[0] for r in assigned.select(line).collect())
    texts = collect.join_pieces(collect.concat_text(spark, path)).collect()
    assert {r.part_id: r.result for r in texts} == {n: "".join(x for part in parts for x in part) for n, parts in files.items()}


@pytest.mark.parametrize("compression", [None, "gzip"])
@pytest.mark.parametrize("header", [[], ["#a", "#b"]])
def test_every_region_has_a_file(spark, tmp_path, header, compression):
    layout = layouts.fixed(spark, LENGTHS, 100_000)
    assigned = regions.assign_regions(reads(spark).filter("pos < 250000"), layout)
    line = F.concat_ws("\t", "contig", "pos", "id")
    path = str(tmp_path / "out")
    sinks.write_region_lines(
        assigned, path, layout.num_parts, line, header, compression=compression, header_when_empty=False
    )
    opened = gzip.open if compression else open
    files = {}
    for file in sorted((tmp_path / "out").glob("part_id=*/piece=*/part-*")):
        with opened(file, "rt") as text_:
            files.setdefault(int(file.parts[-3].split("=")[1]), []).append(text_.read())
    assert set(files) == set(range(layout.num_parts))
    want = {}
    for r in assigned.select("part_id", line.alias("line")).collect():
        want.setdefault(r.part_id, []).append(r.line)
    assert set(want) != set(files)
    for part, texts in files.items():
        whole = "".join(texts).splitlines()
        if part in want:
            assert whole[: len(header)] == header and sorted(whole[len(header) :]) == sorted(want[part])
        else:
            assert texts == [""]
    assert len(sinks.region_files(spark, path)) == sum(map(len, files.values()))


def test_every_region_has_a_file_without_any_row(spark, tmp_path):
    layout = layouts.fixed(spark, LENGTHS, 100_000)
    assigned = regions.assign_regions(reads(spark).filter("pos < 0"), layout)
    sinks.write_region_lines(assigned, str(tmp_path / "out"), layout.num_parts, F.col("contig"), ["#a"], header_when_empty=False)
    files = list((tmp_path / "out").glob("part_id=*/piece=*/part-*"))
    assert len(files) == layout.num_parts and all(f.stat().st_size == 0 for f in files)


def test_concatenated_reads_of_a_hot_cell_are_many_files_in_order(spark, monkeypatch):
    chance = random.Random(7)
    rows = [(i, "chr1", 5 if i % 2 else chance.randrange(1, 900)) for i in range(4000)] + [(9000, "chr2", 7)]
    chance.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, referenceName string, alignmentStart long")
    monkeypatch.setattr(read_queries.inputs, "pairs", lambda spark, sf: frame)
    texts = []
    join = read_queries.collect.join_pieces
    monkeypatch.setattr(read_queries.collect, "join_pieces", lambda t: texts.append(t) or join(t))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.part_id: r.result for r in read_queries.concat_text_keep_empty(spark, "").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for contig in ("chr1", "chr2"):
        assert "".join(str(i) for i, c, p in sorted(rows, key=lambda r: (r[2], r[0])) if c == contig) in found.values()
    longest = texts[0].agg(F.max(F.length("result"))).first()[0]
    assert longest < 0.5 * max(map(len, found.values()))


def test_genome_sort_puts_unmapped_last_and_spreads_them(spark):
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "*").otherwise(F.concat(F.lit("chr"), F.col("id") % 2 + 1)).alias("referenceName"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 31 % 997 + 1).cast("long").alias("alignmentStart"),
    )
    contigs = layouts.contigs_of(spark, {"chr2": 1000, "chr1": 1000})
    ordered = placement.genome_sort(df, contigs)
    rows = located(ordered).orderBy("row_no").collect()
    rank = {"chr2": 0, "chr1": 1, "*": 2}
    keys = [(rank[r.referenceName], r.alignmentStart) for r in rows]
    assert keys == sorted(keys) and len(rows) == 3000
    assert ordered.columns == df.columns


def test_unmapped_reads_from_raw_records(spark):
    df = spark.createDataFrame([(i, bytes(18) + i.to_bytes(2, "little") + b"x") for i in (0, 4, 73, 77, 4095, 1024)], "id int, raw binary")
    assert sorted(r.id for r in placement.unmapped(df).collect()) == [4, 77, 4095]


@pytest.mark.parametrize("start", [0, 1, 17])
def test_row_index_has_no_gap(spark, start):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("v"))
    got = [r["index"] for r in index.row_index(df, start, ["v"]).orderBy("v").collect()]
    assert got == list(range(start, start + 5000))
    unordered = sorted(r["index"] for r in index.row_index(df, start).collect())
    assert unordered == list(range(start, start + 5000))


def test_rank_in_group_with_a_hot_group(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 3 + 1).alias("g"))
    got = {(r.g, r["rank"]): r.id for r in index.rank_in_group(df, "g", ["id"], 4).collect()}
    want = {}
    for g in range(4):
        members = [i for i in range(2000) if (0 if i % 10 < 8 else i % 3 + 1) == g]
        want.update({(g, n + 1): i for n, i in enumerate(members)})
    assert got == want


@pytest.mark.parametrize(
    ("total", "size", "parts"),
    [(0, 10, 1), (3, 10, 1), (10, 10, 1), (14, 10, 1), (15, 10, 2), (10_000, 3000, 3), (10_000, 4000, 3), (7, 3, 3)],
)
def test_chunk_count(total, size, parts):
    assert chunks.chunk_count(total, size) == parts


def test_chunks_are_placed_sorted_and_of_even_size(spark):
    df = spark.range(950).select(F.format_string("r%05d", 949 - F.col("id")).alias("id"), F.col("id").alias("idx"))
    rows = located(chunks.chunk_reads(df, 100, idx="idx")).orderBy("row_no").collect()
    sizes = {}
    for r in rows:
        assert r.task == r.part_id == min(r.idx // 100, 9)
        sizes.setdefault(r.part_id, []).append(r.id)
    assert sum(map(len, sizes.values())) == 950
    assert all(50 <= len(ids) <= 150 and ids == sorted(ids) for ids in sizes.values())
