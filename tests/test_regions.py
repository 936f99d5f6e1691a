"""Region lookup and layouts against brute force."""

import pytest
from pyspark.sql import functions as F

from locusframe.operators import regions
from locusframe.operators.lookup import lookup_join
from locusframe.sources import layouts

LENGTHS = {"chr1": 1000, "chr2": 350, "chrM": 20}


def rows_of(layout):
    return [(r.contig, r.start, r.end, r.part_id, r.pad) for r in layout.regions.collect()]


def brute(positions, region_rows):
    hits = []
    for contig, pos in positions:
        for name, start, end, part, pad in region_rows:
            if name == contig and max(1, start - pad) <= pos <= end + pad:
                hits.append((contig, pos, part))
    return sorted(hits)


@pytest.mark.parametrize("pad", [0, 7])
def test_every_position_is_covered(spark, pad):
    layout = layouts.fixed(spark, LENGTHS, 90, pad)
    positions = [(c, p) for c, n in LENGTHS.items() for p in range(1, n + 1)]
    df = spark.createDataFrame(positions, "contig string, pos long")
    got = sorted((r.contig, r.pos, r.part_id) for r in regions.assign_regions(df, layout).collect())
    assert got == brute(positions, rows_of(layout))
    assert {(c, p) for c, p, _ in got} == set(positions)
    if pad == 0:
        assert len(got) == len(positions)


@pytest.mark.parametrize("parts", [1, 3, 17, 50])
def test_even_layout_has_exactly_n_parts_and_covers_once(spark, parts):
    layout = layouts.even(spark, LENGTHS, parts)
    rows = rows_of(layout)
    assert layout.num_parts == parts == len({r[3] for r in rows})
    for contig, length in LENGTHS.items():
        covered = sorted((s, e) for c, s, e, _, _ in rows if c == contig)
        assert covered[0][0] == 1 and covered[-1][1] == length
        assert all(b[0] == a[1] + 1 for a, b in zip(covered, covered[1:]))


@pytest.mark.parametrize(
    ("name", "regions_", "parts"),
    [
        ("hg19part1", 25, 1),
        ("hg19part23", 25, 23),
        ("hg19part77", 25, 23),
        ("hg19part3109", 3109, 3109),
        ("grch38part3101", 3102, 3101),
        ("grch38part50", None, 50),
        ("grch38part155", None, 155),
        ("hg19part155", None, 155),
        ("hg19chr20part45", 45, 45),
    ],
)
def test_preset_sizes(spark, name, regions_, parts):
    layout = layouts.preset(spark, name)
    assert layout.num_parts == parts
    if regions_:
        assert layout.num_regions == regions_
    assert layout.bins().count() <= layout.bin_rows


def test_layout_files(spark, tmp_path):
    bed, dictionary = tmp_path / "layout", tmp_path / "ref.dict"
    bed.write_text("# comment\n\nchr1\t1\t100\t0\t10\nchr1\t90\t200\t1\nchr2\t1\t50\t1\t5\n")
    dictionary.write_text("@HD\tVN:1.5\n@SQ\tSN:1\tLN:200\tM5:x\n@SQ\tSN:2\tLN:50\n")
    layout = layouts.read_layout(spark, str(bed), str(dictionary))
    assert (layout.num_regions, layout.num_parts) == (3, 2)
    df = spark.createDataFrame([("chr1", 95), ("1", 105), ("chr2", 55), ("chr2", 56)], "contig string, pos long")
    got = sorted((r.contig, r.pos, r.part_id) for r in regions.assign_regions(df, layout).collect())
    assert got == [("1", 105, 0), ("1", 105, 1), ("chr1", 95, 0), ("chr1", 95, 1), ("chr2", 55, 1)]
    kept = regions.assign_regions(df, layout, unmatched="keep").filter("part_id = -1").collect()
    assert [(r.contig, r.pos) for r in kept] == [("chr2", 56)]
    with pytest.raises(ValueError):
        layouts.read_layout(spark, str(bed), None)
    contigs = layouts.read_contigs(spark, str(dictionary)).orderBy("contig_rank").collect()
    assert [(r.contig, r.contig_rank, r.length) for r in contigs] == [("1", 0, 200), ("2", 1, 50)]


def test_layout_rejects_unknown_contig(spark, tmp_path):
    bed, dictionary = tmp_path / "layout", tmp_path / "ref.dict"
    bed.write_text("chr9\t1\t100\t0\n")
    dictionary.write_text("@SQ\tSN:1\tLN:200\n")
    with pytest.raises(ValueError, match="outside the dictionary"):
        layouts.read_layout(spark, str(bed), str(dictionary))


def test_interval_list_form(spark, tmp_path):
    path = tmp_path / "x.intervals"
    path.write_text("chr1:1-100\nHLA-A*01:01:5-9\n")
    got = [tuple(r) for r in layouts.read_intervals(spark, str(path)).orderBy("start").collect()]
    assert got == [("chr1", 1, 100), ("HLA-A*01:01", 5, 9)]


def test_endpoints_leave_out_regions_between(spark):
    layout = layouts.fixed(spark, LENGTHS, 100)
    df = spark.createDataFrame([(1, "chr1", 50, 350), (2, "chr1", 50, 60)], "id int, contig string, start long, end long")
    got = sorted((r.id, r.part_id) for r in regions.assign_endpoints(df, layout).collect())
    assert got == [(1, 0), (1, 3), (2, 0)]


def test_pairs_keep_the_reads_region_per_partition(spark):
    # chr1 and chr2 share partition 0, so the mate's region loses to the read's.
    layout = layouts.single(spark, LENGTHS)
    df = spark.createDataFrame([("chr2", 5, "chr1", 9)], "contig string, pos long, mate_contig string, mate_pos long")
    assert [r.keys for r in regions.pair_region_keys(df, layout).collect()] == [[(1 << 32) + 1]]
    assert [r.parts for r in regions.pair_regions(df, layout).collect()] == [[0]]


def test_line_position_must_be_a_number(spark):
    layout = layouts.fixed(spark, LENGTHS, 100)
    df = spark.createDataFrame([("chr1\tx\trest",)], "row string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        regions.assign_lines(df, layout).collect()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_lookup_equals_broadcast(spark, how):
    # One key holds most rows, and identical rows repeat.
    big = spark.range(600).select(F.when(F.col("id") < 500, 1).otherwise(F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("v"))
    table = spark.createDataFrame([(1, 1), (1, 3), (2, 0), (9, 9)], "key int, low int")
    residual = F.col("v") >= F.col("low")
    results = [
        sorted(map(tuple, lookup_join(big, table, [("k", "key")], how, residual, max_broadcast_rows=n, salts=5).collect()), key=str)
        for n in (100, 0)
    ]
    assert results[0] == results[1] and results[0]


def test_only_heavy_keys_are_repeated(spark):
    from locusframe.operators import lookup

    keys = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("k"))
    assert lookup.heavy_keys(keys) == [(7, 64)]
    assert lookup.heavy_keys(keys.limit(0)) == [] and lookup.heavy_keys(spark.range(5000)) == []
    table = spark.range(60_000).select(F.col("id").cast("int").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    joined = lookup_join(keys, table, [("k", "key")], max_broadcast_rows=10)
    assert joined.count() == 60_000 and joined.filter("name != concat('n', k)").isEmpty()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode") == 1
    assert not lookup.fits_broadcast(table, 100_000, 1000) and lookup.fits_broadcast(table, 100_000) and not lookup.fits_broadcast(table, 10)
    nulls = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k int, v int")
    kept = lookup_join(nulls, table, [("k", "key")], "left", max_broadcast_rows=10)
    assert sorted((r.v, r.name) for r in kept.collect()) == [(1, None), (2, None), (3, "n3")]


def test_assignment_plan_does_not_shuffle_the_input(spark, capsys):
    df = spark.range(10).select(F.lit("chr1").alias("contig"), (F.col("id") + 1).alias("pos"))
    regions.assign_regions(df, layouts.fixed(spark, LENGTHS, 100)).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_assignment_works_on_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([("chr1", 150), ("chr2", 5)], "contig string, pos long").write.parquet(str(source))
    stream = spark.readStream.schema("contig string, pos long").parquet(str(source))
    assigned = regions.assign_regions(stream, layouts.fixed(spark, LENGTHS, 100))
    query = assigned.writeStream.format("memory").queryName("assigned_stream").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = sorted((r.contig, r.part_id) for r in spark.table("assigned_stream").collect())
    assert got == [("chr1", 1), ("chr2", 10)]
