"""Functions called from SQL, and the exact test, against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from locusframe.functions import genetics, sqlfunctions
from locusframe.operators import regions, sqltask
from locusframe.sources import layouts

GENOTYPE = "array<struct<sampleId:string,calls:array<int>,depth:int>>"


def by_hand(ref, het, alt, mid_p=False):
    """The exact test from log factorials of all outcomes."""
    n = ref + het + alt
    if n == 0:
        return None
    m = 2 * min(ref, alt) + het

    def log_p(h):
        return h * math.log(2) - math.lgamma((m - h) // 2 + 1) - math.lgamma(h + 1) - math.lgamma((2 * n - m - h) // 2 + 1)

    logs = {h: log_p(h) for h in range(m % 2, m + 1, 2)}
    top = max(logs.values())
    share = {h: math.exp(v - top) for h, v in logs.items()}
    tail = math.fsum(share[h] for h, v in logs.items() if v <= logs[het] + 1e-9 * max(1.0, n / 1000))
    return min(1.0, (tail - (share[het] / 2 if mid_p else 0)) / math.fsum(share.values()))


COUNTS = [(r, h, a) for r in (0, 1, 3, 40, 900) for h in (0, 1, 2, 25, 1000) for a in (0, 2, 7, 600)]
LARGE = [(25_000, 50_000, 25_000), (25_100, 49_800, 25_100), (99_000, 995, 5), (90_000, 0, 10_000), (64_000, 32_400, 3_600), (0, 100_000, 0)]


@pytest.mark.parametrize("mid_p", [False, True])
def test_walk_equals_sums_over_all_outcomes(mid_p):
    for counts in [*COUNTS, *LARGE]:
        found, expected = genetics.exact_p_value(*counts, mid_p=mid_p), by_hand(*counts, mid_p=mid_p)
        assert (found is None) == (expected is None)
        assert found is None or found == pytest.approx(expected, rel=1e-6, abs=1e-15), counts


def test_native_and_sql_tests_equal_the_walk(spark):
    sqlfunctions.register_genetics(spark)
    rows = spark.createDataFrame([*COUNTS, *LARGE], "ref long, het long, alt long")
    native = genetics.hwe_test(F.col("ref"), F.col("het"), F.col("alt"))
    for row in rows.select("*", native.alias("native"), F.expr("hwe_exact(ref, het, alt)").alias("sql")).collect():
        expected = genetics.exact_p_value(row["ref"], row["het"], row["alt"])
        for found in (row["native"], row["sql"]):
            assert (found is None) == (expected is None)
            assert found is None or found["pValueHwe"] == pytest.approx(expected, rel=1e-6, abs=1e-15)
        assert row["native"] is None or row["native"]["hetFreqHwe"] == row["sql"]["hetFreqHwe"]


def genotypes(spark):
    calls = [[(0, 0)] * 5 + [(0, 1), (1, 2), (-1, 0)], [(0, 1)] * 6, [], None, [(0, 0, 1), None, (1,), (1, 1)], [(-1, -1)] * 3]
    rows = [(i, None if c is None else [(f"s{j}", None if x is None else list(x), 9) for j, x in enumerate(c)]) for i, c in enumerate(calls)]
    return spark.createDataFrame(rows, f"id int, genotypes {GENOTYPE}")


def test_functions_over_genotypes_in_a_script(spark):
    frame = genotypes(spark)
    sqlfunctions.register_genetics(spark, frame.schema["genotypes"].dataType)
    script = """SELECT id, genotype_counts(IDENTIFIER(:col)) AS n, hardy_weinberg(IDENTIFIER(:col)) AS t,
                       hardy_weinberg_mid_p(IDENTIFIER(:col)) AS u FROM variants"""
    found = sqltask.sql_task(spark, script, {"variants": frame}, {"col": "genotypes"})
    native = frame.select(
        "id",
        genetics.genotype_counts(F.col("genotypes")).alias("n"),
        genetics.hardy_weinberg(F.col("genotypes")).alias("t"),
        genetics.hardy_weinberg(F.col("genotypes"), mid_p=True).alias("u"),
    )
    batch = genetics.add_hardy_weinberg(genetics.add_hardy_weinberg(frame, into="t"), into="u", mid_p=True).select("id", "t", "u")
    rows = {r["id"]: r for r in found.collect()}
    expected = {r["id"]: r for r in native.collect()}
    assert [tuple(rows[i]["n"]) for i in (0, 1, 2, 4, 5)] == [(5, 1, 1), (0, 6, 0), (0, 0, 0), (0, 0, 1), (0, 0, 0)]
    for i in (0, 1, 4):
        assert tuple(rows[i]["t"]) == pytest.approx(tuple(expected[i]["t"])) and tuple(rows[i]["u"]) == pytest.approx(tuple(expected[i]["u"]))
    assert all(rows[i]["t"] is None and expected[i]["t"] is None for i in (2, 3, 5))
    for r in batch.collect():
        for test in ("t", "u"):
            assert (r[test] is None) == (expected[r["id"]][test] is None)
            assert r[test] is None or tuple(r[test]) == pytest.approx(tuple(expected[r["id"]][test]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_table_function_over_layouts(spark):
    named = {"wide": layouts.fixed(spark, {"chr1": 5_000_000, "chrM": 16_000}, 700_000, 50), "whole": layouts.chromosomes(spark, {"chr1": 5_000_000, "chrM": 16_000})}
    sqlfunctions.register_layouts(spark, named)
    at = [(0, "chr1", 1), (1, "1", 699_980), (2, "chr1", 2_100_000), (3, "MT", 16_000), (4, "chr1", 6_000_000), (5, "chr9", 1), (6, None, 1), (7, "chr1", None)]
    frame = spark.createDataFrame(at, "id int, contig string, pos long")
    frame.createOrReplaceTempView("at_positions")
    for name, layout in named.items():
        found = spark.sql(
            "SELECT a.*, r.part_id, r.region_key FROM at_positions a, LATERAL regions_near(:layout, a.contig, a.pos) r "
            "WHERE a.pos BETWEEN r.low AND r.high",
            args={"layout": name},
        )
        expected = regions.assign_regions(frame, layout).select(found.columns)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    kept = spark.sql(
        "SELECT a.id, r.part_id FROM (SELECT *, IF(id % 2 = 0, 'wide', 'whole') AS l FROM at_positions) a "
        "LEFT JOIN LATERAL regions_near(a.l, a.contig, a.pos) r ON a.pos BETWEEN r.low AND r.high"
    )
    assert {r["id"] for r in kept.collect()} == set(range(8))


def test_interval_functions(spark):
    sqlfunctions.register_intervals(spark)
    row = spark.sql(
        "SELECT interval_overlaps('chr1', 5L, 9L, '1', 9L, 12L) a, interval_overlaps('1', 5L, 9L, '1', 10L, 12L) b, "
        "interval_overlaps('chrM', 1L, 2L, 'MT', 2L, 2L) c, interval_overlaps('1', 1L, 2L, '2', 1L, 2L) d, contig_name(NULL) e"
    ).first()
    assert tuple(row) == (True, False, True, False, None)
