"""Interval arithmetic, overlap filter and the exact test against direct computation."""

import random
from math import exp, lgamma, log

import pytest
from pyspark.sql import functions as F

from locusframe.functions import genetics
from locusframe.functions import intervals as iv
from locusframe.functions.intervals import Interval
from locusframe.operators.overlap import overlap_filter, sweep_filter


def exact_p(ref, het, alt):
    n, rare = ref + het + alt, 2 * min(ref, alt) + het

    def log_p(h):
        r, c = (rare - h) // 2, n - h - (rare - h) // 2
        return h * log(2) + lgamma(n + 1) - lgamma(r + 1) - lgamma(h + 1) - lgamma(c + 1) + lgamma(rare + 1) + lgamma(2 * n - rare + 1) - lgamma(2 * n + 1)

    seen = log_p(het)
    return min(1.0, sum(exp(log_p(h)) for h in range(rare % 2, rare + 1, 2) if log_p(h) <= seen + 1e-9)), exp(seen)


def test_exact_test_matches_direct_sum(spark):
    rng = random.Random(5)
    cases = [(0, 0, 1), (1, 0, 0), (0, 1, 0), (0, 7, 0), (5, 0, 5), (298, 489, 213), (10, 0, 4000), (0, 5000, 0), (20000, 300, 2)]
    cases += [(rng.randint(0, 40), rng.randint(0, 40), rng.randint(0, 40)) for _ in range(60)]
    cases = [c for c in cases if sum(c)]
    df = spark.createDataFrame(cases, "r long, h long, a long")
    got = df.select("*", genetics.hwe_test(F.col("r"), F.col("h"), F.col("a")).alias("t"), genetics.hwe_test(F.col("r"), F.col("h"), F.col("a"), mid_p=True).alias("m"))
    for row in got.collect():
        p, observed = exact_p(row.r, row.h, row.a)
        assert row.t.pValueHwe == pytest.approx(p, rel=1e-6, abs=1e-12)
        assert row.m.pValueHwe == pytest.approx(p - observed / 2, rel=1e-6, abs=1e-9)
        n = row.r + row.h + row.a
        common, rare = sorted((2 * row.r + row.h, 2 * row.a + row.h), reverse=True)
        assert row.t.hetFreqHwe == pytest.approx(common * rare / (2 * n - 1) / n)


def test_genotype_counts_skip_uncalled_and_other_ploidies(spark):
    calls = [[0, 0], [0, 1], [1, 0], [1, 2], [-1, 0], [0], [0, 0, 1], None]
    df = spark.createDataFrame([([(c,) for c in calls],), ([],)], "genotypes array<struct<calls:array<int>>>")
    rows = df.select(genetics.genotype_counts(F.col("genotypes")).alias("n"), genetics.hardy_weinberg(F.col("genotypes")).alias("t")).collect()
    assert tuple(rows[0].n) == (1, 2, 1) and rows[0].t is not None
    assert tuple(rows[1].n) == (0, 0, 0) and rows[1].t is None


def test_interval_arithmetic(spark):
    rows = [("1", 5, 9, "1", 9, 12), ("1", 5, 9, "1", 10, 12), ("1", 5, 9, "2", 6, 7)]
    df = spark.createDataFrame(rows, "c1 string, s1 long, e1 long, c2 string, s2 long, e2 long")
    a, b = Interval.of("c1", "s1", "e1"), Interval.of("c2", "s2", "e2")
    got = df.select(iv.overlaps(a, b).alias("o"), iv.intersect(a, b).alias("i"), iv.span(a, b).alias("s")).collect()
    assert [r.o for r in got] == [True, False, False]
    assert [r.i and tuple(r.i) for r in got] == [("1", 9, 9), None, None]
    assert [r.s and tuple(r.s) for r in got] == [("1", 5, 12), ("1", 5, 12), None]
    assert tuple(df.limit(1).select(iv.intersect(a, b, strict=True).alias("i")).first().i) == ("1", 9, 9)
    with pytest.raises(Exception, match="do not overlap"):
        df.select(iv.intersect(a, b, strict=True)).collect()
    with pytest.raises(Exception, match="different contigs"):
        df.select(iv.span(a, b, strict=True)).collect()
    bad = spark.createDataFrame([("1", 0, 9)], "c string, s long, e long")
    with pytest.raises(Exception, match="invalid interval"):
        bad.select(iv.checked(Interval.of("c", "s", "e")).start).collect()


def test_contig_spelling(spark):
    df = spark.createDataFrame([("chr1",), ("1",), ("chrM",), ("MT",), ("chrMT",), ("M",), ("*",)], "c string")
    assert [r[0] for r in df.select(iv.normalize_contig(F.col("c"))).collect()] == ["1", "1", "M", "M", "M", "M", "*"]


@pytest.mark.parametrize(("width", "limit"), [(10, 1_000_000), (100, 1_000_000), (10_000, 1_000_000), (10, 0)])
def test_overlap_filter_matches_brute_force(spark, width, limit):
    rng = random.Random(width)
    rows, targets = [], []
    for i in range(400):
        start = rng.randint(1, 3000)
        rows.append((i, rng.choice(["chr1", "2", "chr3"]), start, start + rng.choice([0, 1, 50, 700])))
    for _ in range(40):
        start = rng.randint(1, 2500)
        targets.append((rng.choice(["1", "chr2"]), start, start + rng.choice([0, 3, 400])))
    df = spark.createDataFrame(rows, "id int, contig string, start long, end long")
    ivs = spark.createDataFrame(targets, "contig string, start long, end long")
    got = sorted(r.id for r in overlap_filter(df, ivs, bin_width=width, max_broadcast_rows=limit).collect())
    plain = [(c.removeprefix("chr"), s, e) for c, s, e in targets]
    want = [i for i, c, s, e in rows if any(c.removeprefix("chr") == tc and s <= te and ts <= e for tc, ts, te in plain)]
    assert got == want
    assert overlap_filter(df, ivs.limit(0)).count() == 0


@pytest.mark.parametrize(("per_range", "per_task"), [(3, 20), (1_000_000, 1_000_000), (1, 1)])
def test_sweep_matches_brute_force(spark, per_range, per_task):
    rng = random.Random(per_range)
    rows = [(i, rng.choice(["chr1", "2", "chr3"]), s, s + rng.choice([0, 1, 50, 700])) for i, s in enumerate(rng.randint(1, 3000) for _ in range(300))]
    rows += [(300 + i, "chr1", 1200, 1300) for i in range(100)] + [(400, None, 1, 2), (401, "1", None, 5), (402, "1", 5, None)]
    targets = [(rng.choice(["1", "chr2"]), s, s + rng.choice([0, 3, 400])) for s in (rng.randint(1, 2500) for _ in range(40))]
    df = spark.createDataFrame(rows, "id int, contig string, start long, end long").withColumn("range", F.lit("mine"))
    ivs = spark.createDataFrame([*targets, targets[0]], "contig string, start long, end long")
    found = sweep_filter(df, ivs, intervals_per_range=per_range, rows_per_task=per_task)
    assert found.columns == df.columns
    plain = [(c.removeprefix("chr"), s, e) for c, s, e in targets]
    want = [i for i, c, s, e in rows if c and s and e and any(c.removeprefix("chr") == tc and s <= te and ts <= e for tc, ts, te in plain)]
    assert sorted(r.id for r in found.collect()) == want
    assert sweep_filter(df, ivs.limit(0)).count() == 0


def test_sparse_contigs_make_no_bins_beyond_their_own(spark, capsys):
    contigs = [(f"c{i}", 1000 + 90_000_000 * (i % 2), 2000 + 90_000_000 * (i % 2)) for i in range(2580)]
    ivs = spark.createDataFrame(contigs, "contig string, start long, end long")
    df = spark.createDataFrame([(0, "c7", 90_001_500, 180_000_000), (1, "c7", 5, 10), (2, "c8", 1999, 2500), (3, "zz", 1500, 1600)], "id int, contig string, start long, end long")
    # One interval and one carry for each contig fit this limit.
    found = overlap_filter(df, ivs, max_broadcast_rows=3 * 2580)
    assert sorted(r.id for r in found.collect()) == [0, 2]
    found.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
