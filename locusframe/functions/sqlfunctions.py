"""Functions that SQL statements can call: temporary functions whose bodies are SQL expressions, without Python workers.

``register_genetics`` gives scalar functions over genotypes, ``register_intervals`` over intervals, and
``register_layouts`` table functions that look positions up in named region layouts. Spark expands a call into the plan
around it, so filters, column pruning and join planning see through it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from locusframe.functions.intervals import normalize_contig
from locusframe.sources import layouts

#: The width of the bins that positions and regions of all layouts meet in; a region has a row for each bin it touches.
LOOKUP_BIN = 1_000_000

GENOTYPES = "ARRAY<STRUCT<calls: ARRAY<INT>>>"
_COUNTS = "STRUCT<hom_ref: BIGINT, het: BIGINT, hom_alt: BIGINT>"
_TEST = "STRUCT<hetFreqHwe: DOUBLE, pValueHwe: DOUBLE>"


def _once(value: str, name: str, body: str) -> str:
    """``body`` of a value that is computed once and called ``name`` in it."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def counts_sql(genotypes: str) -> str:
    """SQL of struct(hom_ref, het, hom_alt): samples with two called alleles by their number of alternate ones."""
    codes = (
        f"transform({genotypes}, g -> CASE WHEN size(g.calls) = 2 AND get(g.calls, 0) >= 0 AND get(g.calls, 1) >= 0 "
        "THEN int(get(g.calls, 0) > 0) + int(get(g.calls, 1) > 0) ELSE -1 END)"
    )

    def count(n: int) -> str:
        return f"bigint(size(codes) - size(array_remove(codes, {n})))"

    fields = f"named_struct('hom_ref', {count(0)}, 'het', {count(1)}, 'hom_alt', {count(2)})"
    return f"CASE WHEN {genotypes} IS NOT NULL THEN {_once(codes, 'codes', fields)} END"


def exact_test_sql(hom_ref: str, het: str, hom_alt: str, mid_p: bool = False) -> str:
    """SQL of the exact test; the same steps as ``genetics.hwe_test``, where they are explained."""
    share = "exp({} - k.top)".format
    tail = "IF({0} <= k.seen + 1e-9D, exp({0} - k.top), 0D)".format
    step = _once(
        "acc.log_p + r",
        "now",
        f"named_struct('log_p', now, 'total', acc.total + {share('now')}, 'tail', acc.tail + {tail('now')})",
    )
    begin = f"named_struct('log_p', 0D, 'total', {share('0D')}, 'tail', {tail('0D')})"
    less = f" - {share('k.seen')} / 2" if mid_p else ""
    p_value = f"aggregate(k.ratios, {begin}, (acc, r) -> {step}, acc -> least((acc.tail{less}) / acc.total, 1D))"
    known = (
        "named_struct('ratios', ratios, "
        "'seen', aggregate(slice(ratios, 1, int((w.het - w.low) div 2)), 0D, (a, r) -> a + r), "
        "'top', aggregate(ratios, 0D, (a, r) -> a + greatest(r, 0D)))"
    )
    ratios = (
        "CASE WHEN w.high >= w.low + 2 THEN transform(sequence(w.low, w.high - 2, 2L), h -> "
        "ln(double(w.m - h) * double(2 * w.n - w.m - h) / ((h + 2D) * (h + 1D)))) ELSE array_repeat(0D, 0) END"
    )
    p_of_window = _once(ratios, "ratios", _once(known, "k", p_value))
    # ``near``: the outcome seen lies in the inner half of the window around the mean, so what is outside cannot matter.
    window = (
        "named_struct('het', s.het, 'n', s.n, 'm', s.m, "
        "'low', IF(abs(s.het - s.mean) <= s.reach / 2, greatest(s.m % 2, bigint(floor(s.mean - s.reach)) "
        "+ pmod(bigint(floor(s.mean - s.reach)) + s.m, 2)), s.m % 2), "
        "'high', IF(abs(s.het - s.mean) <= s.reach / 2, least(s.m, bigint(ceil(s.mean + s.reach)) "
        "- pmod(bigint(ceil(s.mean + s.reach)) + s.m, 2)), s.m))"
    )
    result = f"named_struct('hetFreqHwe', s.m * (2D * s.n - s.m) / (2D * s.n - 1D) / s.n, 'pValueHwe', {_once(window, 'w', p_of_window)})"
    mean = "c.m * (2D * c.n - c.m) / (2D * c.n)"
    sizes = f"named_struct('het', c.het, 'n', c.n, 'm', c.m, 'mean', {mean}, 'reach', 10D * {mean} / sqrt(double(c.n)) + 40D)"
    counts = f"named_struct('het', {het}, 'n', {hom_ref} + {het} + {hom_alt}, 'm', 2 * least({hom_ref}, {hom_alt}) + {het})"
    return f"CASE WHEN {hom_ref} + {het} + {hom_alt} > 0 THEN {_once(counts, 'c', _once(sizes, 's', result))} END"


def _create(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")


def register_genetics(spark: SparkSession, genotypes: str | DataType = GENOTYPES) -> None:
    """``genotype_counts``, ``hardy_weinberg``, ``hardy_weinberg_mid_p`` over genotypes, ``hwe_exact`` over counts.

    ``genotypes`` is the type of the columns they will be called with: an array of structs with a field
    ``calls`` (array<int>) and any others.
    """
    kind = genotypes if isinstance(genotypes, str) else genotypes.simpleString()
    _create(spark, "genotype_counts", f"genotypes {kind}", _COUNTS, counts_sql("genotypes"))
    counts = "hom_ref BIGINT, het BIGINT, hom_alt BIGINT"
    _create(spark, "hwe_exact", counts, _TEST, exact_test_sql("hom_ref", "het", "hom_alt"))
    for name, mid_p in (("hardy_weinberg", False), ("hardy_weinberg_mid_p", True)):
        test = exact_test_sql("n.hom_ref", "n.het", "n.hom_alt", mid_p)
        _create(spark, name, f"genotypes {kind}", _TEST, _once(counts_sql("genotypes"), "n", test))


def _contig(name: str) -> str:
    """SQL of ``intervals.normalize_contig``."""
    return f"CASE WHEN {name} IN ('MT', 'chrMT') THEN 'M' WHEN startswith({name}, 'chr') THEN substring({name}, 4) ELSE {name} END"


def register_intervals(spark: SparkSession) -> None:
    """``contig_name`` and, over closed intervals, ``interval_overlaps``."""
    _create(spark, "contig_name", "contig STRING", "STRING", _contig("contig"))
    sides = ", ".join(f"{side}_contig STRING, {side}_start BIGINT, {side}_end BIGINT" for side in ("a", "b"))
    test = "contig_name(a_contig) = contig_name(b_contig) AND a_start <= b_end AND b_start <= a_end"
    _create(spark, "interval_overlaps", sides, "BOOLEAN", test)


def layout_bins(named: Mapping[str, layouts.Layout], width: int = LOOKUP_BIN) -> DataFrame:
    """(layout, bin_contig, bin, low, high, part_id, region_key): all padded regions in all bins they touch."""
    frames = []
    for name, layout in named.items():
        low, high = F.greatest(F.col("start") - F.col("pad"), F.lit(1)), F.col("end") + F.col("pad")
        frames.append(
            layout.regions.select(
                F.lit(name).alias("layout"),
                normalize_contig(F.col("contig")).alias("bin_contig"),
                F.explode(F.sequence(F.floor(low / F.lit(width)), F.floor(high / F.lit(width)))).alias("bin"),
                low.alias("low"),
                high.alias("high"),
                "part_id",
                "region_key",
            )
        )
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def register_layouts(spark: SparkSession, named: Mapping[str, layouts.Layout] | None = None) -> None:
    """A table function over layouts by name, to be joined LATERAL; ``named`` defaults to all presets.

    ``regions_near(layout, contig, pos)`` gives (low, high, part_id, region_key) of every padded region that touches the
    bin of a position. The layout's name may be a literal or a column.

    ``FROM t, LATERAL regions_near('grch38part155', t.contig, t.pos) r WHERE t.pos BETWEEN r.low AND r.high`` is an equi join on layout, contig and bin with the range as its residual. The range test stands outside the
    function because Spark plans correlated range tests inside one over all distinct positions. The regions of all
    presets together have some 50,000 rows of bins, which Spark broadcasts by their size; the rows that are looked up
    are not shuffled. A LEFT JOIN LATERAL with the range test in its ON condition keeps rows without a region.
    """
    named = {n: layouts.preset(spark, n) for n in layouts.PRESETS} if named is None else dict(named)
    bins = layout_bins(named)
    bins.createOrReplaceTempView("locusframe_layout_bins")
    _create(
        spark,
        "regions_near",
        "lookup_layout STRING, lookup_contig STRING, lookup_pos BIGINT",
        "TABLE(low BIGINT, high BIGINT, part_id INT, region_key BIGINT)",
        "SELECT b.low, b.high, b.part_id, b.region_key FROM locusframe_layout_bins b "
        f"WHERE b.layout = lookup_layout AND b.bin_contig = {_contig('lookup_contig')} AND b.bin = lookup_pos div {LOOKUP_BIN}",
    )
