"""Genotype statistics over one variant's genotype array.

``hardy_weinberg`` and ``hwe_test`` are native array expressions; ``add_hardy_weinberg`` tests each distinct
set of counts of an Arrow batch once, which is faster on tables of many variants or many samples.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.sharing import once


def genotype_counts(genotypes: Column) -> Column:
    """struct(hom_ref, het, hom_alt) over samples with two called alleles.

    Samples with a missing allele (-1), no call, or another ploidy are left out. An allele
    above 0 counts as the alternate allele, so 1/2 is hom_alt.
    """

    def alternate_alleles(sample: Column) -> Column:
        first, second = F.get(sample["calls"], F.lit(0)), F.get(sample["calls"], F.lit(1))
        called = (F.size(sample["calls"]) == 2) & (first >= 0) & (second >= 0)
        return F.when(called, (first > 0).cast("int") + (second > 0).cast("int")).otherwise(-1)

    def count(codes: Column, n: int) -> Column:
        # Plain array functions are compiled; a filter with a lambda is interpreted.
        return F.size(codes) - F.size(F.array_remove(codes, n))

    return once(
        F.transform(genotypes, alternate_alleles),
        lambda codes: F.struct(
            count(codes, 0).alias("hom_ref"),
            count(codes, 1).alias("het"),
            count(codes, 2).alias("hom_alt"),
        ),
    )


def hwe_test(hom_ref: Column, het: Column, hom_alt: Column, mid_p: bool = False) -> Column:
    """struct(hetFreqHwe, pValueHwe): expected heterozygosity and the exact test's p-value.

    Exact test of Wigginton, Cutler and Abecasis (2005). Given n individuals and m copies of
    the rarer allele, the heterozygote count h has the parity of m and
    P(h+2)/P(h) = (m-h) * (2n-m-h) / ((h+2)*(h+1)). The logs of these ratios give log P(observed)
    and the highest log P; a walk over them adds up the probabilities scaled by that highest
    value, so nothing overflows however large n is. The walk covers a window of ten deviations and 40 around
    the mean, outside which terms vanish; if the outcome seen is not in its inner half, it covers all outcomes.
    Null when there is no called genotype.
    """
    counts = F.struct(
        hom_ref.cast("long").alias("ref"), het.cast("long").alias("het"), hom_alt.cast("long").alias("alt")
    )

    def with_sizes(c: Column) -> Column:
        n = c["ref"] + c["het"] + c["alt"]
        rare = 2 * F.least(c["ref"], c["alt"]) + c["het"]
        return F.struct(c["het"].alias("het"), n.alias("n"), rare.alias("rare"))

    sizes = once(counts, with_sizes)
    return once(sizes, lambda s: F.when(s["n"] > 0, _exact_test(s["n"], s["rare"], s["het"], mid_p)))


def _exact_test(n: Column, rare: Column, het: Column, mid_p: bool) -> Column:
    common = 2 * n - rare
    mean = rare * common / (2.0 * n)
    reach = 10.0 * mean / F.sqrt(n.cast("double")) + 40.0
    near = F.abs(het - mean) <= reach / 2
    down, up = F.floor(mean - reach), F.ceil(mean + reach)
    low = F.when(near, F.greatest(rare % 2, down + F.pmod(down + rare, F.lit(2)))).otherwise(rare % 2)
    high = F.when(near, F.least(rare, up - F.pmod(up + rare, F.lit(2)))).otherwise(rare)
    # One entry per step h -> h+2. ``sequence`` counts down when its end is below its start.
    window = F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))

    def steps_of(w: Column) -> Column:
        some = F.sequence(w["low"], w["high"] - 2, F.lit(2).cast("long"))
        return F.struct(w["low"].alias("low"), F.when(w["high"] >= w["low"] + 2, some).otherwise(F.array().cast("array<bigint>")).alias("steps"))

    zero = F.lit(0.0)
    # Outcomes as likely as the observed one must count despite rounding in the sums of logs.
    slack = F.lit(1e-9)

    def log_ratio(h: Column) -> Column:
        """log of P(h+2)/P(h). Falls as h grows, so P has a single peak."""
        return F.log((rare - h) * (common - h) / ((h + 2.0) * (h + 1.0)))

    def add_up(known: Column) -> Column:
        """Tail over total, from log P relative to the lowest outcome, scaled by the peak."""
        ratios, seen, top = known["ratios"], known["seen"], known["top"]

        def share(log_p: Column) -> Column:
            return F.exp(log_p - top)

        def tail_share(log_p: Column) -> Column:
            return F.when(log_p <= seen + slack, share(log_p)).otherwise(zero)

        def add(acc: Column, ratio: Column) -> Column:
            return once(
                acc["log_p"] + ratio,
                lambda now: F.struct(
                    now.alias("log_p"),
                    (acc["total"] + share(now)).alias("total"),
                    (acc["tail"] + tail_share(now)).alias("tail"),
                ),
            )

        def p_value(acc: Column) -> Column:
            tail = acc["tail"] - share(seen) / 2 if mid_p else acc["tail"]
            return F.least(tail / acc["total"], F.lit(1.0))

        start = F.struct(
            zero.alias("log_p"), share(zero).alias("total"), tail_share(zero).alias("tail")
        )
        return F.aggregate(ratios, start, add, p_value)

    def peak_and_seen(ratios: Column, low: Column) -> Column:
        below_seen = F.slice(ratios, 1, F.floor((het - low) / 2).cast("int"))
        return F.struct(
            ratios.alias("ratios"),
            F.aggregate(below_seen, zero, lambda acc, ratio: acc + ratio).alias("seen"),
            # Up to the peak every ratio is above one, after it none is.
            F.aggregate(ratios, zero, lambda acc, ratio: acc + F.greatest(ratio, zero)).alias("top"),
        )

    known = once(
        once(window, steps_of),
        lambda w: once(F.transform(w["steps"], log_ratio), lambda ratios: peak_and_seen(ratios, w["low"])),
    )
    return F.struct(
        (rare * common / (2.0 * n - 1.0) / n).alias("hetFreqHwe"),
        once(known, add_up).alias("pValueHwe"),
    )


def hardy_weinberg(genotypes: Column, mid_p: bool = False) -> Column:
    """The exact test applied to a genotype array column."""
    return once(
        genotype_counts(genotypes),
        lambda n: hwe_test(n["hom_ref"], n["het"], n["hom_alt"], mid_p),
    )


#: Terms this much (in logs) below the outcome seen and below the peak add nothing to a double.
_VANISHING = 50.0


def _terms_outwards(rare: int, common: int, start: int, step: int, limit: float) -> np.ndarray:
    """Log P(h) less log P(start) for h beyond ``start``, until terms fall below ``limit`` or outcomes end.

    P has one peak and ``start`` lies near it, so a walk away from it that has fallen below the limit stays there.
    """
    parts, reached, h, size = [], 0.0, start, 64
    end = rare if step > 0 else rare % 2
    while h != end and reached >= limit:
        stop = min(h + 2 * size, end) if step > 0 else max(h - 2 * size, end)
        at = np.arange(h, stop, step, dtype=np.float64)
        low = at if step > 0 else at - 2
        ratios = np.log((rare - low) * (common - low) / ((low + 2) * (low + 1)))
        terms = reached + np.cumsum(ratios if step > 0 else -ratios)
        parts.append(terms)
        reached, h, size = float(terms[-1]), stop, 2 * size
    return np.concatenate(parts) if parts else np.zeros(0)


def exact_p_value(hom_ref: int, het: int, hom_alt: int, mid_p: bool = False) -> float | None:
    """The exact test for one set of counts, by a walk from the peak outwards until terms vanish."""
    n = hom_ref + het + hom_alt
    if n <= 0:
        return None
    rare = 2 * min(hom_ref, hom_alt) + het
    common = 2 * n - rare
    peak = rare * common // (2 * n)
    peak = min(max(peak - (peak + rare) % 2, rare % 2), rare)
    # Up to the outcome seen nothing may be left out, so it sets the first limit.
    way = _terms_outwards(rare, common, peak, 2 if het > peak else -2, -math.inf) if het != peak else np.zeros(1)
    seen = float(way[abs(het - peak) // 2 - 1]) if het != peak else 0.0
    limit = min(seen, 0.0) - _VANISHING
    terms = np.concatenate([[0.0], *(_terms_outwards(rare, common, peak, step, limit) for step in (2, -2))])
    top = float(terms.max())
    shares = np.exp(terms - top)
    tail = float(shares[terms <= seen + 1e-9].sum()) - (math.exp(seen - top) / 2 if mid_p else 0.0)
    return min(tail / float(shares.sum()), 1.0)


def add_hardy_weinberg(df: DataFrame, genotypes: str = "genotypes", into: str = "hwe", mid_p: bool = False) -> DataFrame:
    """Adds struct(hetFreqHwe, pValueHwe) of a genotype array column, as ``hardy_weinberg`` gives it.

    Genotypes are counted natively; only the three counts of a variant go to Python, where each distinct set of a batch is
    tested once. Nothing is shuffled, so common counts (such as variants that no sample has) do not meet in one task.
    """

    @F.pandas_udf("double")
    def p_value(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ref, het, alt in batches:
            counts = np.stack([x.fillna(0).to_numpy(np.int64) for x in (ref, het, alt)], 1)
            distinct, place = np.unique(counts, axis=0, return_inverse=True)
            found = [exact_p_value(*row, mid_p=mid_p) for row in distinct.tolist()]
            yield pd.Series(np.array([math.nan if p is None else p for p in found])[place.ravel()])

    counted = df.withColumn("_counts", genotype_counts(F.col(genotypes)))
    ref, het, alt = (F.col("_counts").getField(f).cast("long") for f in ("hom_ref", "het", "hom_alt"))
    tested = counted.withColumn("_p", p_value(ref, het, alt))
    size = ref + het + alt
    rare = 2 * F.least(ref, alt) + het
    freq = rare * (2 * size - rare) / (2.0 * size - 1.0) / size
    result = F.when(size > 0, F.struct(freq.alias("hetFreqHwe"), F.col("_p").alias("pValueHwe")))
    return tested.withColumn(into, result).drop("_counts", "_p")
