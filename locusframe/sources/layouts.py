"""Region layouts: which stretch of which contig belongs to which partition.

A layout is metadata. It is generated from contig lengths or read from a region file, and its
size is known before it takes part in a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import lines
from locusframe.functions.intervals import normalize_contig

# Lengths of the primary contigs of the two human assemblies.
GRCH38_LENGTHS = {
    "chr1": 248956422, "chr2": 242193529, "chr3": 198295559, "chr4": 190214555,
    "chr5": 181538259, "chr6": 170805979, "chr7": 159345973, "chr8": 145138636,
    "chr9": 138394717, "chr10": 133797422, "chr11": 135086622, "chr12": 133275309,
    "chr13": 114364328, "chr14": 107043718, "chr15": 101991189, "chr16": 90338345,
    "chr17": 83257441, "chr18": 80373285, "chr19": 58617616, "chr20": 64444167,
    "chr21": 46709983, "chr22": 50818468, "chrX": 156040895, "chrY": 57227415,
    "chrM": 16569,
}
HG19_LENGTHS = {
    "chr1": 249250621, "chr2": 243199373, "chr3": 198022430, "chr4": 191154276,
    "chr5": 180915260, "chr6": 171115067, "chr7": 159138663, "chr8": 146364022,
    "chr9": 141213431, "chr10": 135534747, "chr11": 135006516, "chr12": 133851895,
    "chr13": 115169878, "chr14": 107349540, "chr15": 102531392, "chr16": 90354753,
    "chr17": 81195210, "chr18": 78077248, "chr19": 59128983, "chr20": 63025520,
    "chr21": 48129895, "chr22": 51304566, "chrX": 155270560, "chrY": 59373566,
    "chrM": 16569,
}

CONTIG_SCHEMA = "contig string, contig_rank int, length long"
KEY_SHIFT = 32
"""``region_key = contig_rank << 32 | start``: one long per region, in genome order."""


@dataclass(frozen=True)
class Layout:
    """``regions`` has columns contig, start, end, part_id, pad, contig_rank, region_key."""

    regions: DataFrame
    num_regions: int
    num_parts: int
    bin_width: int
    bin_rows: int

    def bins(self) -> DataFrame:
        """One row per (contig, bin) that a padded region touches.

        The bin width is the average padded region length, so the number of rows is at most
        three times the number of regions, whatever the mix of long and short ones.
        """
        low = F.greatest(F.col("start") - F.col("pad"), F.lit(1))
        high = F.col("end") + F.col("pad")
        width = F.lit(self.bin_width)
        return self.regions.select(
            normalize_contig(F.col("contig")).alias("bin_contig"),
            F.explode(F.sequence(F.floor(low / width), F.floor(high / width))).alias("bin"),
            low.alias("bin_low"),
            high.alias("bin_high"),
            F.col("part_id"),
            F.col("region_key"),
            F.col("contig_rank"),
        )


def layout_from_frame(regions: DataFrame, contigs: DataFrame) -> Layout:
    """Layout over any region table; contigs missing from ``contigs`` are rejected."""
    ranks = contigs.select(
        normalize_contig(F.col("contig")).alias("rank_contig"), "contig_rank"
    )
    ranked = regions.join(
        ranks, normalize_contig(F.col("contig")) == F.col("rank_contig"), "left"
    ).drop("rank_contig")
    keyed = ranked.withColumn(
        "region_key",
        F.shiftleft(F.col("contig_rank").cast("long"), KEY_SHIFT) + F.col("start"),
    )
    length = F.col("end") + 2 * F.col("pad") - F.col("start") + 1
    facts = keyed.agg(
        F.count("*").alias("n"),
        F.countDistinct("part_id").alias("parts"),
        F.max("part_id").alias("last"),
        F.count_if(F.col("contig_rank").isNull()).alias("unknown"),
        F.count_if((F.col("start") < 1) | (F.col("end") < F.col("start"))).alias("invalid"),
        F.sum(length).alias("bases"),
    ).first()
    if not facts["n"]:
        raise ValueError("the region layout is empty")
    if facts["unknown"]:
        raise ValueError(f"{facts['unknown']} regions lie on contigs outside the dictionary")
    if facts["invalid"]:
        raise ValueError(f"{facts['invalid']} regions have start < 1 or end < start")
    if facts["last"] + 1 != facts["parts"]:
        raise ValueError("partition ids must run from 0 without a gap")
    width = max(1, facts["bases"] // facts["n"])
    return Layout(keyed, facts["n"], facts["parts"], width, 3 * facts["n"])


def _layout_from_rows(
    spark: SparkSession, rows: Sequence[tuple[str, int, int, int, int]], ranks: Mapping[str, int]
) -> Layout:
    """Same as :func:`layout_from_frame` for generated rows, whose facts need no Spark job."""
    contigs, starts, ends, parts, pads = zip(*rows)
    # An Arrow table becomes a local relation, which needs no job of its own to be read.
    table = pa.table(
        {
            "contig": pa.array(contigs, pa.string()),
            "start": pa.array(starts, pa.int64()),
            "end": pa.array(ends, pa.int64()),
            "part_id": pa.array(parts, pa.int32()),
            "pad": pa.array(pads, pa.int64()),
            "contig_rank": pa.array([ranks[c] for c in contigs], pa.int32()),
            "region_key": pa.array([(ranks[c] << KEY_SHIFT) + s for c, s in zip(contigs, starts)], pa.int64()),
        }
    )
    bases = sum(end + 2 * pad - start + 1 for _, start, end, _, pad in rows)
    return Layout(
        spark.createDataFrame(table),
        len(rows),
        max(parts) + 1,
        max(1, bases // len(rows)),
        3 * len(rows),
    )


def _ranks(lengths: Mapping[str, int]) -> dict[str, int]:
    return {contig: rank for rank, contig in enumerate(lengths)}


def single(spark: SparkSession, lengths: Mapping[str, int] = GRCH38_LENGTHS) -> Layout:
    """Every contig in partition 0."""
    rows = [(contig, 1, length, 0, 0) for contig, length in lengths.items()]
    return _layout_from_rows(spark, rows, _ranks(lengths))


def chromosomes(
    spark: SparkSession,
    lengths: Mapping[str, int] = GRCH38_LENGTHS,
    shared: Iterable[str] = ("chrX", "chrY", "chrM"),
    extra: str | None = None,
) -> Layout:
    """One partition per contig; the ``shared`` ones go together into the last partition.

    ``extra`` names a pseudo-contig that gets partition 0 to itself and shifts the others.
    """
    together = set(shared)
    alone = [c for c in lengths if c not in together]
    first = 1 if extra else 0
    rows = [(contig, 1, lengths[contig], first + i, 0) for i, contig in enumerate(alone)]
    rows += [(c, 1, lengths[c], first + len(alone), 0) for c in lengths if c in together]
    ranks = _ranks(lengths)
    if extra:
        rows.insert(0, (extra, 1, max(lengths.values()), 0, 0))
        ranks[extra] = len(ranks)
    return _layout_from_rows(spark, rows, ranks)


def fixed(
    spark: SparkSession,
    lengths: Mapping[str, int] = GRCH38_LENGTHS,
    width: int = 1_000_000,
    pad: int = 0,
    joined: Iterable[str] = (),
    min_tail: int = 0,
) -> Layout:
    """Windows of ``width`` bases. Contigs in ``joined`` go into the partition before them.

    A contig's last stretch shorter than ``min_tail`` becomes part of the window before it.
    """
    attach = set(joined)
    rows: list[tuple[str, int, int, int, int]] = []
    part = -1
    for contig, length in lengths.items():
        starts = list(range(1, length + 1, width))
        if len(starts) > 1 and length - starts[-1] + 1 < min_tail:
            starts.pop()
        for start, following in zip(starts, [*starts[1:], length + 1]):
            if contig not in attach or part < 0:
                part += 1
            rows.append((contig, start, following - 1, part, pad))
    return _layout_from_rows(spark, rows, _ranks(lengths))


def even(
    spark: SparkSession,
    lengths: Mapping[str, int] = GRCH38_LENGTHS,
    num_parts: int = 50,
    pad: int = 0,
) -> Layout:
    """Exactly ``num_parts`` partitions of equal length over all contigs laid end to end."""
    total = sum(lengths.values())
    if not 1 <= num_parts <= total:
        raise ValueError("num_parts must lie between 1 and the number of bases")
    cuts = [total * i // num_parts for i in range(1, num_parts + 1)]
    rows: list[tuple[str, int, int, int, int]] = []
    part, offset = 0, 0
    for contig, length in lengths.items():
        start = 1
        while start <= length:
            end = min(length, cuts[part] - offset)
            rows.append((contig, start, end, part, pad))
            start = end + 1
            if end + offset == cuts[part]:
                part += 1
        offset += length
    return _layout_from_rows(spark, rows, _ranks(lengths))


def preset(spark: SparkSession, name: str) -> Layout:
    """Named layouts for the two human assemblies.

    The point-lookup presets all come from the generators above. Partition counts are those in
    the names (the short-tail limits see to that); cut points are even cuts, not the hand-placed ones in assembly gaps, which can be
    loaded with :func:`read_layout`. ``hg19part77`` means the 23-partition layout.
    """
    if name.lower() not in PRESETS:
        raise ValueError(f"unknown layout {name!r}; known: {', '.join(PRESETS)}")
    return PRESETS[name.lower()](spark)


_HG19_MAIN = {c: n for c, n in HG19_LENGTHS.items() if c != "chrM"}
PRESETS: dict[str, Callable[[SparkSession], Layout]] = {
    "hg19part1": lambda spark: single(spark, HG19_LENGTHS),
    "hg19part23": lambda spark: chromosomes(spark, HG19_LENGTHS),
    "hg19part77": lambda spark: chromosomes(spark, HG19_LENGTHS),
    "hg19part155": lambda spark: even(spark, HG19_LENGTHS, 155, 1000),
    "hg19part3109": lambda spark: fixed(spark, _HG19_MAIN, 1_000_000, 1000, (), 100_000),
    "hg19part3109unpadded": lambda spark: fixed(spark, _HG19_MAIN, 1_000_000, 0, (), 100_000),
    "hg19chr20part45": lambda spark: even(spark, {"chr20": HG19_LENGTHS["chr20"]}, 45, 0),
    "grch38part1": lambda spark: single(spark, GRCH38_LENGTHS),
    "grch38part23": lambda spark: chromosomes(spark, GRCH38_LENGTHS),
    "grch38part50": lambda spark: even(spark, GRCH38_LENGTHS, 50, 0),
    "grch38part155": lambda spark: even(spark, GRCH38_LENGTHS, 155, 1000),
    "grch38part3101": lambda spark: fixed(spark, GRCH38_LENGTHS, 1_000_000, 1000, ("chrM",), 41_000),
}


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region lines ``contig start end part_id [pad]``; comments and blank lines are skipped."""
    row = F.col("value")
    return (
        spark.read.text(path)
        .filter((F.trim(row) != "") & ~row.startswith("#"))
        .select(
            lines.field(row, 0).alias("contig"),
            lines.int_field(row, 1).alias("start"),
            lines.int_field(row, 2).alias("end"),
            lines.int_field(row, 3).cast("int").alias("part_id"),
            F.coalesce(lines.int_field(row, 4), F.lit(0)).cast("long").alias("pad"),
        )
    )


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """Interval lines in ``contig:start-end`` form, 1-based and closed."""
    pattern = r"^(.+):(\d+)-(\d+)$"
    row = F.col("value")
    return (
        spark.read.text(path)
        .filter((F.trim(row) != "") & ~row.startswith("#") & ~row.startswith("@"))
        .select(
            F.regexp_extract(row, pattern, 1).alias("contig"),
            F.regexp_extract(row, pattern, 2).cast("long").alias("start"),
            F.regexp_extract(row, pattern, 3).cast("long").alias("end"),
        )
    )


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Sequence dictionary: the order of the ``@SQ`` lines is the contig rank.

    A dictionary is one small file, so it is read whole and stays one input split; the running
    number over it covers contig names only.
    """
    text = spark.read.text(path, wholetext=True)
    entry = text.select(F.posexplode(F.filter(F.split("value", "\r?\n"), lambda x: x.startswith("@SQ"))))
    return entry.select(
        F.regexp_extract("col", r"\tSN:([^\t]*)", 1).alias("contig"),
        F.col("pos").alias("contig_rank"),
        F.regexp_extract("col", r"\tLN:(\d+)", 1).cast("long").alias("length"),
    )


def read_layout(spark: SparkSession, region_path: str | None, dictionary_path: str | None) -> Layout:
    """Layout from a region file and the sequence dictionary it refers to."""
    if not region_path or not dictionary_path:
        raise ValueError("a layout needs both a region file and a sequence dictionary")
    return layout_from_frame(
        read_regions(spark, region_path), read_contigs(spark, dictionary_path)
    )


def contigs_of(spark: SparkSession, lengths: Mapping[str, int]) -> DataFrame:
    rows = [(contig, rank, length) for rank, (contig, length) in enumerate(lengths.items())]
    return spark.createDataFrame(rows, CONTIG_SCHEMA)
