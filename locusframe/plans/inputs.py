"""Genomic inputs derived from the driver tables by exact integer arithmetic.

Every derived input covers its whole source table. The ``*_SQL`` texts give the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions.sharing import compute_here
from locusframe.sources import layouts
from locusframe.sources.layouts import Layout

CONTIG_LENGTH = 20_000_000
LENGTHS = {f"chr{i}": CONTIG_LENGTH for i in range(1, 23)}
PAD = 1000
READS_PER_CHUNK = 3000
SAMPLES = ("S1", "S2", "S3")
HWE_SAMPLES = 25


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def windows(spark: SparkSession, pad: int = 0) -> Layout:
    """22 contigs in windows of one million bases."""
    return layouts.fixed(spark, LENGTHS, 1_000_000, pad)


REGIONS_SQL = """regions AS (
  SELECT c, 'chr' || c AS contig, (c - 1) * 20 + w AS part_id, w * 1000000 + 1 AS s,
         (w + 1) * 1000000 AS e, (c - 1) * 4294967296 + w * 1000000 + 1 AS region_key
  FROM range(1, 23) t(c), range(0, 20) u(w))"""


def positions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.expr("concat('chr', l_suppkey % 22 + 1)").alias("contig"),
        F.expr(
            f"(l_partkey * 7919 + l_orderkey * 104729 + l_linenumber * 1299709L) % {CONTIG_LENGTH} + 1"
        ).alias("pos"),
    )


POSITIONS_SQL = f"""positions AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_suppkey % 22 + 1 AS c,
         'chr' || (l_suppkey % 22 + 1) AS contig,
         (l_partkey * 7919 + l_orderkey * 104729 + l_linenumber::BIGINT * 1299709) % {CONTIG_LENGTH} + 1 AS pos
  FROM lineitem)"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Read pairs; ``raw`` is a record whose bytes 18 and 19 are the flag word."""
    start = f"((o_orderkey * 7919) % {CONTIG_LENGTH} + 1)"
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id",
        "concat('chr', o_custkey % 22 + 1) AS referenceName",
        f"{start} AS alignmentStart",
        "concat('chr', (o_custkey + o_orderkey % 2) % 22 + 1) AS mateReferenceName",
        f"({start} + o_orderkey * 31 % 1200000) % {CONTIG_LENGTH} + 1 AS mateAlignmentStart",
        "unhex(concat(repeat('00', 18), lpad(hex(o_orderkey % 256), 2, '0'), "
        "lpad(hex(o_orderkey % 4096 div 256), 2, '0'))) AS raw",
    )


PAIRS_SQL = f"""reads AS (
  SELECT o_orderkey AS id, o_custkey % 22 + 1 AS c, (o_custkey + o_orderkey % 2) % 22 + 1 AS mc,
         (o_orderkey * 7919) % {CONTIG_LENGTH} + 1 AS p, o_orderkey % 4096 AS flags, o_orderkey, o_custkey
  FROM orders),
pairs AS (
  SELECT *, 'chr' || c AS contig, 'chr' || mc AS mate_contig,
         (p + o_orderkey * 31 % 1200000) % {CONTIG_LENGTH} + 1 AS mp
  FROM reads)"""


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).selectExpr(
        "id",
        "referenceName AS contig",
        "alignmentStart AS start",
        "alignmentStart + id * 97 % 1500000 AS end",
        "mateReferenceName AS contig2",
        "mateAlignmentStart AS start2",
        "mateAlignmentStart + id * 89 % 700000 AS end2",
    )


INTERVALS_SQL = (
    PAIRS_SQL
    + """,
ivs AS (
  SELECT id, c, mc, contig, p AS s, p + id * 97 % 1500000 AS e, mate_contig AS contig2, mp AS s2, mp + id * 89 % 700000 AS e2
  FROM pairs)"""
)


def bed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return intervals(spark, sf).selectExpr(
        "concat_ws('\\t', contig, start, end, concat('iv', id)) AS row"
    )


BED_LINES_SQL = (
    INTERVALS_SQL
    + """,
bed AS (SELECT *, contig || chr(9) || s || chr(9) || e || chr(9) || 'iv' || id AS row FROM ivs)"""
)


VCF_HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency">',
    '##INFO=<ID=AC,Number=.,Type=Integer,Description="Counts">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="Known">',
    '##INFO=<ID=KIND,Number=1,Type=String,Description="Kind">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="End">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Depths">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(SAMPLES),
]


def vcf_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Variant lines (row) made from ``orders``; ``id`` and the sample fields depend on its key."""
    sample = """concat(
      CASE (o_orderkey + {i}) % 4 WHEN 0 THEN '0/0' WHEN 1 THEN '0|1' WHEN 2 THEN '1/1' ELSE './.' END,
      CASE WHEN (o_orderkey + {i}) % 9 = 0 THEN ''
           ELSE concat(':', (o_orderkey + {i}) % 30, ':', o_orderkey % 7, ',.,', o_orderkey % 11) END)"""
    info = """CASE WHEN o_orderkey % 8 = 0 THEN '.' ELSE concat(
      'DP=', CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE string(o_orderkey % 50) END,
      ';AF=0.25,', CASE WHEN o_orderkey % 3 = 0 THEN '.' ELSE '0.5' END,
      ';AC=', o_orderkey % 5, ',', CASE WHEN o_orderkey % 17 = 0 THEN 'bad' ELSE '7' END,
      CASE WHEN o_orderkey % 6 = 1 THEN ';DB' ELSE '' END,
      ';OTHER=1;KIND=', o_orderstatus,
      CASE WHEN o_orderkey % 10 = 3 THEN concat(';END=', (o_orderkey * 7919) % 20000000 + 101) ELSE '' END) END"""
    line = F.expr(
        f"""concat_ws('\\t',
          concat('chr', o_custkey % 22 + 1),
          (o_orderkey * 7919) % {CONTIG_LENGTH} + 1,
          CASE o_orderkey % 5 WHEN 0 THEN '.' WHEN 1 THEN concat('rs', o_orderkey, ',alt', o_orderkey)
               ELSE concat('rs', o_orderkey) END,
          CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'AT' ELSE 'GCC' END,
          CASE o_orderkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'T,C' ELSE '.' END,
          CASE WHEN o_orderkey % 7 = 0 THEN '.' ELSE concat(o_orderkey % 100, '.5') END,
          CASE o_orderkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'q10,s50' ELSE '.,.' END,
          {info},
          'GT:DP:AD',
          {", ".join(sample.format(i=i) for i in range(len(SAMPLES)))})"""
    )
    orders = table(spark, sf, "orders")
    return compute_here(orders.select(F.col("o_orderkey").alias("id"), line.alias("row")), "row", F.col("row"))


_SAMPLE_SQL = """(CASE (k + {i}) % 4 WHEN 0 THEN '0/0' WHEN 1 THEN '0|1' WHEN 2 THEN '1/1' ELSE './.' END
    || CASE WHEN (k + {i}) % 9 = 0 THEN '' ELSE ':' || ((k + {i}) % 30) || ':' || (k % 7) || ',.,' || (k % 11) END)"""

VCF_LINES_SQL = f"""o AS (
  SELECT o_orderkey AS k, o_custkey % 22 + 1 AS c, 'chr' || (o_custkey % 22 + 1) AS contig,
         (o_orderkey * 7919) % {CONTIG_LENGTH} + 1 AS p, o_orderstatus AS st FROM orders),
vcf AS (
  SELECT *, concat_ws(chr(9), contig, p::VARCHAR,
    CASE k % 5 WHEN 0 THEN '.' WHEN 1 THEN 'rs' || k || ',alt' || k ELSE 'rs' || k END,
    CASE k % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'AT' ELSE 'GCC' END,
    CASE k % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'T,C' ELSE '.' END,
    CASE WHEN k % 7 = 0 THEN '.' ELSE (k % 100) || '.5' END,
    CASE k % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'q10,s50' ELSE '.,.' END,
    CASE WHEN k % 8 = 0 THEN '.' ELSE
      'DP=' || CASE WHEN k % 13 = 0 THEN 'x' ELSE (k % 50)::VARCHAR END
      || ';AF=0.25,' || CASE WHEN k % 3 = 0 THEN '.' ELSE '0.5' END
      || ';AC=' || (k % 5) || ',' || CASE WHEN k % 17 = 0 THEN 'bad' ELSE '7' END
      || CASE WHEN k % 6 = 1 THEN ';DB' ELSE '' END
      || ';OTHER=1;KIND=' || st
      || CASE WHEN k % 10 = 3 THEN ';END=' || (p + 100) ELSE '' END END,
    'GT:DP:AD', {", ".join(_SAMPLE_SQL.format(i=i) for i in range(len(SAMPLES)))}) AS row
  FROM o)"""


def reads(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id", "concat('ev', event_id) AS id", "event_type AS seq", "props AS qual"
    )


CHUNKS_SQL = f"""total AS (
  SELECT count(*) AS t, {READS_PER_CHUNK} AS size FROM events),
n AS (
  SELECT t, size, t // size + CASE WHEN t < size OR t % size >= size // 2 THEN 1 ELSE 0 END AS parts
  FROM total),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events),
chunks AS (
  SELECT numbered.*, least(idx // size, parts - 1) AS part_id FROM numbered, n)"""


def cohort(spark: SparkSession, sf: str) -> DataFrame:
    """One variant per order with the genotypes of 25 samples."""
    calls = ", ".join(
        ["array(0, 0)"] * 4 + ["array(0, 1)"] * 3 + ["array(1, 1)"] * 2 + ["array(-1, -1)"]
    )
    return table(spark, sf, "orders").selectExpr("o_orderkey AS id").selectExpr(
        "id",
        f"""transform(sequence(0, {HWE_SAMPLES - 1}), s -> named_struct('sampleId', s,
            'calls', array({calls})[int((id % 97 * (s + 3) + id % 7) % 10)])) AS genotypes""",
    )


COHORT_SQL = f"""calls AS (
  SELECT o_orderkey AS id, (o_orderkey % 97 * (s + 3) + o_orderkey % 7) % 10 AS x
  FROM orders, range(0, {HWE_SAMPLES}) t(s)),
counts AS (
  SELECT id, count(*) FILTER (x < 4) AS hom_ref, count(*) FILTER (x >= 4 AND x < 7) AS het,
         count(*) FILTER (x >= 7 AND x < 9) AS hom_alt
  FROM calls GROUP BY id)"""
