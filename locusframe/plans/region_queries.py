"""Queries over region assignment, placement, order and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import intervals as iv
from locusframe.functions.intervals import Interval
from locusframe.functions import sqlfunctions
from locusframe.operators import index, placement, regions, sqltask
from locusframe.operators.overlap import overlap_filter, sweep_filter
from locusframe.plans import inputs
from locusframe.plans.registry import query
from locusframe.session import shared_path
from locusframe.sources import layouts

POSITION_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "contig", "pos"]


def assigned_sql(pad: int) -> str:
    return f"""WITH {inputs.REGIONS_SQL}, {inputs.POSITIONS_SQL},
assigned AS (
  SELECT q.*, r.part_id, r.region_key
  FROM positions q JOIN regions r ON q.c = r.c AND q.pos BETWEEN r.s - {pad} AND r.e + {pad})"""


@query(
    "region_counts",
    assigned_sql(inputs.PAD)
    + """
SELECT part_id, count(*) AS n_rows, min(pos) AS min_pos, max(pos) AS max_pos
FROM assigned GROUP BY part_id""",
)
def region_counts(spark: SparkSession, sf: str) -> DataFrame:
    assigned = regions.assign_regions(inputs.positions(spark, sf), inputs.windows(spark, inputs.PAD))
    return assigned.groupBy("part_id").agg(
        F.count("*").alias("n_rows"), F.min("pos").alias("min_pos"), F.max("pos").alias("max_pos")
    )


ASSIGN_SELECT = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, contig, pos, part_id, region_key FROM assigned"""


@query("region_assign", assigned_sql(0) + ASSIGN_SELECT)
def region_assign(spark: SparkSession, sf: str) -> DataFrame:
    assigned = regions.assign_regions(inputs.positions(spark, sf), inputs.windows(spark))
    return assigned.select(*POSITION_COLUMNS, "part_id", "region_key")


@query("region_assign_padded", assigned_sql(inputs.PAD) + ASSIGN_SELECT)
def region_assign_padded(spark: SparkSession, sf: str) -> DataFrame:
    assigned = regions.assign_regions(inputs.positions(spark, sf), inputs.windows(spark, inputs.PAD))
    return assigned.select(*POSITION_COLUMNS, "part_id", "region_key")


@query("region_file_assign", assigned_sql(inputs.PAD) + ASSIGN_SELECT)
def region_file_assign(spark: SparkSession, sf: str) -> DataFrame:
    """A layout read back from a region file and a sequence dictionary."""
    made = inputs.windows(spark, inputs.PAD).regions
    path, dictionary = shared_path(spark, "region-file"), shared_path(spark, "dictionary")
    made.select(F.concat_ws("\t", "contig", "start", "end", "part_id", "pad").alias("value")).write.text(path)
    names = made.groupBy("contig_rank", "contig").agg(F.max("end").alias("length")).orderBy("contig_rank")
    entry = F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), F.col("length").cast("string"))
    names.select(entry.alias("value")).coalesce(1).write.text(dictionary)
    layout = layouts.read_layout(spark, path, dictionary)
    return regions.assign_regions(inputs.positions(spark, sf), layout).select(*POSITION_COLUMNS, "part_id", "region_key")


@query("sql_region_lookup", assigned_sql(inputs.PAD) + ASSIGN_SELECT)
def sql_region_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Regions looked up by a statement, in a layout that a parameter names."""
    named = {"windows": inputs.windows(spark, inputs.PAD), "chromosomes": layouts.preset(spark, "grch38part23")}
    sqlfunctions.register_layouts(spark, named)
    script = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, contig, pos, part_id, region_key
                FROM lookup_positions p, LATERAL regions_near(:layout, p.contig, p.pos) r WHERE p.pos BETWEEN r.low AND r.high"""
    return sqltask.sql_task(spark, script, {"lookup_positions": inputs.positions(spark, sf)}, {"layout": "windows"})


@query(
    "region_part_count",
    assigned_sql(0) + """
SELECT contig, count(DISTINCT part_id) AS n_parts, count(DISTINCT region_key) AS n_regions
FROM assigned GROUP BY contig""",
)
def region_part_count(spark: SparkSession, sf: str) -> DataFrame:
    assigned = regions.assign_regions(inputs.positions(spark, sf), inputs.windows(spark))
    # Pre-aggregated to one row per region before the contigs, which may be hot, are counted.
    met = assigned.select("contig", "part_id", "region_key").distinct()
    return met.groupBy("contig").agg(
        F.countDistinct("part_id").alias("n_parts"), F.countDistinct("region_key").alias("n_regions")
    )


def _preset_counts(spark: SparkSession, sf: str, layout: layouts.Layout) -> DataFrame:
    assigned = regions.assign_regions(inputs.positions(spark, sf), layout)
    return assigned.groupBy("part_id").agg(
        F.count("*").alias("n_rows"), F.min("pos").alias("min_pos"), F.max("pos").alias("max_pos")
    )


def _preset_sql(part: str) -> str:
    return f"""WITH {inputs.POSITIONS_SQL}
SELECT {part} AS part_id, count(*) AS n_rows, min(pos) AS min_pos, max(pos) AS max_pos
FROM positions GROUP BY 1"""


@query("region_preset_single", _preset_sql("0"))
def region_preset_single(spark: SparkSession, sf: str) -> DataFrame:
    return _preset_counts(spark, sf, layouts.preset(spark, "grch38part1"))


@query("region_preset_chromosomes", _preset_sql("c - 1"))
def region_preset_chromosomes(spark: SparkSession, sf: str) -> DataFrame:
    return _preset_counts(spark, sf, layouts.preset(spark, "hg19part23"))


def _preset_fixed_sql() -> str:
    lengths = list(layouts.GRCH38_LENGTHS.values())[:22]
    firsts = [sum(-(-n // 1_000_000) for n in lengths[:i]) for i in range(22)]
    rows = ", ".join(f"({i + 1}, {first}, {n})" for i, (first, n) in enumerate(zip(firsts, lengths)))
    return f"""WITH {inputs.POSITIONS_SQL}, firsts(c, first_part, len) AS (VALUES {rows}),
win AS (SELECT c, first_part + w AS part_id, w * 1000000 + 1 AS s, least((w + 1) * 1000000, len) AS e
        FROM firsts, range(0, 249) u(w) WHERE w * 1000000 < len)
SELECT part_id, count(*) AS n_rows, min(pos) AS min_pos, max(pos) AS max_pos
FROM positions q JOIN win ON q.c = win.c AND pos BETWEEN s - 1000 AND e + 1000 GROUP BY part_id"""


@query("region_preset_fixed", _preset_fixed_sql())
def region_preset_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _preset_counts(spark, sf, layouts.preset(spark, "grch38part3101"))


ENDPOINTS_SQL = f"""WITH {inputs.REGIONS_SQL}, {inputs.BED_LINES_SQL},
hits AS (
  SELECT b.*, r.part_id, r.region_key, 0 AS src FROM bed b JOIN regions r
    ON b.c = r.c AND b.s BETWEEN r.s - {inputs.PAD} AND r.e + {inputs.PAD}
  UNION ALL
  SELECT b.*, r.part_id, r.region_key, 1 AS src FROM bed b JOIN regions r
    ON b.c = r.c AND b.e BETWEEN r.s - {inputs.PAD} AND r.e + {inputs.PAD}),
ends AS (
  SELECT * FROM hits
  QUALIFY row_number() OVER (PARTITION BY id, part_id ORDER BY src, region_key) = 1)"""


@query(
    "bed_endpoint_regions",
    ENDPOINTS_SQL + """
SELECT id, contig, s AS "start", e AS "end",
       string_agg(part_id::VARCHAR, ',' ORDER BY part_id) AS parts,
       string_agg(region_key::VARCHAR, ',' ORDER BY region_key) AS keys
FROM ends GROUP BY id, contig, s, e""",
)
def bed_endpoint_regions(spark: SparkSession, sf: str) -> DataFrame:
    layout = inputs.windows(spark, inputs.PAD)
    found = regions.endpoint_matches(
        inputs.intervals(spark, sf), layout, contig="contig", start="start", end="end"
    )
    return _match_texts(found.filter(F.size("matches") > 0), "id", "contig", "start", "end")


def _match_texts(df: DataFrame, *columns: str) -> DataFrame:
    def joined(name: str) -> F.Column:
        return F.array_join(
            F.transform(F.array_sort(F.transform("matches", lambda m: m[name])), lambda v: v.cast("string")), ","
        )

    return df.select(*columns, joined("part_id").alias("parts"), joined("region_key").alias("keys"))


PAIR_HITS_SQL = f"""WITH {inputs.REGIONS_SQL}, {inputs.PAIRS_SQL},
hits AS (
  SELECT q.*, r.part_id, r.region_key, 0 AS src FROM pairs q JOIN regions r
    ON q.c = r.c AND q.p BETWEEN r.s - {inputs.PAD} AND r.e + {inputs.PAD}
  UNION ALL
  SELECT q.*, r.part_id, r.region_key, 1 AS src FROM pairs q JOIN regions r
    ON q.mc = r.c AND q.mp BETWEEN r.s - {inputs.PAD} AND r.e + {inputs.PAD}),
kept AS (
  SELECT * FROM hits
  QUALIFY row_number() OVER (PARTITION BY id, part_id ORDER BY src, region_key) = 1)"""

PAIR_COLUMNS = {
    "contig": "referenceName",
    "pos": "alignmentStart",
    "mate_contig": "mateReferenceName",
    "mate_pos": "mateAlignmentStart",
}


@query(
    "pair_regions",
    PAIR_HITS_SQL + """
SELECT id, string_agg(part_id::VARCHAR, ',' ORDER BY part_id) AS parts FROM kept GROUP BY id""",
)
def pair_regions(spark: SparkSession, sf: str) -> DataFrame:
    found = regions.pair_regions(
        inputs.pairs(spark, sf), inputs.windows(spark, inputs.PAD), into="ids", **PAIR_COLUMNS
    )
    texts = F.transform(F.array_sort("ids"), lambda p: p.cast("string"))
    return found.filter(F.size("ids") > 0).select("id", F.array_join(texts, ",").alias("parts"))


@query(
    "pair_region_keys",
    PAIR_HITS_SQL + """
SELECT id, string_agg(region_key::VARCHAR, ',' ORDER BY region_key) AS keys FROM kept GROUP BY id""",
)
def pair_region_keys(spark: SparkSession, sf: str) -> DataFrame:
    found = regions.pair_region_keys(
        inputs.pairs(spark, sf), inputs.windows(spark, inputs.PAD), into="found_keys", **PAIR_COLUMNS
    )
    texts = F.transform(F.array_sort("found_keys"), lambda k: k.cast("string"))
    return found.filter(F.size("found_keys") > 0).select("id", F.array_join(texts, ",").alias("keys"))


@query(
    "vcf_partition",
    f"""WITH {inputs.REGIONS_SQL}, {inputs.VCF_LINES_SQL}
SELECT row, part_id FROM vcf JOIN regions r
  ON vcf.c = r.c AND p BETWEEN s - {inputs.PAD} AND e + {inputs.PAD}""",
)
def vcf_partition(spark: SparkSession, sf: str) -> DataFrame:
    return placement.partition_lines(inputs.vcf_lines(spark, sf), inputs.windows(spark, inputs.PAD)).drop("piece")


@query(
    "alignment_partition",
    f"""WITH {inputs.REGIONS_SQL}, {inputs.PAIRS_SQL}
SELECT id, q.contig AS "referenceName", p AS "alignmentStart", part_id FROM pairs q JOIN regions r
  ON q.c = r.c AND p BETWEEN s - {inputs.PAD} AND e + {inputs.PAD}""",
)
def alignment_partition(spark: SparkSession, sf: str) -> DataFrame:
    placed = placement.partition_alignments(inputs.pairs(spark, sf), inputs.windows(spark, inputs.PAD))
    return placed.select("id", "referenceName", "alignmentStart", "part_id")


@query("bed_partition", ENDPOINTS_SQL + "\nSELECT row, part_id FROM ends")
def bed_partition(spark: SparkSession, sf: str) -> DataFrame:
    return placement.partition_bed(inputs.bed_lines(spark, sf), inputs.windows(spark, inputs.PAD)).drop("piece")


@query(
    "pair_partition",
    PAIR_HITS_SQL + """
SELECT id, contig AS "referenceName", p AS "alignmentStart", part_id FROM kept""",
)
def pair_partition(spark: SparkSession, sf: str) -> DataFrame:
    placed = placement.partition_pairs(inputs.pairs(spark, sf), inputs.windows(spark, inputs.PAD))
    return placed.select("id", "referenceName", "alignmentStart", "part_id")


@query(
    "region_rank",
    f"""WITH {inputs.REGIONS_SQL}, {inputs.PAIRS_SQL}
SELECT id, p AS "alignmentStart", part_id,
       row_number() OVER (PARTITION BY part_id ORDER BY q.c, p, id) AS "rank"
FROM pairs q JOIN regions r ON q.c = r.c AND p BETWEEN s - {inputs.PAD} AND e + {inputs.PAD}""",
)
def region_rank(spark: SparkSession, sf: str) -> DataFrame:
    layout = inputs.windows(spark, inputs.PAD)
    assigned = regions.assign_regions(
        inputs.pairs(spark, sf).select("id", "referenceName", "alignmentStart"),
        layout,
        "referenceName",
        "alignmentStart",
    )
    ranked = index.rank_in_group(
        assigned, "part_id", ["contig_rank", "alignmentStart", "id"], layout.num_parts
    )
    return ranked.select("id", "alignmentStart", "part_id", "rank")


@query(
    "genome_sort",
    f"""WITH {inputs.PAIRS_SQL},
placed AS (SELECT id, p, CASE WHEN flags & 4 <> 0 THEN NULL ELSE c END AS rank_c FROM pairs)
SELECT id, CASE WHEN rank_c IS NULL THEN '*' ELSE 'chr' || rank_c END AS "referenceName",
       p AS "alignmentStart",
       row_number() OVER (ORDER BY rank_c ASC NULLS LAST, p) AS place
FROM placed""",
)
def genome_sort(spark: SparkSession, sf: str) -> DataFrame:
    unmapped = F.expr("id % 4096 & 4") != 0
    reads = inputs.pairs(spark, sf).select(
        "id",
        F.when(unmapped, "*").otherwise(F.col("referenceName")).alias("referenceName"),
        "alignmentStart",
    )
    contigs = layouts.contigs_of(spark, inputs.LENGTHS)
    return index.row_index(placement.genome_sort(reads, contigs), 1, name="place")


@query(
    "unmapped_filter",
    f"""WITH {inputs.PAIRS_SQL}
SELECT id, contig AS "referenceName", p AS "alignmentStart", flags FROM pairs WHERE flags & 4 <> 0""",
)
def unmapped_filter(spark: SparkSession, sf: str) -> DataFrame:
    from locusframe.functions import lines

    found = placement.unmapped(inputs.pairs(spark, sf))
    return found.select(
        "id", "referenceName", "alignmentStart", lines.raw_flags(F.col("raw")).alias("flags")
    )


def _two_intervals() -> tuple[Interval, Interval]:
    return Interval.of("contig", "start", "end"), Interval.of("contig2", "start2", "end2")


@query(
    "interval_overlaps",
    f"""WITH {inputs.INTERVALS_SQL}
SELECT id, contig = contig2 AND s <= e2 AND s2 <= e AS overlaps FROM ivs""",
)
def interval_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two_intervals()
    return inputs.intervals(spark, sf).select("id", iv.overlaps(a, b).alias("overlaps"))


@query(
    "interval_intersect",
    f"""WITH {inputs.INTERVALS_SQL}
SELECT id, contig, greatest(s, s2) AS "start", least(e, e2) AS "end" FROM ivs
WHERE contig = contig2 AND s <= e2 AND s2 <= e""",
)
def interval_intersect(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two_intervals()
    both = inputs.intervals(spark, sf).select("id", iv.intersect(a, b).alias("common"))
    return both.filter(F.col("common").isNotNull()).select("id", "common.*")


@query(
    "interval_span",
    f"""WITH {inputs.INTERVALS_SQL}
SELECT id, contig, least(s, s2) AS "start", greatest(e, e2) AS "end" FROM ivs WHERE contig = contig2""",
)
def interval_span(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two_intervals()
    both = inputs.intervals(spark, sf).select("id", iv.span(a, b).alias("both"))
    return both.filter(F.col("both").isNotNull()).select("id", "both.*")


OVERLAP_SQL = f"""WITH {inputs.INTERVALS_SQL},
targets AS (
  SELECT p_partkey % 22 + 1 AS c, (p_partkey * 102953) % {inputs.CONTIG_LENGTH} + 1 AS s,
         (p_partkey * 102953) % {inputs.CONTIG_LENGTH} + 1 + p_size * 200 AS e FROM part)
SELECT id, contig, s AS "start", s + id % 400 AS "end" FROM ivs v
WHERE EXISTS (SELECT 1 FROM targets t WHERE t.c = v.c AND v.s <= t.e AND v.s + v.id % 400 >= t.s)"""


def _variants_and_targets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    targets = inputs.table(spark, sf, "part").selectExpr(
        "concat('chr', p_partkey % 22 + 1) AS contig",
        f"(p_partkey * 102953) % {inputs.CONTIG_LENGTH} + 1 AS start",
        f"(p_partkey * 102953) % {inputs.CONTIG_LENGTH} + 1 + p_size * 200 AS end",
    )
    return inputs.intervals(spark, sf).selectExpr("id", "contig", "start", "start + id % 400 AS end"), targets


@query("variant_overlap_filter", OVERLAP_SQL)
def variant_overlap_filter(spark: SparkSession, sf: str) -> DataFrame:
    return overlap_filter(*_variants_and_targets(spark, sf))


@query("variant_overlap_sweep", OVERLAP_SQL)
def variant_overlap_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows by the sweep, as for interval sets that no broadcast can hold, in many small ranges."""
    return sweep_filter(*_variants_and_targets(spark, sf), intervals_per_range=50, rows_per_task=5_000)
