"""Queries over row numbers, reads, chunks and collected outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions import lines
from locusframe.operators import chunks, collect, index, pipe, placement, regions, sinks
from locusframe.plans import inputs
from locusframe.plans.region_queries import assigned_sql
from locusframe.plans.registry import query
from locusframe.session import shared_path
from locusframe.sources import fastq, layouts, text

CHUNKED = f"WITH {inputs.CHUNKS_SQL}"


@query(
    "row_index",
    'SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) AS "index" FROM events',
)
def row_index(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return index.row_index(events, 1, ["event_id"])


@query(
    "table_index",
    'SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) + 9 AS "index" FROM orders',
)
def table_index(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of a stored table as it lies: the driver table is stored in key order."""
    numbered = index.table_index(spark, f"{sf.rstrip('/')}/orders.parquet", 10)
    return numbered.select("o_orderkey", "o_orderstatus", "index")


@query("read_count", "SELECT count(*) AS n_reads FROM events")
def read_count(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.read_count(inputs.reads(spark, sf))


def _chunked(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.chunk_reads(
        inputs.reads(spark, sf), inputs.READS_PER_CHUNK, id_column="event_id", order_by=["event_id"]
    )


@query(
    "chunk_reads",
    CHUNKED + """
SELECT event_id, 'ev' || event_id AS id, event_type AS seq, props AS qual, idx, part_id FROM chunks""",
)
def chunk_reads(spark: SparkSession, sf: str) -> DataFrame:
    return _chunked(spark, sf)


@query(
    "fastq_scan",
    "SELECT 'ev' || event_id AS id, event_type AS seq, props AS qual FROM events",
)
def fastq_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "fastq")
    inputs.reads(spark, sf).select(sinks.fastq_record().alias("value")).write.text(path)
    return fastq.read_fastq(spark, path).select("id", "seq", "qual")


@query(
    "fastq_files",
    CHUNKED + """
SELECT part_id, 'ev' || event_id AS id, event_type AS seq, props AS qual FROM chunks""",
)
def fastq_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "fastq-files")
    sinks.write_fastq(_chunked(spark, sf), path)
    back = fastq.read_fastq(spark, f"{path}/*/*.gz")
    part = F.regexp_extract("source_file", r"part_id=(\d+)/", 1).cast("int")
    return back.select(part.alias("part_id"), "id", "seq", "qual")


@query(
    "partition_scan",
    CHUNKED + """
SELECT part_id, count(*) AS n_lines FROM chunks GROUP BY part_id""",
)
def partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "parts")
    _chunked(spark, sf).select(F.col("id").alias("value")).write.text(path)
    counts = (
        spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n_lines"))
    )
    parts = text.read_parts(spark, path).withColumn("name", F.element_at(F.split("fqn", "/"), -1))
    return parts.join(counts, F.col("name") == F.col("file")).select("part_id", "n_lines")


@query(
    "concat_text",
    CHUNKED + """
SELECT part_id, string_agg(event_type, '' ORDER BY event_id) AS result FROM chunks GROUP BY part_id""",
)
def concat_text(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "chunk-lines")
    _chunked(spark, sf).select(F.col("seq").alias("value")).write.text(path)
    return collect.concat_text(spark, path).select("part_id", "result")


@query(
    "concat_text_keep_empty",
    f"""WITH {inputs.PAIRS_SQL}
SELECT c AS part_id, string_agg(id::VARCHAR, '' ORDER BY p, id) AS result FROM pairs GROUP BY c
UNION ALL SELECT 0, ''""",
)
def concat_text_keep_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Files of each region joined; region 0 is a pseudo-contig without reads, so it has none."""
    path = shared_path(spark, "region-ids")
    layout = layouts.chromosomes(spark, inputs.LENGTHS, (), extra="OTHER")
    reads = inputs.pairs(spark, sf).select("id", "referenceName", "alignmentStart")
    assigned = regions.assign_regions(reads, layout, "referenceName", "alignmentStart")
    placed = placement.place_in_order(assigned, ["alignmentStart", "id"], pos="alignmentStart")
    ids = placed.select("part_id", "piece", F.col("id").cast("string").alias("value"))
    ids.write.partitionBy("part_id", "piece").text(path)
    return collect.join_pieces(collect.concat_text_keep_empty(spark, path, layout.num_parts))


def _region_results(spark: SparkSession, sf: str) -> DataFrame:
    """One short text per region, as a per-region command would return it."""
    assigned = regions.assign_regions(inputs.positions(spark, sf), inputs.windows(spark))
    return assigned.groupBy("part_id").agg(F.count("*").cast("string").alias("result"))


@query(
    "collect_results",
    assigned_sql(0) + """,
per AS (SELECT part_id, count(*) AS n FROM assigned GROUP BY part_id)
SELECT count(*) AS n_results, string_agg(n::VARCHAR, ',' ORDER BY part_id) AS results FROM per""",
)
def collect_results(spark: SparkSession, sf: str) -> DataFrame:
    gathered = collect.collect_results(_region_results(spark, sf))
    return gathered.select(
        F.size("results").cast("long").alias("n_results"), F.array_join("results", ",").alias("results")
    )


@query("sum_partition_ints", f"WITH {inputs.POSITIONS_SQL} SELECT count(*) AS total FROM positions")
def sum_partition_ints(spark: SparkSession, sf: str) -> DataFrame:
    """Each region leaves a file with its count; the files' numbers are added up."""
    path = shared_path(spark, "region-counts")
    layout = layouts.chromosomes(spark, inputs.LENGTHS, ())
    assigned = regions.assign_regions(inputs.positions(spark, sf), layout)
    counts = assigned.groupBy("part_id").agg(F.count("*").cast("string").alias("value"))
    counts.write.partitionBy("part_id").text(path)
    return collect.sum_ints(collect.concat_text(spark, path))


@query(
    "pipe_partitions",
    f"""WITH {inputs.VCF_LINES_SQL} SELECT row FROM vcf""",
)
def pipe_partitions(spark: SparkSession, sf: str) -> DataFrame:
    layout = layouts.chromosomes(spark, inputs.LENGTHS, ())
    placed = placement.partition_lines(inputs.vcf_lines(spark, sf), layout)
    return pipe.pipe_partitions(placed, ["cat"]).select("row")


@query(
    "line_projection",
    assigned_sql(0) + """
SELECT l_orderkey || chr(9) || l_linenumber || chr(9) || contig || chr(9) || pos || chr(9) || 'null' AS row
FROM assigned""",
)
def line_projection(spark: SparkSession, sf: str) -> DataFrame:
    assigned = regions.assign_regions(inputs.positions(spark, sf), inputs.windows(spark))
    columns = ["l_orderkey", "l_linenumber", "contig", "pos"]
    nothing = F.lit(None).cast("string")
    return assigned.select(lines.join_fields([*columns, nothing]).alias("row"))
