"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores.
Each query is built and written to the no-op sink; the best of ``BENCH_RUNS`` (default 1) counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from locusframe.plans import QUERIES
from locusframe.session import local_session

HEADLINE = [
    "region_counts",
    "region_assign_padded",
    "bed_endpoint_regions",
    "pair_regions",
    "pair_region_keys",
    "region_preset_fixed",
    "alignment_partition",
    "bed_partition",
    "pair_partition",
    "vcf_partition",
    "region_rank",
    "genome_sort",
    "variant_overlap_filter",
    "row_index",
    "chunk_reads",
    "fastq_scan",
    "vcf_to_table",
    "vcf_core_fields",
    "vcf_info_fields",
    "vcf_genotypes",
    "hwe_test",
    "matrix_join",
    "collect_results",
    "concat_text",
    "region_vcf_files",
    "alignment_files",
    "partitioned_table",
    "pipe_partitions",
    "sql_task",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/nation.parquet").count()
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
