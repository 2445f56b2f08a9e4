"""Time the headline queries and print one JSON line.

Reads tables from $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]. Every query runs
once to warm up the JVM and once for the clock, from building the frame to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helixspan import registry  # noqa: E402
from helixspan.session import SETTINGS  # noqa: E402

HEADLINE = [
    "sig_filter_gwas",
    "interval_merge",
    "window_extract_join",
    "window_extract_range",
    "window_extract_theta",
    "window_extract_molecular",
    "eaf_fill",
    "panel_presence",
    "allele_harmonise",
    "liftover_sites",
    "cis_window",
    "num_tests",
    "best_junction",
    "gene_min_p",
    "bh_fdr",
    "threshold_summary",
    "pub_counts_cumulative",
    "qc_report",
    "parquet_by_position",
    "pipeline_gwas",
    "pipeline_eqtl",
    "pipeline_eqtl_z",
    "pipeline_tissue_eqtl",
    "pipeline_sqtl",
    "pipeline_pqtl",
    "pipeline_linear_export",
    "pipeline_site_list",
    "union_all",
    "export_by_phenotype",
    "linear_export_job",
    "ingest_job",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # The tables are single files of a few MB; broadcasting one would leave the join to
        # the one task that scans the other.
        .config("spark.sql.autoBroadcastJoinThreshold", "2m")
        .config(map=SETTINGS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
