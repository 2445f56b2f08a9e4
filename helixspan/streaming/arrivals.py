"""Deliveries as they arrive: every manifest file is ingested once, over any number of runs.

Manifests (JSON lines) are dropped into a folder. A run takes those that no earlier run has
finished and ends; which ones these are is kept by the stream's own log in ``state``. A run
that dies in the middle leaves its batch unfinished, and the next run takes the same lines
again: their studies' folders are replaced, so nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from helixspan.plans import gwas
from helixspan.session import scratch_path, tidy
from helixspan.sources import readers

# Fields of a manifest line that the ingest needs.
LINE = "in_tsv string, study_id string, n_total int, n_cases int"


def ingest_arrived(
    spark: SparkSession,
    manifests: str,
    panel: str | None,
    out: str,
    state: str,
    columns: Mapping[str, tuple[str, str]] = readers.HARMONISED_GWAS,
    files_per_batch: int | None = None,
    log: str | None = None,
    **options,
) -> int:
    """Ingest the manifest files that are new in a folder; returns the number of batches.

    ``state`` belongs to one pair of folders and must outlive the runs. At most
    ``files_per_batch`` manifest files share a batch (all by default); ``log`` gets a quality
    report per batch. Further options are those of ``gwas.ingest``. A study that a later
    batch delivers again replaces its rows; two lines of a study in one batch are one study.
    A line without rows fails the run, and the batch is tried again by the next one.
    """
    reader = spark.readStream.schema(LINE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    done = 0

    def take(lines: DataFrame, number: int) -> None:
        nonlocal done
        with tidy(spark):
            # The stream's session runs without adaptive plans; the ingest starts from a
            # written copy in the session it was called with.
            path = scratch_path(spark, "arrived")
            lines.where("in_tsv IS NOT NULL AND study_id IS NOT NULL").write.parquet(path)
            taken = spark.read.schema(LINE).parquet(path)
            if not taken.isEmpty():
                known = readers.read_panel(spark, panel) if panel else None
                report = f"{log.rstrip('/')}/batch={number}" if log else None
                gwas.ingest(spark, taken, known, out, columns, log=report, **options)
                done += 1

    query = (
        reader.json(manifests)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
