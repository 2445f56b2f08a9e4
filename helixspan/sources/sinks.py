"""Writers for the unified tables, exports and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from helixspan.operators.layout import SHARED_BYTES, by_folder, by_folder_and_position, by_position
from helixspan.session import scratch_path, settings, tidy
from helixspan.sources import folders
from helixspan.sources.publish import Files

#: Bytes an output file is meant to have.
FILE_BYTES = 128 << 20
#: Rows that a task sorts at most for a file, where a number of files is asked for.
FILE_ROWS = 2_000_000


def write_by_position(
    df: DataFrame, path: str, partitions: int | None = None, chrom: str = "chrom"
) -> None:
    """Parquet ordered by (chrom, pos), so row-group statistics prune position ranges.

    ``partitions`` is the number of files that are asked for; tables of more than
    ``FILE_ROWS`` rows a file get more, as every file is sorted in one task.
    """
    if partitions:
        partitions = max(partitions, files_for(df.count(), FILE_ROWS))
    _write_ranges(by_position(df, partitions, chrom), path)


def _write_ranges(ranges: DataFrame, path: str) -> None:
    ranges.write.parquet(path, mode="overwrite", compression="snappy")


def files_for(size: int, file_size: int = FILE_BYTES) -> int:
    """Number of files of the wanted size, in bytes or rows, at least 1."""
    return max(1, -(-size // file_size))


def write_sized(
    df: DataFrame, path: str, file_bytes: int = FILE_BYTES, chrom: str = "chrom"
) -> int:
    """``write_by_position`` with as many files as the rows fill; returns their number.

    The rows are written down first. Their stored size sets the number of files, and the
    bounds of the ranges are sampled from the copy, so what made the rows runs once: for a
    filter over a large table, a second scan of that table would cost far more than the copy
    of what it keeps. The copy also lets an output replace a table that it was made from.
    """
    spark = df.sparkSession
    with tidy(spark):
        staged = scratch_path(spark, "unsized")
        df.write.parquet(staged)
        n_files = files_for(Files(spark).stored_bytes(staged), file_bytes)
        _write_ranges(by_position(spark.read.schema(df.schema).parquet(staged), n_files, chrom), path)
    return n_files


def write_by_folder(
    df: DataFrame,
    path: str,
    folders: Sequence[str] = ("bio_feature", "chrom"),
    mode: str = "overwrite",
) -> None:
    """Folder-partitioned Parquet.

    An overwrite replaces only the folders present in ``df``, so a repeated run of
    one tissue leaves the others alone.
    """
    (
        by_folder_and_position(df, list(folders))
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path, mode=mode, compression="snappy")
    )


def write_by_study(df: DataFrame, path: str) -> None:
    """All studies under one root (``col_study_id=...``), readable as a single data set."""
    labelled = df.withColumn("col_study_id", df["study_id"])
    write_by_folder(labelled, path, ["col_study_id", "bio_feature", "chrom"])


def write_intervals(intervals: DataFrame, path: str, files: int | None = None) -> None:
    """Interval table as TSV with headers; empty strings stay empty.

    ``files`` asks for a number of files in range order, 1 for a single one; the rows
    are computed in parallel all the same.
    """
    if files:
        intervals = intervals.repartitionByRange(files, "study_id", "chrom", "start")
    intervals.write.csv(path, sep="\t", header=True, emptyValue="", mode="overwrite")


def write_export(df: DataFrame, path: str, folder: str | None = None) -> None:
    """Compressed TSV with ``NA`` for null, optionally one folder per phenotype.

    With folders the rows are dealt by folder first, so that a task writes few of them
    and the number of files follows folders and tasks, not their product.
    """
    spark = df.sparkSession
    options = {"sep": "\t", "header": True, "nullValue": "NA", "compression": "gzip", "mode": "overwrite"}
    if not folder:
        df.write.csv(path, **options)
        return
    adaptive = all(spark.conf.get(key).lower() == "true" for key in _ADAPTIVE)
    place = None if _replaces_folders(spark) else folders.local_folder(spark, path)
    with settings(spark, _sizes(spark)):
        dealt = by_folder(df, folder) if adaptive else by_folder_and_position(df, [folder])
        if place:
            folders.write_tsv(dealt, place, folder)
        else:
            dealt.write.partitionBy(folder).csv(path, **options)


# What lets Spark share a large folder among tasks.
_ADAPTIVE = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled")


def _sizes(spark: SparkSession) -> dict[str, str]:
    """Settings for ``by_folder``: when a task's rows are shared, and tasks that are left at least."""
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHARED_BYTES),
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(4 * spark.sparkContext.defaultParallelism),
    }


def _replaces_folders(spark: SparkSession) -> bool:
    """Whether the session asks an overwrite to leave folders alone that get no rows."""
    return spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON lines, null fields included."""
    df.write.json(path, mode="overwrite", ignoreNullFields=False)


def write_result_table(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.csv(path, sep=sep, header=True, mode="overwrite")
