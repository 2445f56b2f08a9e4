"""Filtered data sets: by p-value, by window, and their union."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from helixspan.operators import combine, qc, windows
from helixspan.schema import as_type_id, drop_molecular_keys
from helixspan.sources import sinks


def filter_gwas(
    gwas: DataFrame,
    threshold: float = 0.005,
    finished: DataFrame | None = None,
    done: DataFrame | None = None,
) -> DataFrame:
    """GWAS rows below a p-value in published form, on top of an earlier result.

    ``done`` names the studies of the earlier result that must not be filtered again.
    """
    new = as_type_id(drop_molecular_keys(qc.p_at_most(gwas, threshold)))
    return new if finished is None else combine.extend(finished, new, done)


def filter_molecular(tables: Iterable[DataFrame], threshold: float = 0.005) -> DataFrame:
    """Rows of several molecular data sets below a p-value in published form."""
    return as_type_id(qc.p_at_most(combine.union_all(tables), threshold))


def write_filtered(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Rows in position order, in as many files as their size asks for or as told."""
    if partitions:
        sinks.write_by_position(df, path, partitions)
    else:
        sinks.write_sized(df, path)


def significant_windows(
    df: DataFrame,
    out: str,
    intervals_out: str | None = None,
    data_type: str = "gwas",
    width: int = 2_000_000,
    pval: float = 5e-8,
) -> None:
    """Write the rows around significant variants, and optionally the windows.

    The number of output partitions follows from the windows; without any, an empty
    data set is still written so that the study counts as done.
    """
    rows = df.withColumn("chrom", df["chrom"].cast("string"))
    kept, intervals = windows.extract_windows(rows, width, data_type, pval)
    if intervals_out:
        sinks.write_intervals(intervals, intervals_out)
    if data_type == "gwas":
        partitions = windows.partition_plan(intervals).first()["n_partitions"]
        sinks.write_by_position(kept, out, partitions)
    else:
        sinks.write_by_folder(kept, out)


def union_datasets(gwas: DataFrame, molecular: Iterable[DataFrame]) -> DataFrame:
    """All filtered data sets as one table."""
    return combine.gwas_with_molecular(gwas, combine.union_all(molecular))


def write_union(df: DataFrame, path: str, partitions: int | None = None) -> None:
    write_filtered(df, path, partitions)
