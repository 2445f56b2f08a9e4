"""Descriptive tables about studies and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from helixspan.functions import text
from helixspan.operators.ordered import running_sum


def publication_counts(studies: DataFrame, keys: Sequence[str] = ("pmid", "author")) -> DataFrame:
    """Number of studies per publication."""
    return studies.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_gwas"))


def cumulative_publications(
    counts: DataFrame, keys: Sequence[str] = ("pmid", "author")
) -> DataFrame:
    """Publications by falling number of studies, with rank and running total."""
    return running_sum(
        counts, [F.desc("num_gwas"), *keys], "num_gwas", "total_gwas", "publication_index"
    )


def with_publication_totals(studies: DataFrame, counts: DataFrame, key: str = "pmid") -> DataFrame:
    """Studies with the number of studies of their publication, largest first."""
    totals = counts.select(key, "num_gwas")
    return studies.join(totals, key, "left").orderBy(
        F.desc("num_gwas"), F.desc("association_count")
    )


def tests_per_dataset(genes: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    return genes.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_genes_tested"))


def loci_by_name(
    studies: DataFrame, name: str, loci: str, family: str = "^CD2_", marker: str = "EXALLC"
) -> DataFrame:
    """Loci of one family of endpoints, with and without a marker in the name."""
    return (
        studies.where(F.col(name).rlike(family))
        .groupBy(F.col(name).contains(marker).alias("marked"))
        .agg(F.sum(loci).cast("bigint").alias("n_loci"))
    )


def sample_size_table(df: DataFrame, sizes: str = "DatasetsNrSamples") -> DataFrame:
    """How many variants have which total sample size, largest first."""
    total = text.sum_of_listed(F.col(sizes)).alias("sample_size")
    return (
        df.select(total)
        .groupBy("sample_size")
        .agg(F.count(F.lit(1)).alias("snp_count"))
        .orderBy(F.desc("sample_size"))
    )
