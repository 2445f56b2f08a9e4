"""Gene-level analysis: minimum p-values, FDR and counts per threshold."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from helixspan.operators import combine, genes
from helixspan.session import hand_over


def min_p_table(tables: Iterable[DataFrame]) -> DataFrame:
    """Minimum p per gene over data sets whose columns may differ."""
    rows = combine.union_all(
        (t.select("study_id", "bio_feature", "gene_id", "pval") for t in tables), True
    )
    return genes.gene_min_p(rows)


def fdr_table(tables: Iterable[DataFrame]) -> DataFrame:
    """Minimum p, Bonferroni p and q per gene; the rows are aggregated only once."""
    return genes.bh_fdr(hand_over(min_p_table(tables), "gene-min-p"))


def threshold_tables(fdr: DataFrame) -> dict[str, DataFrame]:
    """Counts per data set, their summary, and totals and medians by type."""
    counts = hand_over(genes.threshold_counts(fdr), "threshold-counts")
    shown = genes.compare_types(
        genes.without(counts, ["p < 1e-4"], ["eQTLGen-UBERON_0000178"])
    )
    return {
        "counts": counts,
        "summary": genes.threshold_summary(counts),
        "totals_by_type": genes.pivot_by_type(shown, "total"),
        "medians_by_type": genes.pivot_by_type(shown, "median"),
    }
