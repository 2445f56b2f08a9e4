"""Gene-level statistics: minimum p, false discovery rate, counts per threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from helixspan.functions import ids, stats
from helixspan.operators import quantiles
from helixspan.operators.keys import same_keys
from helixspan.operators.ordered import carry_in, range_sections
from helixspan.session import hand_over

GENE_KEYS = ("study_id", "bio_feature", "gene_id")
DATASET_KEYS = ("study_id", "bio_feature")

# Reported thresholds (label, column, limit), all of them '<'.
THRESHOLDS = [
    ("p < 1e-4", "min_pval", 1e-4),
    ("p < 1e-5", "min_pval", 1e-5),
    ("p < 1e-6", "min_pval", 1e-6),
    ("p < 5e-8", "min_pval", 5e-8),
    ("FDR 5%", "qval", 0.05),
    ("pbonf < 0.05", "p_bonf", 0.05),
]
GENOME_WIDE = "p < 5e-8"


def gene_min_p(df: DataFrame, keys: Sequence[str] = GENE_KEYS) -> DataFrame:
    """Number of tests and smallest p-value per gene and data set."""
    return df.groupBy(*keys).agg(
        F.count("pval").alias("num_tests"), F.min("pval").alias("min_pval")
    )


def order_by_min_p(genes: DataFrame) -> DataFrame:
    return genes.orderBy(*DATASET_KEYS, "min_pval")


def bh_fdr(genes: DataFrame, group: Sequence[str] = DATASET_KEYS) -> DataFrame:
    """Bonferroni-corrected p per gene and Benjamini-Hochberg q per data set.

    ``q`` only depends on a gene's p_bonf, so equal values are counted first and the
    ranking runs over distinct values, in range sections: neither a data set with
    a third of all genes nor a block of ties ends up in one task. Genes at
    p_bonf = 1 always have q = 1 and take no part in the join.
    """
    scored = genes.withColumn(
        "p_bonf",
        stats.bonferroni(
            F.nanvl(F.col("min_pval"), F.lit(None).cast("double")), F.col("num_tests")
        ),
    )
    steps = scored.groupBy(*group, "p_bonf").agg(F.count(F.lit(1)).alias("_genes"))
    sections = range_sections(steps, group, ["p_bonf"])
    counted = carry_in(
        sections,
        group,
        {
            "_before": (F.sum("_genes"), F.sum("_before"), F.lit(0)),
            "_all": (F.sum("_genes"), F.sum("_all"), F.lit(0)),
        },
    )
    inside = Window.partitionBy(*group, "_section")
    upto = (Window.unboundedPreceding, Window.currentRow)
    rank = F.col("_before") + F.sum("_genes").over(inside.orderBy("p_bonf").rowsBetween(*upto))
    raw = counted.withColumn(
        "_raw", F.least(F.col("p_bonf") * F.col("_all") / rank, F.lit(1.0))
    ).drop("_before", "_all")
    carried = carry_in(
        raw, group, {"_after": (F.min("_raw"), F.min("_after"), F.lit(1.0))}
    )
    later = inside.orderBy(F.desc("p_bonf")).rowsBetween(*upto)
    qvalues = carried.select(
        *group,
        "p_bonf",
        F.least(F.min("_raw").over(later), F.col("_after")).alias("qval"),
    )
    below = scored.where(F.col("p_bonf") < 1).alias("g")
    looked_up = below.join(
        qvalues.where(F.col("p_bonf") < 1).alias("q"), same_keys("g", "q", [*group, "p_bonf"])
    ).select("g.*", "q.qval")
    at_one = scored.where(F.col("p_bonf") >= 1).withColumn("qval", F.lit(1.0))
    return looked_up.unionByName(at_one)


def threshold_counts(genes: DataFrame) -> DataFrame:
    """Hits per data set and threshold, in long form, with the genome-wide count beside it."""
    labelled = genes.withColumn(
        "dataset", ids.dataset_label(F.col("study_id"), F.col("bio_feature"))
    ).withColumn("type", ids.qtl_kind(F.col("dataset")))
    hits = {
        label: F.count_if(F.col(column) < F.lit(limit)) for label, column, limit in THRESHOLDS
    }
    rows = [
        F.struct(F.lit(label).alias("threshold"), count.alias("count"))
        for label, count in hits.items()
    ]
    counts = labelled.groupBy("dataset", "type").agg(
        hits[GENOME_WIDE].alias("gws_count"), F.array(*rows).alias("_counts")
    )
    return counts.select("dataset", "type", "gws_count", F.inline("_counts"))


def without(counts: DataFrame, thresholds: Sequence[str] = (), datasets: Sequence[str] = ()):
    """Leave out thresholds and data sets before reporting."""
    return counts.where(
        ~F.col("threshold").isin(list(thresholds)) & ~F.col("dataset").isin(list(datasets))
    )


def threshold_summary(counts: DataFrame) -> DataFrame:
    """Total and median count over data sets per threshold."""
    written = hand_over(counts.select("threshold", "count"), "counts")
    totals = written.groupBy("threshold").agg(F.sum("count").alias("total_count"))
    middle = quantiles.medians(written, ["threshold"], "count", "median_count")
    return (
        totals.alias("t")
        .join(middle.alias("m"), same_keys("t", "m", ["threshold"]), "left")
        .select("t.*", "m.median_count")
    )


def compare_types(counts: DataFrame, pattern: str = "GTE") -> DataFrame:
    """Data sets of one project under a common upper-case name."""
    name = F.col("dataset")
    for prefix in ("GTEx-eQTL-", "GTEx-sQTL-"):
        name = F.replace(name, F.lit(prefix), F.lit(""))
    return counts.where(F.col("dataset").contains(pattern)).withColumn("dataset", F.upper(name))


def pivot_by_type(counts: DataFrame, statistic: str = "total") -> DataFrame:
    """One row per threshold, one column per QTL type, with total or median counts."""
    kinds = ["eQTL", "sQTL"]
    if statistic == "total":
        return counts.groupBy("threshold").pivot("type", kinds).agg(F.sum("count"))
    middle = quantiles.medians(counts, ["threshold", "type"], "count")
    return middle.groupBy("threshold").pivot("type", kinds).agg(F.max("median"))
