"""Molecular-trait ingests: expression, splicing and protein QTLs.

Each function takes rows as its reader delivers them, for any number of studies
and tissues at once, and returns the unified QTL table. Study constants are given
as keyword values; a value may also be a Column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixspan.functions import ids, stats, tails
from helixspan.operators import harmonise, qc, qtl
from helixspan.schema import QTL_REQUIRED, QTL_SCHEMA, conform
from helixspan.session import hand_over

SCOPE = ("study_id", "bio_feature")


def with_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    )


def _finish(df: DataFrame, kind: str) -> DataFrame:
    labelled = with_constants(df, type=kind, is_cc=False)
    return qc.step(qc.complete(conform(labelled, QTL_SCHEMA), QTL_REQUIRED), "required columns")


def _count_alleles(df: DataFrame, min_mac: float | None) -> DataFrame:
    counted = df.withColumn("mac", stats.minor_count(F.col("n_total"), F.col("eaf")))
    return counted if min_mac is None else qc.step(qc.min_count(counted, "mac", min_mac), "minor allele count")


def eqtl(rows: DataFrame, min_mac: float = 5, **constants) -> DataFrame:
    """Expression QTLs with allele counts. Tests are counted after the allele filter.

    Lines without an allele number, such as a repeated header, fail that filter.
    ``eaf`` holds the delivered minor allele frequency.
    """
    named = with_constants(rows, **constants).select(
        *constants,
        F.col("molecular_trait_id").alias("phenotype_id"),
        "gene_id",
        F.col("chromosome").alias("chrom"),
        F.col("position").alias("pos"),
        "ref",
        "alt",
        "beta",
        "se",
        F.col("pvalue").alias("pval"),
        F.col("maf").alias("eaf"),
        F.col("r2").alias("info"),
        stats.samples_from_alleles(F.col("an")).alias("n_total"),
        stats.minor_count_from_alleles(F.col("ac"), F.col("an")).alias("mac"),
    )
    named = qc.step(named, "input")
    # The delivery is unsplittable text: it is parsed once, and counted from this copy.
    frequent = hand_over(qc.step(qc.min_count(named, "mac", min_mac), "minor allele count"), "frequent")
    tested = qtl.add_num_tests(frequent, [*SCOPE, "phenotype_id"])
    return conform(with_constants(tested, type="eqtl", is_cc=False), QTL_SCHEMA)


def eqtl_from_z(rows: DataFrame, panel: DataFrame, min_mac: float = 5, **constants) -> DataFrame:
    """Expression QTLs given as z-scores in the old build."""
    sites = harmonise.panel_sites(panel, "b37", ["chrom_b38", "pos_b38"], known_only=False)
    aligned = harmonise.align_alleles(qc.step(rows, "input"), sites)
    matched = hand_over(qc.step(aligned, "alleles in panel"), "aligned")
    aligned = harmonise.orient(matched, "z")
    z, eaf, n = F.col("z"), F.col("gnomad_nfe"), F.col("n_total")
    effects = with_constants(
        aligned,
        eaf=eaf,
        beta=stats.beta_from_z(z, eaf, n),
        se=stats.se_from_z_eaf(z, eaf, n),
        phenotype_id=F.col("gene_id"),
        **constants,
    )
    tested = qtl.add_num_tests(effects, [*SCOPE, "phenotype_id"])
    return _finish(_count_alleles(harmonise.to_new_build(tested), min_mac), "eqtl")


def _from_panel_minor(rows: DataFrame) -> DataFrame:
    """Common columns of tissue QTLs once they are matched with the panel."""
    return rows.withColumns(
        {
            "eaf": stats.eaf_from_maf(F.col("maf"), F.col("gnomad_nfe")),
            "n_total": stats.samples_from_maf(F.col("ma_count"), F.col("maf")),
        }
    ).withColumnsRenamed(
        {"slope": "beta", "slope_se": "se", "pval_nominal": "pval", "ma_count": "mac"}
    )


def tissue_eqtl(
    rows: DataFrame, panel: DataFrame, codes: DataFrame, min_mac: float = 5, **constants
) -> DataFrame:
    """Expression QTLs of many tissues in the old build, in one pass.

    ``rows`` carry the tissue name as ``biofeature_string`` (from the file name).
    """
    frequent = qc.step(qc.min_count(qc.step(rows, "input"), "ma_count", min_mac), "minor allele count")
    parsed = with_constants(
        frequent,
        **ids.variant_parts(F.col("variant_id"), "_"),
        gene_id=ids.before_first_dot(F.col("gene_id")),
        **constants,
    )
    sites = harmonise.panel_sites(panel, "b37", ["chrom_b38", "pos_b38"])
    known = harmonise.in_panel(qtl.tissue_codes(parsed, codes), sites)
    known = hand_over(qc.step(known, "variant in panel"), "known")
    named = _from_panel_minor(known).withColumn("phenotype_id", F.col("gene_id"))
    tested = qtl.add_num_tests(named, [*SCOPE, "gene_id"])
    return _finish(harmonise.to_new_build(tested), "eqtl")


def tissue_sqtl(
    rows: DataFrame, panel: DataFrame, min_mac: float = 5, **constants
) -> DataFrame:
    """Splicing QTLs: the best junction per cluster and gene, counted per junction."""
    frequent = qc.step(qc.min_count(qc.step(rows, "input"), "ma_count", min_mac), "minor allele count")
    parsed = with_constants(
        frequent,
        **ids.variant_parts(F.col("variant_id"), "_"),
        **ids.junction_parts(F.col("phenotype_id")),
        **constants,
    )
    narrow = parsed.select(
        *SCOPE, "phenotype_id", "splicing_cluster", "gene_id", *harmonise.VARIANT,
        "ma_count", "maf", "pval_nominal", "slope", "slope_se",
    )
    # One scan and one join with the panel serve the selection and the selected rows.
    known = harmonise.in_panel(narrow, harmonise.panel_sites(panel))
    known = hand_over(qc.step(known, "variant in panel"), "known")
    chosen = qc.step(qtl.best_junctions(known, SCOPE, "pval_nominal"), "best junction")
    return _finish(_from_panel_minor(chosen), "sqtl")


def aligned_pqtl(
    rows: DataFrame, gene_map: DataFrame, panel: DataFrame,
    distance: int = 1_000_000, min_mac: float = 5, errors_from_p: bool = False, **constants,
) -> DataFrame:
    """Protein QTLs near their gene in the old build, aligned to the panel.

    ``rows`` carry ``phenotype_id`` (from the file name); positions of rows and genes
    must be of one build. With ``errors_from_p`` a missing standard error comes from the
    logarithm of p, which has no lower end; without it such rows are dropped.
    """
    upper = with_constants(
        rows,
        effect_allele=F.upper("effect_allele"),
        other_allele=F.upper("other_allele"),
        pval=stats.p_from_log10(F.col("log10_pval")),
        ln_pval=F.col("log10_pval") * F.lit(tails.LN10),
        **constants,
    )
    upper = qc.step(tails.impute_se(upper) if errors_from_p else upper, "input")
    near = qtl.cis_rows(upper, gene_map, ["phenotype_id", "chrom"], distance)
    near = hand_over(qc.step(near, "near the gene"), "cis-rows")
    sites = harmonise.panel_sites(panel, "b37", ["chrom_b38", "pos_b38"], known_only=False)
    aligned = harmonise.align_alleles(near, sites)
    if qc.logging_steps():  # counted once, also though the tests are counted from it
        aligned = hand_over(qc.step(aligned, "alleles in panel"), "aligned")
    aligned = harmonise.orient(aligned, "beta")
    tested = qtl.add_num_tests(
        aligned.withColumn("eaf", F.col("gnomad_nfe")), [*SCOPE, "phenotype_id"]
    )
    counted = _count_alleles(harmonise.to_new_build(tested), min_mac)
    named = counted.withColumn("phenotype_id", ids.dots_to_underscores(F.col("phenotype_id")))
    return _finish(named, "pqtl")


def harmonised_pqtl(
    rows: DataFrame, gene_map: DataFrame, panel: DataFrame,
    distance: int = 1_000_000, min_mac: float | None = None, **constants,
) -> DataFrame:
    """Protein QTLs near their gene from harmonised files (``file_name`` per row).

    With a ``z`` column the standard error comes from z. Without ``min_mac`` no
    allele-count filter is applied.
    """
    named = with_constants(rows, **constants)
    near = qtl.cis_rows(qc.step(named, "input"), gene_map, ["file_name", "chrom"], distance)
    near = hand_over(qc.step(near, "near the gene"), "cis-rows")
    if "z" in near.columns:
        near = near.withColumn("se", stats.se_from_z(F.col("beta"), F.col("z")))
    sites = harmonise.panel_sites(panel, wanted=near.where(F.col("eaf").isNull()))
    filled = qc.complete(harmonise.fill_eaf(near, sites), ["eaf"])
    if qc.logging_steps():
        filled = hand_over(qc.step(filled, "allele frequency"), "filled")
    tested = qtl.add_num_tests(filled, [*SCOPE, "gene_id"])
    counted = _count_alleles(tested, min_mac)
    return _finish(counted.withColumn("phenotype_id", F.col("gene_id")), "pqtl")
