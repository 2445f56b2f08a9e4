"""Operators for molecular traits: gene maps, cis windows, test counts, junctions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from helixspan.session import hand_over


def gene_positions(genes: DataFrame) -> DataFrame:
    """(gene_id, chrom, tss) of a gene dictionary."""
    return genes.select("gene_id", F.col("chr").cast("string").alias("chrom"), "tss")


def gene_map(names: DataFrame, genes: DataFrame, key: str = "file_name") -> DataFrame:
    """File (or phenotype) names with gene, chromosome and transcription start."""
    return names.select(key, "gene_id").dropna().join(gene_positions(genes), "gene_id")


def protein_gene_map(manifest: DataFrame, proteins: DataFrame, genes: DataFrame) -> DataFrame:
    """Assay manifest joined through protein ids to gene positions.

    Expects ``phenotype_id, UniProt`` in the manifest and ``UniProt, gene_id`` in the
    protein table; only Ensembl gene ids count.
    """
    ensembl = proteins.where(F.col("gene_id").startswith("ENSG")).select("UniProt", "gene_id")
    return (
        manifest.select("phenotype_id", "UniProt")
        .join(ensembl, "UniProt")
        .join(gene_positions(genes), "gene_id")
        .drop("UniProt")
    )


def cis_rows(
    df: DataFrame, genes: DataFrame, on: Sequence[str] = ("file_name", "chrom"),
    distance: int = 1_000_000,
) -> DataFrame:
    """Rows near the transcription start of their gene, on the gene's chromosome.

    The map usually comes out of a join, whose size Spark can only guess; written down
    it is known to be small, and the rows need no shuffle.
    """
    return (
        df.join(hand_over(genes, "gene-map"), list(on))
        .where(F.abs(F.col("pos") - F.col("tss")) <= distance)
        .drop("tss")
    )


def add_num_tests(df: DataFrame, keys: Sequence[str], pval: str = "pval") -> DataFrame:
    """Number of tested variants of each row's gene (rows with null keys drop out).

    Counts are combined before the shuffle and joined back from a small table, so a
    gene with very many rows is never gathered in one task.
    """
    counts = df.groupBy(*keys).agg(F.count(pval).cast("int").alias("num_tests"))
    return df.join(hand_over(counts, "num-tests"), list(keys))


def best_junction_table(
    df: DataFrame, scope: Sequence[str] = ("study_id", "bio_feature"), pval: str = "pval"
) -> DataFrame:
    """Junction(s) with the smallest p-value of each splicing cluster and gene.

    The rows are aggregated once, per junction, with the number of tests; the cluster
    minimum is taken from that table. Ties are kept.
    """
    junction = [*scope, "phenotype_id", "splicing_cluster", "gene_id"]
    cluster = [*scope, "splicing_cluster", "gene_id"]
    per_junction = hand_over(
        df.groupBy(*junction).agg(
            F.count(pval).cast("int").alias("num_tests"), F.min(pval).alias("_junction_p")
        ),
        "junctions",
    )
    per_cluster = per_junction.groupBy(*cluster).agg(F.min("_junction_p").alias("_cluster_p"))
    best = per_junction.join(per_cluster, cluster).where("_junction_p <= _cluster_p")
    return hand_over(best.select(*scope, "phenotype_id", "num_tests"), "best-junctions")


def best_junctions(
    df: DataFrame, scope: Sequence[str] = ("study_id", "bio_feature"), pval: str = "pval"
) -> DataFrame:
    """Rows of the best junctions, with the number of tests of their junction.

    Cluster and gene are parts of the junction id, so the id alone selects rows.
    """
    return df.join(best_junction_table(df, scope, pval), [*scope, "phenotype_id"])


def tissue_codes(df: DataFrame, codes: DataFrame, name: str = "biofeature_string") -> DataFrame:
    """Replace tissue names by ontology codes; an unknown tissue fails the job."""
    once = codes.groupBy(F.col("biofeature_string").alias(name)).agg(
        F.min("biofeature_code").alias("_code")
    )
    lookup = hand_over(once, "tissue-codes")
    unknown = F.raise_error(F.concat(F.lit("unknown tissue: "), F.coalesce(name, F.lit("null"))))
    return (
        df.join(lookup, name, "left")
        .withColumn("bio_feature", F.coalesce("_code", unknown))
        .drop("_code", name)
    )
