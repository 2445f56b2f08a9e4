"""Queries: gene-level statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan.operators import genes, quantiles, reports
from helixspan.plans import genes as gene_plans
from helixspan.registry.core import query
from helixspan.registry.views import Tables
from helixspan.session import hand_over

# Data sets carry project names, so that labels and types can be told apart.
_NAMED = """named AS (SELECT CASE WHEN study_id = 'QA' THEN 'GTEx-sQTL' WHEN study_id = 'QN'
        THEN 'GTEx-eQTL' ELSE study_id END AS study_id, bio_feature, gene_id, pval FROM v_qtl)"""
_MIN_P = f"""{_NAMED},
    genes AS (SELECT study_id, bio_feature, gene_id, count(pval) AS num_tests,
        min(pval) AS min_pval FROM named GROUP BY 1, 2, 3)"""
_FDR = f"""{_MIN_P},
    scored AS (SELECT *, least(min_pval * num_tests, 1e0) AS p_bonf FROM genes),
    ranked AS (SELECT *, least(p_bonf * count(*) OVER (PARTITION BY study_id, bio_feature)
        / row_number() OVER (PARTITION BY study_id, bio_feature ORDER BY p_bonf, min_pval, gene_id),
        1e0) AS raw FROM scored),
    fdr AS (SELECT study_id, bio_feature, gene_id, num_tests, min_pval, p_bonf,
        min(raw) OVER (PARTITION BY study_id, bio_feature ORDER BY p_bonf, min_pval, gene_id
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS qval FROM ranked)"""
_COUNTS = f"""{_FDR},
    labelled AS (SELECT *, concat_ws('-', study_id, bio_feature) AS dataset,
        CASE WHEN concat_ws('-', study_id, bio_feature) LIKE '%sQTL%' THEN 'sQTL' ELSE 'eQTL' END
        AS type FROM fdr),
    limits AS (SELECT * FROM (VALUES ('p < 1e-4', 1, 1e-4), ('p < 1e-5', 1, 1e-5),
        ('p < 1e-6', 1, 1e-6), ('p < 5e-8', 1, 5e-8), ('FDR 5%', 2, 0.05e0),
        ('pbonf < 0.05', 3, 0.05e0)) v(threshold, kind, cutoff)),
    counts AS (SELECT dataset, type, cast(count_if(min_pval < 5e-8) AS bigint) AS gws_count,
        threshold, cast(count_if(CASE kind WHEN 1 THEN min_pval WHEN 2 THEN qval ELSE p_bonf END
            < cutoff) AS bigint) AS "count"
        FROM labelled, limits GROUP BY dataset, type, threshold)"""


def _named(t: Tables) -> DataFrame:
    study = (
        F.when(F.col("study_id") == "QA", "GTEx-sQTL")
        .when(F.col("study_id") == "QN", "GTEx-eQTL")
        .otherwise(F.col("study_id"))
    )
    return t.view("v_qtl").withColumn("study_id", study)


@query(f"WITH {_MIN_P} SELECT * FROM genes")
def gene_min_p(t: Tables) -> DataFrame:
    return genes.order_by_min_p(genes.gene_min_p(_named(t)))


@query(
    f"""WITH {_FDR} SELECT study_id, bio_feature, gene_id, num_tests, min_pval,
    round(p_bonf, 12) AS p_bonf, round(qval, 12) AS qval FROM fdr"""
)
def bh_fdr(t: Tables) -> DataFrame:
    return gene_plans.fdr_table([_named(t)]).select(
        "study_id", "bio_feature", "gene_id", "num_tests", "min_pval",
        F.round("p_bonf", 12).alias("p_bonf"), F.round("qval", 12).alias("qval"),
    )


def _counts(t: Tables) -> DataFrame:
    return genes.threshold_counts(gene_plans.fdr_table([_named(t)]))


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def threshold_counts(t: Tables) -> DataFrame:
    return _counts(t)


@query(
    f"""WITH {_COUNTS} SELECT threshold, cast(sum("count") AS bigint) AS total_count,
    median("count") AS median_count FROM counts GROUP BY threshold"""
)
def threshold_summary(t: Tables) -> DataFrame:
    return genes.threshold_summary(_counts(t))


@query(
    """SELECT study_id, bio_feature, median(pval) AS median_pval FROM v_qtl GROUP BY ALL"""
)
def median_per_dataset(t: Tables) -> DataFrame:
    """Median p per data set over all rows; a data set may hold most of them."""
    return quantiles.medians(t.view("v_qtl"), ["study_id", "bio_feature"], "pval", "median_pval")


@query(
    f"""WITH {_COUNTS} SELECT threshold,
        cast(sum(CASE WHEN type = 'eQTL' THEN "count" END) AS bigint) AS "eQTL",
        cast(sum(CASE WHEN type = 'sQTL' THEN "count" END) AS bigint) AS "sQTL"
    FROM counts WHERE threshold <> 'p < 1e-4' AND dataset LIKE '%GTE%' GROUP BY threshold"""
)
def pivot_by_type(t: Tables) -> DataFrame:
    fdr = gene_plans.fdr_table([_named(t)])
    return gene_plans.threshold_tables(fdr)["totals_by_type"]


@query(
    f"""WITH {_COUNTS} SELECT threshold, median(CASE WHEN type = 'eQTL' THEN "count" END) AS "eQTL",
        median(CASE WHEN type = 'sQTL' THEN "count" END) AS "sQTL"
    FROM counts WHERE threshold <> 'p < 1e-4' AND dataset LIKE '%GTE%' GROUP BY threshold"""
)
def pivot_medians(t: Tables) -> DataFrame:
    fdr = gene_plans.fdr_table([_named(t)])
    return gene_plans.threshold_tables(fdr)["medians_by_type"]


@query(
    f"""WITH {_MIN_P} SELECT concat_ws('-', study_id, bio_feature) AS dataset,
        count(*) AS num_genes_tested FROM genes GROUP BY 1"""
)
def genes_per_dataset(t: Tables) -> DataFrame:
    table = genes.gene_min_p(_named(t)).withColumn(
        "dataset", F.concat_ws("-", "study_id", "bio_feature")
    )
    return reports.tests_per_dataset(table)


_PUBLICATIONS = """pubs AS (SELECT pmid, author, count(*) AS num_gwas FROM v_publication
    GROUP BY 1, 2)"""


@query(
    f"""WITH {_PUBLICATIONS} SELECT pmid, author, num_gwas,
        cast(sum(num_gwas) OVER w AS bigint) AS total_gwas,
        row_number() OVER w AS publication_index FROM pubs
    WINDOW w AS (ORDER BY num_gwas DESC, pmid, author ROWS UNBOUNDED PRECEDING)"""
)
def pub_counts_cumulative(t: Tables) -> DataFrame:
    return reports.cumulative_publications(reports.publication_counts(t.view("v_publication")))


@query(
    f"""WITH {_PUBLICATIONS} SELECT s.*, p.num_gwas FROM v_publication s
    LEFT JOIN (SELECT pmid, num_gwas FROM pubs) p USING (pmid)"""
)
def publication_totals(t: Tables) -> DataFrame:
    rows = t.view("v_publication")
    counts = hand_over(reports.publication_counts(rows), "publications")
    return reports.with_publication_totals(rows, counts)


@query(
    """SELECT phenocode LIKE '%EXALLC%' AS marked, cast(sum(num_gw_significant) AS bigint) AS n_loci
    FROM v_endpoint WHERE phenocode LIKE 'CD2\\_%' ESCAPE '\\' GROUP BY 1"""
)
def loci_by_name(t: Tables) -> DataFrame:
    return reports.loci_by_name(t.view("v_endpoint"), "phenocode", "num_gw_significant")


@query(
    """SELECT sample_size, count(*) AS snp_count FROM (
        SELECT cast(list_sum(list_transform(list_filter(string_split("DatasetsNrSamples", ';'),
            lambda x: x <> '-'), lambda x: cast(x AS int))) AS int) AS sample_size
        FROM v_samples) t GROUP BY sample_size"""
)
def sample_size_hist(t: Tables) -> DataFrame:
    return reports.sample_size_table(t.view("v_samples"))
