"""Queries: panel joins, cis windows, test counts, sites, liftover."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan.functions import ids, stats
from helixspan.operators import harmonise, liftover, qtl
from helixspan.registry.core import query
from helixspan.registry.views import Tables
from helixspan.session import scratch_path
from helixspan.sources import buckets, chains


@query(
    """SELECT g.study_id, g.chrom, g.pos, g.ref, g.alt, coalesce(g.eaf, p.gnomad_nfe) AS eaf
    FROM v_gwas g LEFT JOIN v_panel p ON g.chrom = p.chrom_b37 AND g.pos = p.pos_b37
        AND g.ref = p.ref AND g.alt = p.alt"""
)
def eaf_fill(t: Tables) -> DataFrame:
    filled = harmonise.fill_eaf(t.view("v_gwas"), harmonise.panel_sites(t.panel(), "b37"))
    return filled.select("study_id", "chrom", "pos", "ref", "alt", "eaf")


@query(
    """SELECT g.study_id, g.chrom, g.pos, g.ref, g.alt, coalesce(g.eaf, p.gnomad_nfe) AS eaf
    FROM v_gwas g LEFT JOIN v_panel p ON g.chrom = p.chrom_b37 AND g.pos = p.pos_b37
        AND g.ref = p.ref AND g.alt = p.alt"""
)
def eaf_fill_bucketed(t: Tables) -> DataFrame:
    """Frequencies from a panel that lies in buckets by variant, for rows dealt alike."""
    path = scratch_path(t.spark, "panel")
    buckets.write_bucketed(harmonise.panel_sites(t.panel(), "b37"), path, 8)
    sites = harmonise.panel_sites(buckets.read_bucketed(t.spark, path))
    rows = buckets.alike_bucketed(t.view("v_gwas").select("study_id", *harmonise.VARIANT, "eaf"), path)
    return harmonise.fill_eaf(rows, sites).select("study_id", "chrom", "pos", "ref", "alt", "eaf")


@query(
    """SELECT q.phenotype_id, q.chrom, q.pos, q.ref, q.alt,
        CASE WHEN p.gnomad_nfe <= 0.5e0 THEN q.maf ELSE 1e0 - q.maf END AS eaf, p.pos_b38
    FROM v_qtl q JOIN v_panel p ON q.chrom = p.chrom_b37 AND q.pos = p.pos_b37
        AND q.ref = p.ref AND q.alt = p.alt AND p.gnomad_nfe IS NOT NULL"""
)
def panel_presence(t: Tables) -> DataFrame:
    sites = harmonise.panel_sites(t.panel(), "b37", ["pos_b38"])
    known = harmonise.in_panel(t.view("v_qtl"), sites)
    eaf = stats.eaf_from_maf(F.col("maf"), F.col("gnomad_nfe"))
    return known.select("phenotype_id", "chrom", "pos", "ref", "alt", eaf.alias("eaf"), "pos_b38")


@query(
    """SELECT a.gene_id, p.chrom_b38 AS chrom, p.pos_b38 AS pos, p.ref, p.alt,
        CASE WHEN a.effect_allele = p.ref THEN -a.beta ELSE a.beta END AS beta,
        p.gnomad_nfe AS eaf
    FROM v_alleles a JOIN v_panel p ON a.chrom = p.chrom_b37 AND a.pos = p.pos_b37
        AND ((p.ref = a.other_allele AND p.alt = a.effect_allele)
          OR (p.ref = a.effect_allele AND p.alt = a.other_allele))"""
)
def allele_harmonise(t: Tables) -> DataFrame:
    sites = harmonise.panel_sites(t.panel(), "b37", ["chrom_b38", "pos_b38"], known_only=False)
    aligned = harmonise.orient(harmonise.align_alleles(t.view("v_alleles"), sites), "beta")
    return harmonise.to_new_build(aligned).select(
        "gene_id", "chrom", "pos", "ref", "alt", "beta", F.col("gnomad_nfe").alias("eaf")
    )


@query(
    """SELECT q.phenotype_id, q.chrom, q.pos, q.pval FROM v_qtl q
    JOIN v_gene g ON q.gene_id = g.gene_id AND q.chrom = g.chr
    WHERE abs(q.pos - g.tss) <= 20000"""
)
def cis_window(t: Tables) -> DataFrame:
    genes = qtl.gene_positions(t.view("v_gene"))
    near = qtl.cis_rows(t.view("v_qtl"), genes, ["gene_id", "chrom"], 20000)
    return near.select("phenotype_id", "chrom", "pos", "pval")


@query(
    """SELECT m.phenotype_id, g.gene_id, g.chr AS chrom, g.tss FROM
        (SELECT concat('p', cast(s_suppkey AS varchar)) AS phenotype_id,
                concat('U', cast(s_suppkey%40 AS varchar)) AS UniProt FROM supplier) m
    JOIN (SELECT concat('U', cast(s_suppkey AS varchar)) AS UniProt,
                CASE WHEN s_suppkey%6=0 THEN 'other' ELSE concat('ENSG',
                lpad(cast(s_suppkey AS varchar),11,'0')) END AS gene_id FROM supplier) u
        ON m.UniProt = u.UniProt AND u.gene_id LIKE 'ENSG%'
    JOIN v_gene g ON u.gene_id = g.gene_id"""
)
def protein_gene_map(t: Tables) -> DataFrame:
    supplier = t.base("supplier")
    manifest = supplier.selectExpr(
        "concat('p', cast(s_suppkey as string)) AS phenotype_id",
        "concat('U', cast(s_suppkey%40 as string)) AS UniProt",
    )
    proteins = supplier.selectExpr(
        "concat('U', cast(s_suppkey as string)) AS UniProt",
        "case when s_suppkey%6=0 then 'other' else"
        " concat('ENSG', lpad(cast(s_suppkey as string),11,'0')) end AS gene_id",
    )
    return qtl.protein_gene_map(manifest, proteins, t.view("v_gene")).select(
        "phenotype_id", "gene_id", "chrom", "tss"
    )


@query(
    """SELECT phenotype_id, bio_feature, chrom, pos, cast(n AS int) AS num_tests
    FROM v_qtl JOIN (SELECT phenotype_id, bio_feature, count(pval) AS n FROM v_qtl GROUP BY 1, 2) c
    USING (phenotype_id, bio_feature)"""
)
def num_tests(t: Tables) -> DataFrame:
    tested = qtl.add_num_tests(t.view("v_qtl"), ["phenotype_id", "bio_feature"])
    return tested.select("phenotype_id", "bio_feature", "chrom", "pos", "num_tests")


@query(
    """WITH parsed AS (SELECT study_id, bio_feature,
        replace(regexp_replace(phenotype_id, '\\.[^.]*$', ''), ':', '^') AS phenotype_id,
        split_part(phenotype_id, ':', 4) AS splicing_cluster,
        split_part(split_part(phenotype_id, ':', 5), '.', 1) AS gene_id, variant_id, pval_nominal
        FROM v_junction),
    junctions AS (SELECT study_id, bio_feature, phenotype_id, count(pval_nominal) AS num_tests,
        min(pval_nominal) AS junction_p FROM parsed GROUP BY 1, 2, 3),
    clusters AS (SELECT study_id, bio_feature, splicing_cluster, gene_id,
        min(pval_nominal) AS cluster_p FROM parsed GROUP BY 1, 2, 3, 4)
    SELECT study_id, bio_feature, phenotype_id, gene_id, variant_id, pval_nominal,
        cast(num_tests AS int) AS num_tests
    FROM parsed JOIN junctions USING (study_id, bio_feature, phenotype_id)
    JOIN clusters USING (study_id, bio_feature, splicing_cluster, gene_id)
    WHERE junction_p <= cluster_p"""
)
def best_junction(t: Tables) -> DataFrame:
    rows = t.view("v_junction").withColumns(ids.junction_parts(F.col("phenotype_id")))
    best = qtl.best_junctions(rows, pval="pval_nominal")
    return best.select(
        "study_id", "bio_feature", "phenotype_id", "gene_id", "variant_id", "pval_nominal",
        "num_tests",
    )


@query(
    """SELECT DISTINCT chrom, pos, ref, alt FROM v_gwas
    UNION SELECT DISTINCT chrom, pos, ref, 'N' FROM v_qtl WHERE pos%2=0"""
)
def site_list(t: Tables) -> DataFrame:
    second = t.view("v_qtl").where("pos%2=0").withColumn("alt", F.lit("N"))
    return harmonise.site_list(t.view("v_gwas"), second)


_SPLIT = """SELECT DISTINCT chrom_b37, pos_b37, rsid, ref, unnest(string_split(alts, ',')) AS alt
    FROM v_vcf"""


@query(_SPLIT)
def multiallelic_explode(t: Tables) -> DataFrame:
    return harmonise.split_alternatives(t.view("v_vcf"))


@query(
    f"""WITH names AS ({_SPLIT})
    SELECT s.chrom, s.pos, s.ref, s.alt, n.rsid FROM (SELECT DISTINCT chrom, pos, ref, alt FROM v_gwas) s
    LEFT JOIN names n ON s.chrom = n.chrom_b37 AND s.pos = n.pos_b37 AND s.ref = n.ref
        AND s.alt = n.alt"""
)
def rsid_join(t: Tables) -> DataFrame:
    names = harmonise.split_alternatives(t.view("v_vcf")).withColumnsRenamed(
        {"chrom_b37": "chrom", "pos_b37": "pos"}
    )
    sites = harmonise.site_list(t.view("v_gwas"))
    return harmonise.attach_by_variant(sites, names, ["rsid"], "left")


_LIFTED = """SELECT a.gene_id, a.chrom, a.pos, c.q_chrom AS chrom_b38,
        cast(CASE WHEN c.strand = '-' THEN c.q_size - 1 - (c.q_start + a.pos - 1 - c.t_start)
            ELSE c.q_start + a.pos - 1 - c.t_start END + 1 AS int) AS pos_b38
    FROM v_alleles a LEFT JOIN v_chain c ON a.chrom = c.chrom
        AND a.pos - 1 >= c.t_start AND a.pos - 1 < c.t_end"""


@query(_LIFTED)
def liftover_sites(t: Tables) -> DataFrame:
    segments = liftover.flatten_chain(t.view("v_chain"))
    return liftover.lift(t.view("v_alleles").select("gene_id", "chrom", "pos"), segments)


_PARTS = """SELECT chrom, q_chrom, q_size, strand, t_start, t_start + 5000 AS t_end, q_start FROM v_chain
    UNION ALL SELECT chrom, q_chrom, q_size, strand, t_start + 5100, t_start + 9100, q_start + 5040
    FROM v_chain
    UNION ALL SELECT chrom, q_chrom, q_size, strand, t_start + 9100, t_end, q_start + 9340 FROM v_chain"""


@query(f"WITH parts AS ({_PARTS}) " + _LIFTED.replace("v_chain", "parts"))
def liftover_from_chain(t: Tables) -> DataFrame:
    """Sites through a chain file; every chain of the table is three blocks with gaps between."""
    path = scratch_path(t.spark, "chain")
    length = F.col("t_end") - F.col("t_start")
    header = F.concat_ws(
        " ", F.lit("chain"), "chain_score", F.concat(F.lit("chr"), "chrom"), F.lit(2000000), F.lit("+"),
        "t_start", "t_end", "q_chrom", "q_size", "strand", "q_start",
        F.col("q_start") + length + 240, "t_start",
    )
    last = F.concat((length - 9100).cast("string"), F.lit("\n"))
    record = F.concat_ws("\n", header, F.lit("5000 100 40"), F.lit("4000 0 300"), last)
    t.view("v_chain").select(record).write.text(path)
    segments = liftover.flatten_chain(chains.read_chain(t.spark, path))
    return liftover.lift(t.view("v_alleles").select("gene_id", "chrom", "pos"), segments)
