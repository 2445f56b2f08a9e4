"""Queries: whole pipelines, each checked against one SQL statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan.operators import qc, qtl
from helixspan.plans import exports, gwas, molecular
from helixspan.registry.core import query
from helixspan.registry.scalars import _quantile_sql
from helixspan.registry.views import Tables
from helixspan.session import hand_over

_PANEL_JOIN = """{kind} JOIN v_panel p ON {alias}.chrom = p.chrom_b37 AND {alias}.pos = p.pos_b37
    AND {alias}.ref = p.ref AND {alias}.alt = p.alt AND p.gnomad_nfe IS NOT NULL"""
_FLOOR = "CASE WHEN pval = 0 THEN 2.2250738585072014e-308 ELSE pval END"
_STUDIES = """sizes AS (SELECT DISTINCT study_id, cast(1000 AS int) AS n_total,
    cast(CASE WHEN study_id = 'GCSTA' THEN 300 END AS int) AS n_cases FROM v_gwas)"""


def _studies(t: Tables) -> DataFrame:
    return t.view("v_gwas").select("study_id").distinct().withColumns(
        {
            "n_total": F.lit(1000),
            "n_cases": F.when(F.col("study_id") == "GCSTA", F.lit(300)),
        }
    )


def _panel_by_old_position(t: Tables) -> DataFrame:
    """The panel under one coordinate system, as harmonised deliveries use it."""
    return t.panel().withColumn("pos_b38", F.col("pos_b37"))


def _gwas_select(source: str) -> str:
    return f"""SELECT 'gwas' AS type, study_id, cast(NULL AS varchar) AS phenotype_id,
        cast(NULL AS varchar) AS bio_feature, cast(NULL AS varchar) AS gene_id, chrom, pos, ref, alt,
        round(beta, 9) AS beta, round(se, 7) AS se, {_FLOOR} AS pval, n_total, n_cases, eaf,
        n_total*2*maf AS mac, n_cases*2*maf AS mac_cases, info, n_cases IS NOT NULL AS is_cc
    FROM (SELECT *, CASE WHEN eaf <= 0.5e0 THEN eaf ELSE 1e0-eaf END AS maf FROM {source}) m
    JOIN sizes USING (study_id)
    WHERE n_total*2*maf >= 10 AND (n_cases*2*maf >= 10 OR n_cases IS NULL)"""


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


@query(
    f"""WITH {_STUDIES},
    odds AS (SELECT study_id, chrom, pos, ref, alt, pval, info, eaf,
        CASE WHEN oddsr IS NOT NULL AND oddsr_lower IS NOT NULL THEN ln(oddsr) ELSE beta END AS beta,
        CASE WHEN oddsr IS NOT NULL AND oddsr_lower IS NOT NULL
            THEN (ln(oddsr) - ln(oddsr_lower)) / 1.95996398454005423552e0 ELSE se END AS se
        FROM v_gwas),
    halved AS (SELECT *, {_FLOOR} / 2e0 AS h FROM odds),
    staged AS (SELECT *, sqrt(-ln(h)) AS r FROM halved),
    scored AS (SELECT *, {_quantile_sql()} AS z FROM staged),
    effects AS (SELECT study_id, chrom, pos, ref, alt, pval, info, eaf, beta,
        coalesce(se, abs(beta) / nullif(z, 0)) AS se FROM scored),
    usable AS (SELECT * FROM effects WHERE beta IS NOT NULL AND se IS NOT NULL AND pval IS NOT NULL),
    filled AS (SELECT e.study_id, e.chrom, e.pos, e.ref, e.alt, e.pval, e.info, e.beta, e.se,
        coalesce(e.eaf, p.gnomad_nfe) AS eaf
        FROM usable e {_PANEL_JOIN.format(kind='LEFT', alias='e')}),
    ready AS (SELECT * FROM filled WHERE eaf IS NOT NULL)
    {_gwas_select('ready')}"""
)
def pipeline_gwas(t: Tables) -> DataFrame:
    result = gwas.standardise(
        t.view("v_gwas").drop("phenotype_id", "bio_feature", "gene_id"),
        _studies(t),
        _panel_by_old_position(t),
        min_rows=100,
    )
    return _rounded(result, beta=9, se=7)


@query(
    f"""WITH {_STUDIES},
    ready AS (SELECT * FROM v_gwas WHERE se IS NOT NULL AND eaf IS NOT NULL)
    {_gwas_select('ready')}"""
)
def pipeline_gwas_complete(t: Tables) -> DataFrame:
    rows = t.view("v_gwas").drop("phenotype_id", "bio_feature", "gene_id", "oddsr", "oddsr_lower")
    return _rounded(gwas.standardise_complete(rows, _studies(t), min_rows=100), beta=9, se=7)




def _qtl_columns(kind: str) -> str:
    return f"""'{kind}' AS type, study_id, phenotype_id, bio_feature, gene_id, chrom, pos, ref, alt,
        beta, se, pval, n_total, cast(NULL AS int) AS n_cases, eaf, mac,
        cast(NULL AS int) AS mac_cases, cast(num_tests AS int) AS num_tests, info, false AS is_cc"""


@query(
    f"""WITH frequent AS (SELECT *, least(ac, an-ac) AS mac, maf AS eaf, r2 AS info,
        cast(floor(an/2e0) AS int) AS n_total FROM v_qtl WHERE least(ac, an-ac) >= 5),
    tests AS (SELECT study_id, bio_feature, phenotype_id, count(pval) AS num_tests
        FROM frequent GROUP BY 1, 2, 3)
    SELECT {_qtl_columns('eqtl')} FROM frequent JOIN tests USING (study_id, bio_feature, phenotype_id)"""
)
def pipeline_eqtl(t: Tables) -> DataFrame:
    rows = t.view("v_qtl").selectExpr(
        "phenotype_id AS molecular_trait_id", "chrom AS chromosome", "pos AS position", "ref",
        "alt", "maf", "pval AS pvalue", "beta", "se", "ac", "an", "r2", "gene_id", "study_id",
        "bio_feature",
    )
    return molecular.eqtl(
        rows, study_id=F.col("study_id"), bio_feature=F.col("bio_feature")
    )


@query(
    """WITH counts AS (SELECT count(*) AS n0, count_if(least(ac, an-ac) >= 5) AS n1 FROM v_qtl)
    SELECT cast(0 AS int) AS step_no, 'input' AS step, n0 AS n_rows, cast(0 AS bigint) AS removed,
        0e0 AS removed_pct FROM counts
    UNION ALL SELECT 1, 'minor allele count', cast(n1 AS bigint), cast(n0-n1 AS bigint), round((n0-n1)*100e0/n0, 2) FROM counts"""
)
def molecular_report(t: Tables) -> DataFrame:
    """Rows left after each step of an expression ingest, observed while it is written."""
    with qc.step_log() as steps:
        hand_over(pipeline_eqtl(t), "result")
    return steps.report(t.spark)


_ALIGNED = """SELECT a.*, p.ref, p.alt, p.chrom_b38, p.pos_b38, p.gnomad_nfe FROM {source} a
    JOIN v_panel p ON a.chrom = p.chrom_b37 AND a.pos = p.pos_b37
    AND ((p.ref = a.other_allele AND p.alt = a.effect_allele)
      OR (p.ref = a.effect_allele AND p.alt = a.other_allele))"""


@query(
    f"""WITH aligned AS ({_ALIGNED.format(source='v_alleles')}),
    turned AS (SELECT *, CASE WHEN effect_allele = ref THEN -z ELSE z END AS zz FROM aligned),
    scaled AS (SELECT *, sqrt(2e0*gnomad_nfe*(1e0-gnomad_nfe)*(n_total+zz*zz)) AS s FROM turned),
    tests AS (SELECT gene_id, count(pval) AS num_tests FROM aligned GROUP BY 1),
    named AS (SELECT 'STUDY' AS study_id, gene_id AS phenotype_id, 'TISSUE' AS bio_feature, gene_id,
        chrom_b38 AS chrom, pos_b38 AS pos, ref, alt, round(zz / nullif(s, 0), 9) AS beta,
        round(1e0 / nullif(s, 0), 9) AS se, pval, n_total, gnomad_nfe AS eaf,
        n_total*2*CASE WHEN gnomad_nfe <= 0.5e0 THEN gnomad_nfe ELSE 1e0-gnomad_nfe END AS mac0,
        num_tests, cast(NULL AS double) AS info
        FROM scaled JOIN tests USING (gene_id)),
    counted AS (SELECT *, cast(trunc(mac0) AS int) AS mac FROM named WHERE mac0 >= 5)
    SELECT {_qtl_columns('eqtl')} FROM counted WHERE beta IS NOT NULL AND se IS NOT NULL"""
)
def pipeline_eqtl_z(t: Tables) -> DataFrame:
    rows = t.view("v_alleles").drop("beta", "se", "log10_pval")
    result = molecular.eqtl_from_z(rows, t.panel(), study_id="STUDY", bio_feature="TISSUE")
    return _rounded(result, beta=9, se=9)


_TISSUE = """eaf, cast(trunc(ma_count / nullif(maf, 0) / 2e0) AS int) AS n_total,
        slope AS beta, slope_se AS se, pval_nominal AS pval, ma_count AS mac,
        cast(NULL AS double) AS info"""


@query(
    f"""WITH rows_ AS (SELECT study_id, concat('UBERON_', bio_feature) AS bio_feature, gene_id,
        chrom, pos, ref, alt, ma_count, maf, pval AS pval_nominal, beta AS slope, se AS slope_se
        FROM v_qtl WHERE ma_count >= 5),
    known AS (SELECT q.*, p.chrom_b38, p.pos_b38,
        CASE WHEN p.gnomad_nfe <= 0.5e0 THEN q.maf ELSE 1e0-q.maf END AS eaf
        FROM rows_ q {_PANEL_JOIN.format(kind='INNER', alias='q')}),
    tests AS (SELECT study_id, bio_feature, gene_id, count(pval_nominal) AS num_tests
        FROM known GROUP BY 1, 2, 3),
    named AS (SELECT study_id, bio_feature, gene_id, gene_id AS phenotype_id, chrom_b38 AS chrom,
        pos_b38 AS pos, ref, alt, num_tests, {_TISSUE}
        FROM known JOIN tests USING (study_id, bio_feature, gene_id))
    SELECT {_qtl_columns('eqtl')} FROM named"""
)
def pipeline_tissue_eqtl(t: Tables) -> DataFrame:
    rows = t.view("v_qtl").selectExpr(
        "study_id", "concat(gene_id, '.4') AS gene_id", "bio_feature AS biofeature_string",
        "concat_ws('_', chrom, cast(pos as string), ref, alt, 'b37') AS variant_id",
        "ma_count", "maf", "pval AS pval_nominal", "beta AS slope", "se AS slope_se",
    )
    codes = t.view("v_qtl").selectExpr(
        "bio_feature AS biofeature_string", "concat('UBERON_', bio_feature) AS biofeature_code"
    )
    return molecular.tissue_eqtl(rows, t.panel(), codes.distinct(), study_id=F.col("study_id"))


@query(
    f"""WITH parsed AS (SELECT *, replace(regexp_replace(phenotype_id, '\\.[^.]*$', ''), ':', '^')
            AS junction, split_part(phenotype_id, ':', 4) AS cluster,
        split_part(split_part(phenotype_id, ':', 5), '.', 1) AS gene_id,
        replace(split_part(variant_id, '_', 1), 'chr', '') AS chrom,
        cast(split_part(variant_id, '_', 2) AS int) AS pos, split_part(variant_id, '_', 3) AS ref,
        split_part(variant_id, '_', 4) AS alt FROM v_junction WHERE ma_count >= 5),
    known AS (SELECT q.*, CASE WHEN p.gnomad_nfe <= 0.5e0 THEN q.maf ELSE 1e0-q.maf END AS eaf
        FROM parsed q {_PANEL_JOIN.format(kind='INNER', alias='q')}),
    junctions AS (SELECT study_id, bio_feature, junction, count(pval_nominal) AS num_tests,
        min(pval_nominal) AS junction_p FROM known GROUP BY 1, 2, 3),
    clusters AS (SELECT study_id, bio_feature, cluster, gene_id, min(pval_nominal) AS cluster_p
        FROM known GROUP BY 1, 2, 3, 4),
    named AS (SELECT study_id, bio_feature, junction AS phenotype_id, gene_id, chrom, pos, ref, alt,
        num_tests, {_TISSUE} FROM known JOIN junctions USING (study_id, bio_feature, junction)
        JOIN clusters USING (study_id, bio_feature, cluster, gene_id)
        WHERE junction_p <= cluster_p)
    SELECT {_qtl_columns('sqtl')} FROM named"""
)
def pipeline_sqtl(t: Tables) -> DataFrame:
    return molecular.tissue_sqtl(
        t.view("v_junction"),
        _panel_by_old_position(t),
        study_id=F.col("study_id"),
        bio_feature=F.col("bio_feature"),
    )


_DISTANCE = 20000


@query(
    f"""WITH near AS (SELECT concat('P', '.', a.gene_id) AS phenotype_id, a.gene_id, a.chrom, a.pos,
        effect_allele, other_allele, beta, se, power(10e0, log10_pval) AS p0 FROM v_alleles a
        JOIN v_gene g ON a.gene_id = g.gene_id AND a.chrom = g.chr AND abs(a.pos - g.tss) <= {_DISTANCE}),
    aligned AS ({_ALIGNED.format(source='near')}),
    tests AS (SELECT phenotype_id, count(*) AS num_tests FROM aligned GROUP BY 1),
    named AS (SELECT 'S' AS study_id, replace(phenotype_id, '.', '_') AS phenotype_id,
        'TISSUE' AS bio_feature, gene_id, chrom_b38 AS chrom, pos_b38 AS pos, ref, alt,
        CASE WHEN effect_allele = ref THEN -beta ELSE beta END AS beta, se,
        round(log10(p0), 6) AS pval, cast(3301 AS int) AS n_total, gnomad_nfe AS eaf,
        3301*2*CASE WHEN gnomad_nfe <= 0.5e0 THEN gnomad_nfe ELSE 1e0-gnomad_nfe END AS mac0,
        num_tests, cast(NULL AS double) AS info FROM aligned JOIN tests USING (phenotype_id)),
    counted AS (SELECT *, cast(trunc(mac0) AS int) AS mac FROM named WHERE mac0 >= 5)
    SELECT {_qtl_columns('pqtl')} FROM counted"""
)
def pipeline_pqtl_aligned(t: Tables) -> DataFrame:
    rows = t.view("v_alleles").selectExpr(
        "concat('P.', gene_id) AS phenotype_id", "chrom", "pos",
        "lower(effect_allele) AS effect_allele", "lower(other_allele) AS other_allele",
        "beta", "se", "log10_pval",
    )
    genes = qtl.gene_positions(t.view("v_gene")).withColumn(
        "phenotype_id", F.concat(F.lit("P."), "gene_id")
    )
    result = molecular.aligned_pqtl(
        rows, genes, t.panel(), _DISTANCE, study_id="S", bio_feature="TISSUE", n_total=3301
    )
    return result.withColumn("pval", F.round(F.log10("pval"), 6))


def _pqtl_oracle(se: str, min_mac: str) -> str:
    return f"""WITH near AS (SELECT q.gene_id, q.chrom, q.pos, q.ref, q.alt, q.beta, {se} AS se, q.pval,
            CASE WHEN q.ma_count%3=0 THEN NULL ELSE q.maf END AS eaf, q.r2 FROM v_qtl q
        JOIN v_gene g ON q.gene_id = g.gene_id AND q.chrom = g.chr AND abs(q.pos - g.tss) <= {_DISTANCE}),
    filled AS (SELECT n.gene_id, n.chrom, n.pos, n.ref, n.alt, n.beta, n.se, n.pval, n.r2 AS info,
        coalesce(n.eaf, p.gnomad_nfe) AS eaf
        FROM near n {_PANEL_JOIN.format(kind='LEFT', alias='n')}),
    ready AS (SELECT * FROM filled WHERE eaf IS NOT NULL),
    tests AS (SELECT gene_id, count(pval) AS num_tests FROM ready GROUP BY 1),
    named AS (SELECT 'S' AS study_id, gene_id AS phenotype_id, 'TISSUE' AS bio_feature, gene_id, chrom,
        pos, ref, alt, beta, se, pval, cast(900 AS int) AS n_total, eaf,
        900*2*CASE WHEN eaf <= 0.5e0 THEN eaf ELSE 1e0-eaf END AS mac0, num_tests, info
        FROM ready JOIN tests USING (gene_id)),
    counted AS (SELECT *, cast(trunc(mac0) AS int) AS mac FROM named WHERE mac0 >= {min_mac})
    SELECT {_qtl_columns('pqtl')} FROM counted WHERE se IS NOT NULL"""


def _pqtl_rows(t: Tables) -> DataFrame:
    return t.view("v_qtl").selectExpr(
        "concat(gene_id, '.hm.tsv') AS file_name", "chrom", "pos", "ref", "alt", "beta", "se",
        "pval", "case when ma_count%3=0 then null else maf end AS eaf", "r2 AS info",
        "cast(pos%13-6 as double) AS z",
    )


def _pqtl_genes(t: Tables) -> DataFrame:
    names = t.view("v_gene").selectExpr("concat(gene_id, '.hm.tsv') AS file_name", "gene_id")
    return qtl.gene_map(names, t.view("v_gene"))


@query(_pqtl_oracle("q.se", "0"))
def pipeline_pqtl(t: Tables) -> DataFrame:
    return molecular.harmonised_pqtl(
        _pqtl_rows(t).drop("z"), _pqtl_genes(t), _panel_by_old_position(t), _DISTANCE,
        study_id="S", bio_feature="TISSUE", n_total=900,
    )


@query(_pqtl_oracle("abs(q.beta) / nullif(abs(cast(q.pos%13-6 AS double)), 0)", "5"))
def pipeline_pqtl_z(t: Tables) -> DataFrame:
    return molecular.harmonised_pqtl(
        _pqtl_rows(t), _pqtl_genes(t), _panel_by_old_position(t), _DISTANCE, min_mac=5,
        study_id="S", bio_feature="TISSUE", n_total=900,
    )


@query(
    """SELECT l.phenotype, r.rsid AS variant_id, round(l.beta, 12) AS beta,
        round(exp(l.beta / nullif(s, 0)), 6) AS odds_ratio,
        round(exp(l.beta / nullif(s, 0) - 1.96e0 * (l.se / nullif(s, 0))), 6) AS ci_lower,
        l."AC" / nullif(2e0 * n_complete_samples, 0) AS effect_allele_frequency, r.info
    FROM (SELECT v.*, p.mu*(1e0-p.mu) AS s FROM v_linear v JOIN (SELECT phenotype,
            n_cases / nullif(cast(n_cases + n_controls AS double), 0) AS mu FROM v_phenotype) p
            USING (phenotype)) l
    JOIN v_rsid r ON l.variant = concat(r.chr, ':', cast(r.pos AS varchar), ':', r.ref, ':', r.alt)"""
)
def pipeline_linear_export(t: Tables) -> DataFrame:
    result = exports.linear_model_export(
        t.view("v_linear"), t.view("v_rsid"), t.view("v_phenotype")
    )
    rounded = _rounded(result, beta=12, odds_ratio=6, ci_lower=6)
    return rounded.select(
        "phenotype", "variant_id", "beta", "odds_ratio", "ci_lower", "effect_allele_frequency",
        "info",
    )


@query(
    """SELECT snpid AS variant_id, chrom AS chromosome, pos AS base_pair_location,
        ref AS other_allele, alt AS effect_allele, ac, af AS effect_allele_frequency, beta,
        sebeta AS standard_error, pval AS "p-value", phenotype, round(exp(beta), 8) AS odds_ratio,
        round(exp(beta - 1.96e0*sebeta), 8) AS ci_lower,
        round(exp(beta + 1.96e0*sebeta), 8) AS ci_upper FROM v_mixed WHERE ac >= 3"""
)
def pipeline_mixed_export(t: Tables) -> DataFrame:
    result = exports.mixed_model_export(t.view("v_mixed"))
    return _rounded(result, odds_ratio=8, ci_lower=8, ci_upper=8)


@query(
    """WITH sites AS (SELECT DISTINCT chrom AS chrom_b37, pos AS pos_b37, ref, alt FROM v_mixed),
    names AS (SELECT DISTINCT chrom_b37, pos_b37, rsid, ref, unnest(string_split(alts, ',')) AS alt
        FROM v_vcf),
    lifted AS (SELECT s.*, replace(c.q_chrom, 'chr', '') AS chrom_b38,
        cast(CASE WHEN c.strand = '-' THEN c.q_size - 1 - (c.q_start + s.pos_b37 - 1 - c.t_start)
            ELSE c.q_start + s.pos_b37 - 1 - c.t_start END + 1 AS int) AS pos_b38
        FROM sites s LEFT JOIN v_chain c ON s.chrom_b37 = c.chrom
            AND s.pos_b37 - 1 >= c.t_start AND s.pos_b37 - 1 < c.t_end)
    SELECT l.chrom_b37, l.pos_b37, l.chrom_b38, l.pos_b38, l.ref, l.alt, n.rsid FROM lifted l
    LEFT JOIN names n ON l.chrom_b37 = n.chrom_b37 AND l.pos_b37 = n.pos_b37 AND l.ref = n.ref
        AND l.alt = n.alt"""
)
def pipeline_site_list(t: Tables) -> DataFrame:
    exported = exports.mixed_model_export(t.view("v_mixed"), 0)
    sites = exports.export_sites(exported, exported.where("base_pair_location%2=0"))
    return exports.annotated_sites(sites, t.view("v_chain"), t.view("v_vcf"))
