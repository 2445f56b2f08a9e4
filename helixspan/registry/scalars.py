"""Queries: effect sizes, p-values, allele counts, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan.functions import ids, stats, tails
from helixspan.operators import qc
from helixspan.registry.core import query
from helixspan.registry.views import Tables

_KEYS = ["study_id", "chrom", "pos", "ref", "alt"]
_SELECT = "SELECT study_id, chrom, pos, ref, alt"


@query(
    f"""{_SELECT},
    round(CASE WHEN oddsr IS NOT NULL AND oddsr_lower IS NOT NULL THEN ln(oddsr) ELSE beta END, 9)
        AS beta,
    round(CASE WHEN oddsr IS NOT NULL AND oddsr_lower IS NOT NULL
        THEN (ln(oddsr) - ln(oddsr_lower)) / 1.95996398454005423552e0 ELSE se END, 9) AS se
    FROM v_gwas"""
)
def or_to_beta(t: Tables) -> DataFrame:
    rows = stats.odds_to_effect(t.view("v_gwas"))
    return rows.select(*_KEYS, F.round("beta", 9).alias("beta"), F.round("se", 9).alias("se"))


def _horner(coefficients: list[float], x: str) -> str:
    text = repr(coefficients[-1]) if "e" in repr(coefficients[-1]) else f"{coefficients[-1]!r}e0"
    for c in reversed(coefficients[:-1]):
        literal = repr(c) if "e" in repr(c) else f"{c!r}e0"
        text = f"({text} * {x} + {literal})"
    return text


def _quantile_sql() -> str:
    """|normal quantile| of column h in (0, 0.5], radius in column r."""
    centre = "(0.5e0 - h)"
    inner = f"(0.180625e0 - {centre}*{centre})"
    return (
        f"CASE WHEN {centre} <= 0.425e0 THEN {centre} * {_horner(stats._CENTRE_NUM, inner)}"
        f" / {_horner(stats._CENTRE_DEN, inner)}"
        f" WHEN r <= 5e0 THEN {_horner(stats._MIDDLE_NUM, '(r - 1.6e0)')}"
        f" / {_horner(stats._MIDDLE_DEN, '(r - 1.6e0)')}"
        f" ELSE {_horner(stats._FAR_NUM, '(r - 5e0)')} / {_horner(stats._FAR_DEN, '(r - 5e0)')} END"
    )


@query(
    f"""WITH p AS (SELECT *, CASE WHEN pval = 0 THEN 2.2250738585072014e-308 ELSE pval END / 2e0
        AS h FROM v_gwas),
    staged AS (SELECT *, sqrt(-ln(h)) AS r FROM p),
    z AS (SELECT *, {_quantile_sql()} AS z FROM staged)
    {_SELECT}, round(coalesce(se, abs(beta) / nullif(z, 0)), 7) AS se FROM z"""
)
def se_from_p(t: Tables) -> DataFrame:
    rows = stats.impute_se(t.view("v_gwas"))
    return rows.select(*_KEYS, F.round("se", 7).alias("se"))


@query(
    f"""{_SELECT}, round(abs(beta) / nullif(abs(cast(pos%13 - 6 AS double)), 0), 9) AS se
    FROM v_gwas"""
)
def se_from_z(t: Tables) -> DataFrame:
    z = (F.col("pos") % 13 - 6).cast("double")
    return t.view("v_gwas").select(
        *_KEYS, F.round(stats.se_from_z(F.col("beta"), z), 9).alias("se")
    )


@query(
    """SELECT gene_id, chrom, pos, round(z / nullif(s, 0), 9) AS beta,
        round(1e0 / nullif(s, 0), 9) AS se FROM (
        SELECT *, sqrt(2e0*f*(1e0-f)*(n_total+z*z)) AS s FROM (
            SELECT *, cast(pos%101 AS double)/100e0 AS f FROM v_alleles) a) b"""
)
def beta_se_from_z(t: Tables) -> DataFrame:
    z, n = F.col("z"), F.col("n_total")
    eaf = (F.col("pos") % 101).cast("double") / F.lit(100.0)
    return t.view("v_alleles").select(
        "gene_id",
        "chrom",
        "pos",
        F.round(stats.beta_from_z(z, eaf, n), 9).alias("beta"),
        F.round(stats.se_from_z_eaf(z, eaf, n), 9).alias("se"),
    )


@query(
    """SELECT gene_id, chrom, pos, round(log10(CASE WHEN p = 0 THEN 2.2250738585072014e-308
        ELSE p END), 6) AS log10_p
    FROM (SELECT *, power(10e0, log10_pval * 13e0) AS p FROM v_alleles) a"""
)
def p_from_log10(t: Tables) -> DataFrame:
    p = stats.p_from_log10(F.col("log10_pval") * F.lit(13.0))
    return t.view("v_alleles").select(
        "gene_id", "chrom", "pos", F.round(F.log10(p), 6).alias("log10_p")
    )


@query(f"{_SELECT}, CASE WHEN pos%10=0 THEN 2.2250738585072014e-308 ELSE pval END AS pval FROM (SELECT *, pval AS p0 FROM v_gwas) t")
def p_floor(t: Tables) -> DataFrame:
    zeroed = F.when(F.col("pos") % 10 == 0, F.lit(0.0)).otherwise(F.col("pval"))
    return t.view("v_gwas").withColumn("pval", stats.floor_p(zeroed)).select(*_KEYS, "pval")


@query(
    """SELECT phenotype_id, chrom, pos, least(ac, an-ac) AS mac,
        cast(floor(an/2e0) AS int) AS n_total FROM v_qtl WHERE least(ac, an-ac) >= 5"""
)
def mac_from_counts(t: Tables) -> DataFrame:
    counted = t.view("v_qtl").withColumns(
        {
            "mac": stats.minor_count_from_alleles(F.col("ac"), F.col("an")),
            "n_total": stats.samples_from_alleles(F.col("an")),
        }
    )
    return qc.min_count(counted, "mac", 5).select("phenotype_id", "chrom", "pos", "mac", "n_total")


@query(
    """SELECT phenotype_id, chrom, pos,
        cast(trunc(ma_count / nullif(maf, 0) / 2e0) AS int) AS n_total FROM v_qtl"""
)
def n_from_maf(t: Tables) -> DataFrame:
    n_total = stats.samples_from_maf(F.col("ma_count"), F.col("maf"))
    return t.view("v_qtl").select("phenotype_id", "chrom", "pos", n_total.alias("n_total"))


@query(
    """SELECT variant, phenotype, round(beta / nullif(mu*(1e0-mu), 0), 9) AS log_or,
        round(se / nullif(mu*(1e0-mu), 0), 9) AS log_or_se FROM (
        SELECT l.*, n_cases / nullif(cast(n_cases + n_controls AS double), 0) AS mu
        FROM v_linear l JOIN v_phenotype USING (phenotype)) t"""
)
def linear_to_logor(t: Tables) -> DataFrame:
    rows = t.view("v_linear").join(t.view("v_phenotype"), "phenotype")
    scale = stats.liability_scale(F.col("n_cases"), F.col("n_controls"))
    return rows.select(
        "variant",
        "phenotype",
        F.round(F.try_divide("beta", scale), 9).alias("log_or"),
        F.round(F.try_divide("se", scale), 9).alias("log_or_se"),
    )


@query(
    """SELECT snpid, phenotype, round(exp(beta), 8) AS "OR",
        round(exp(beta - 1.96e0*sebeta), 8) AS "OR_lowerCI",
        round(exp(beta + 1.96e0*sebeta), 8) AS "OR_upperCI" FROM v_mixed"""
)
def or_ci(t: Tables) -> DataFrame:
    odds = stats.odds_ratio(F.col("beta"), F.col("sebeta"))
    return t.view("v_mixed").select(
        "snpid", "phenotype", *[F.round(value, 8).alias(name) for name, value in odds.items()]
    )


@query(
    """SELECT variant, phenotype, "AC" / nullif(2e0 * n_complete_samples, 0) AS "AF" FROM v_linear"""
)
def af_from_ac(t: Tables) -> DataFrame:
    af = stats.frequency_from_count(F.col("AC"), F.col("n_complete_samples"))
    return t.view("v_linear").select("variant", "phenotype", af.alias("AF"))


@query(
    """SELECT replace(split_part(variant_id, '_', 1), 'chr', '') AS chrom,
        try_cast(split_part(variant_id, '_', 2) AS int) AS pos,
        split_part(variant_id, '_', 3) AS ref, split_part(variant_id, '_', 4) AS alt
    FROM v_junction"""
)
def variant_id_parse(t: Tables) -> DataFrame:
    parts = ids.variant_parts(F.col("variant_id"), "_")
    return t.view("v_junction").select(*[part.alias(name) for name, part in parts.items()])


@query(
    """SELECT gene_id, versioned, split_part(versioned, '.', 1) AS first_part,
        regexp_replace(versioned, '\\.[^.]*$', '') AS without_last FROM (
        SELECT gene_id, concat(gene_id, '.', cast(pos%7 AS varchar),
            CASE WHEN pos%2=0 THEN '.x' ELSE '' END) AS versioned FROM v_qtl) t"""
)
def gene_version_strip(t: Tables) -> DataFrame:
    versioned = t.view("v_qtl").selectExpr(
        "gene_id",
        "concat(gene_id, '.', cast(pos%7 as string), case when pos%2=0 then '.x' else '' end)"
        " AS versioned",
    )
    return versioned.select(
        "gene_id",
        "versioned",
        ids.before_first_dot(F.col("versioned")).alias("first_part"),
        ids.drop_last_suffix(F.col("versioned")).alias("without_last"),
    )


@query(
    """SELECT phenotype_id, replace(phenotype_id, ':', '^') AS folder_name,
        replace(phenotype_id, '.', '_') AS plain_name FROM v_junction"""
)
def id_sanitise(t: Tables) -> DataFrame:
    column = F.col("phenotype_id")
    return t.view("v_junction").select(
        "phenotype_id",
        ids.folder_safe(column).alias("folder_name"),
        ids.dots_to_underscores(column).alias("plain_name"),
    )


@query(
    """SELECT replace(regexp_replace(phenotype_id, '\\.[^.]*$', ''), ':', '^') AS phenotype_id,
        split_part(phenotype_id, ':', 4) AS splicing_cluster,
        split_part(split_part(phenotype_id, ':', 5), '.', 1) AS gene_id FROM v_junction"""
)
def junction_parse(t: Tables) -> DataFrame:
    parts = ids.junction_parts(F.col("phenotype_id"))
    return t.view("v_junction").select(*[part.alias(name) for name, part in parts.items()])


_P_TEXT = (
    "concat(cast(1 + pos%9 as string), '.', lpad(cast(pos%1000 as string), 3, '0'), "
    "case when pos%2 = 0 then 'e-' else 'E-' end, cast(1 + (pos*7)%6000 as string))"
)


def _tail_steps(steps: int = tails.STEPS) -> str:
    """Newton steps on the logarithm of the upper tail, one common table each."""
    series = "10395e0"
    for factor in ("-945e0", "105e0", "-15e0", "3e0", "-1e0", "1e0"):
        series = f"({series} / (z{{i}}*z{{i}}) + {factor})"
    text = f"t0 AS (SELECT *, sqrt(-2e0*(q + {tails.HALF_LN_2PI!r}e0 + ln(-2e0*q)/2e0)) AS z0 FROM far)"
    for i in range(steps):
        s = series.format(i=i)
        ln_tail = f"(-z{i}*z{i}/2e0 - {tails.HALF_LN_2PI!r}e0 - ln(z{i}) + ln({s}))"
        text += f", t{i + 1} AS (SELECT *, z{i} + ({ln_tail} - q) * {s} / z{i} AS z{i + 1} FROM t{i})"
    return text


@query(
    f"""WITH written AS (SELECT study_id, chrom, pos, ref, alt, beta, {_P_TEXT} AS p_text FROM v_gwas),
    logs AS (SELECT *, ln(cast(regexp_extract(p_text, '^([0-9.]+)[eE]', 1) AS double))
        + cast(regexp_extract(p_text, '[eE](.*)$', 1) AS double) * {tails.LN10!r}e0 AS ln_p FROM written),
    near AS (SELECT *, exp(ln_p) / 2e0 AS h, sqrt(-ln(exp(ln_p) / 2e0)) AS r FROM logs
        WHERE ln_p >= {tails.FAR!r}e0 AND ln_p <= 0e0),
    far AS (SELECT *, ln_p - {tails.LN2!r}e0 AS q FROM logs WHERE ln_p < {tails.FAR!r}e0),
    {_tail_steps()},
    scored AS (SELECT study_id, chrom, pos, ref, alt, beta, ln_p, {_quantile_sql()} AS z FROM near
        UNION ALL SELECT study_id, chrom, pos, ref, alt, beta, ln_p, z{tails.STEPS} FROM t{tails.STEPS}
        UNION ALL SELECT study_id, chrom, pos, ref, alt, beta, ln_p, NULL FROM logs WHERE ln_p > 0e0)
    {_SELECT}, round(ln_p, 6) AS ln_p, round(z, 7) AS z, round(abs(beta) / nullif(z, 0), 7) AS se FROM scored"""
)
def se_from_log_p(t: Tables) -> DataFrame:
    """Standard errors from p-values given as text, down to 1e-6000."""
    rows = t.view("v_gwas").select(*_KEYS, "beta", tails.ln_of_text(F.expr(_P_TEXT)).alias("ln_p"))
    scored = rows.withColumn("z", tails.z_from_ln_p(F.col("ln_p")))
    return scored.select(
        *_KEYS,
        F.round("ln_p", 6).alias("ln_p"),
        F.round("z", 7).alias("z"),
        F.round(stats.se_from_z(F.col("beta"), F.col("z")), 7).alias("se"),
    )
