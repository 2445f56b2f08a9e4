"""Column functions for effect sizes, standard errors, p-values and allele counts.

Everything here is a plain Column expression. Divisions use ``try_divide`` and
casts ``try_cast`` because Spark's ANSI mode would otherwise abort the job on a
single bad row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Smallest normal double, 97.5 % normal quantile, CI multiplier.
P_FLOOR = 2.2250738585072014e-308
Z_975 = 1.95996398454005423552
CI_Z = 1.96

# Coefficients of the published AS241 (PPND16) approximation to the
# normal quantile, lowest order first.
_CENTRE_NUM = [
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
    1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
    3.3430575583588128105e4, 2.5090809287301226727e3,
]
_CENTRE_DEN = [
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
    5.2264952788528545610e3,
]
_MIDDLE_NUM = [
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
    3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
    2.27238449892691845833e-2, 7.74545014278341407640e-4,
]
_MIDDLE_DEN = [
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
    1.05075007164441684324e-9,
]
_FAR_NUM = [
    6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
    2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
    2.71155556874348757815e-5, 2.01033439929228813265e-7,
]
_FAR_DEN = [
    1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
    2.04426310338993978564e-15,
]


def _ratio(num: list[float], den: list[float], x: Column) -> Column:
    def horner(coefficients: list[float]) -> Column:
        highest, *rest = reversed(coefficients)
        return reduce(lambda acc, c: acc * x + F.lit(c), rest, F.lit(highest))

    return horner(num) / horner(den)


def _lower_quantile(q: Column, radius: Column) -> Column:
    """|normal quantile| of ``q`` in (0, 0.5], with ``radius`` = sqrt(-ln q)."""
    centred = F.lit(0.5) - q
    return (
        F.when(q <= 0, F.lit(None).cast("double"))
        .when(
            centred <= 0.425,
            centred * _ratio(_CENTRE_NUM, _CENTRE_DEN, F.lit(0.180625) - centred * centred),
        )
        .when(radius <= 5, _ratio(_MIDDLE_NUM, _MIDDLE_DEN, radius - F.lit(1.6)))
        .otherwise(_ratio(_FAR_NUM, _FAR_DEN, radius - F.lit(5.0)))
    )


def z_from_p(p: Column) -> Column:
    """|z| of a two-sided p-value; null for null or non-positive p, 0 for p = 1."""
    half = p / F.lit(2.0)
    return _lower_quantile(half, F.sqrt(-F.log(half)))


def floor_p(p: Column) -> Column:
    """Exact zeros become the smallest normal double."""
    return F.when(p == 0, F.lit(P_FLOOR)).otherwise(p)


def p_from_log10(log10_p: Column) -> Column:
    return floor_p(F.pow(F.lit(10.0), log10_p))


def se_from_z(beta: Column, z: Column) -> Column:
    return F.try_divide(F.abs(beta), F.abs(z))


def _standardised_scale(z: Column, eaf: Column, n: Column) -> Column:
    return F.sqrt(F.lit(2.0) * eaf * (F.lit(1.0) - eaf) * (n + z * z))


def beta_from_z(z: Column, eaf: Column, n: Column) -> Column:
    return F.try_divide(z, _standardised_scale(z, eaf, n))


def se_from_z_eaf(z: Column, eaf: Column, n: Column) -> Column:
    return F.try_divide(F.lit(1.0), _standardised_scale(z, eaf, n))


def minor_frequency(eaf: Column) -> Column:
    return F.when(eaf <= 0.5, eaf).otherwise(F.lit(1.0) - eaf)


def minor_count(n: Column, eaf: Column) -> Column:
    return n * F.lit(2) * minor_frequency(eaf)


def minor_count_from_alleles(ac: Column, an: Column) -> Column:
    return F.least(ac, an - ac)


def samples_from_alleles(an: Column) -> Column:
    return F.floor(an / F.lit(2)).try_cast("int")


def samples_from_maf(ma_count: Column, maf: Column) -> Column:
    return (F.try_divide(ma_count, maf) / F.lit(2)).try_cast("int")


def eaf_from_maf(maf: Column, panel_af: Column) -> Column:
    """The alternative allele is taken as minor when the panel says so."""
    return F.when(panel_af <= 0.5, maf).otherwise(F.lit(1.0) - maf)


def flip_sign(effect: Column, effect_allele: Column, ref: Column) -> Column:
    return F.when(effect_allele == ref, -effect).otherwise(effect)


def liability_scale(n_cases: Column, n_controls: Column) -> Column:
    """mu * (1 - mu) with mu the case fraction."""
    mu = F.try_divide(n_cases, n_cases + n_controls)
    return mu * (F.lit(1.0) - mu)


def odds_ratio(log_or: Column, se: Column) -> dict[str, Column]:
    """Odds ratio with its 95 % confidence bounds."""
    return {
        "OR": F.exp(log_or),
        "OR_lowerCI": F.exp(log_or - F.lit(CI_Z) * se),
        "OR_upperCI": F.exp(log_or + F.lit(CI_Z) * se),
    }


def frequency_from_count(ac: Column, n_samples: Column) -> Column:
    return F.try_divide(ac, F.lit(2) * n_samples)


def bonferroni(p: Column, n_tests: Column) -> Column:
    """min(1, p * n); missing p counts as 1."""
    return F.least(F.coalesce(p * n_tests, F.lit(1.0)), F.lit(1.0))


def odds_to_effect(df: DataFrame) -> DataFrame:
    """Replace beta and se by log-odds values wherever an odds ratio with a lower bound is given."""
    given = F.col("oddsr").isNotNull() & F.col("oddsr_lower").isNotNull()
    log_or = F.log("oddsr")
    spread = (log_or - F.log("oddsr_lower")) / F.lit(Z_975)
    return df.withColumns(
        {
            "beta": F.when(given, log_or).otherwise(F.col("beta")),
            "se": F.when(given, spread).otherwise(F.col("se")),
        }
    ).drop("oddsr", "oddsr_lower")


def has_or_gets_se() -> Column:
    """Rows whose standard error is given or can be imputed (0 <= p < 1).

    Filtering on this instead of on the imputed value keeps the quantile
    polynomials out of the pushed-down filters and out of row counts.
    """
    given = F.col("se").isNotNull() & ~F.isnan("se")
    return given | (F.col("se").isNull() & (F.col("pval") >= 0) & (F.col("pval") < 1))


def impute_se(df: DataFrame) -> DataFrame:
    """Fill a missing standard error from effect size and p-value.

    The radius is a projection of its own, so its 14 uses in the polynomials share one
    logarithm and square root; both are null for rows that need no imputation.
    """
    usable = F.col("se").isNull() & (F.col("pval") >= 0) & (F.col("pval") < 1)
    half = F.when(usable, floor_p(F.col("pval")) / F.lit(2.0))
    staged = df.withColumn("_half_p", half).withColumn("_radius", F.sqrt(-F.log("_half_p")))
    z = _lower_quantile(F.col("_half_p"), F.col("_radius"))
    return staged.withColumn("se", F.coalesce("se", se_from_z(F.col("beta"), z))).drop(
        "_half_p", "_radius"
    )
