import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from helixspan.functions import stats
from helixspan.operators import qc


def test_quantile_over_the_whole_range(table):
    ps = [1e-300, 1e-100, 1e-20, 5e-8, 1e-4, 0.01, 0.05, 0.14, 0.16, 0.3, 0.5, 0.9, 0.999]
    df = table([(p,) for p in ps], "p double").select("p", stats.z_from_p(F.col("p")).alias("z"))
    for p, z in df.collect():
        assert z == pytest.approx(-NormalDist().inv_cdf(p / 2), rel=1e-12)


def test_quantile_published_values(table):
    df = table([(0.05,), (0.01,), (0.001,)], "p double")
    zs = [round(r[0], 9) for r in df.select(stats.z_from_p(F.col("p"))).collect()]
    assert zs == [1.959963985, 2.575829304, 3.290526731]


def test_imputed_se_inverts_to_p(table):
    rows = [(0.3, None, 0.004), (-0.2, None, 1e-12), (0.1, 0.5, 0.9), (0.1, None, 1.0),
            (0.1, None, None), (None, None, 0.5), (0.1, None, 0.0)]
    out = stats.impute_se(table(rows, "beta double, se double, pval double")).collect()
    for beta, se, p in out[:2]:
        assert 2 * NormalDist().cdf(-abs(beta) / se) == pytest.approx(p, rel=1e-9)
    assert out[2].se == 0.5
    assert [r.se for r in out[3:6]] == [None, None, None]
    assert out[6].se == pytest.approx(0.1 / 37.5, rel=0.01)


def test_filter_agrees_with_imputation(table):
    rows = [(b, s, p) for b in (0.3, -1.0) for s in (None, 0.2, float("nan"))
            for p in (0.0, 1e-320, 0.5, 1.0)]
    df = table(rows, "beta double, se double, pval double")
    early = stats.impute_se(df.where(stats.has_or_gets_se()))
    late = qc.complete(stats.impute_se(df), ["se"])
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.collect()))


def test_odds_need_both_columns(table):
    rows = [(0.1, 0.2, 2.0, 1.5), (0.1, 0.2, 2.0, None), (0.1, 0.2, None, 1.5)]
    out = stats.odds_to_effect(
        table(rows, "beta double, se double, oddsr double, oddsr_lower double")
    ).collect()
    assert out[0].beta == pytest.approx(math.log(2))
    assert out[0].se == pytest.approx((math.log(2) - math.log(1.5)) / 1.959963984540054)
    assert [tuple(r) for r in out[1:]] == [(0.1, 0.2), (0.1, 0.2)]


def test_zero_denominators_give_null(table):
    row = table([(1.0, 0.0, 0)], "x double, zero double, n int")
    values = row.select(
        stats.se_from_z(F.col("x"), F.col("zero")),
        stats.beta_from_z(F.col("x"), F.col("zero"), F.col("n")),
        stats.samples_from_maf(F.col("n"), F.col("zero")),
        stats.liability_scale(F.col("n"), F.col("n")),
        stats.frequency_from_count(F.col("n"), F.col("n")),
    ).first()
    assert tuple(values) == (None,) * 5


def test_floor_and_log10(table):
    df = table([(0.0, -400.0), (0.5, -2.0), (None, None)], "p double, l double")
    out = df.select(stats.floor_p(F.col("p")), stats.p_from_log10(F.col("l"))).collect()
    assert tuple(out[0]) == (2.2250738585072014e-308, 2.2250738585072014e-308)
    assert out[1][0] == 0.5 and out[1][1] == pytest.approx(0.01)
    assert tuple(out[2]) == (None, None)


def test_bonferroni(table):
    df = table([(0.01, 5), (0.5, 5), (None, 5)], "p double, n int")
    assert [r[0] for r in df.select(stats.bonferroni(F.col("p"), F.col("n"))).collect()] == [
        0.05, 1.0, 1.0,
    ]


def test_nan_does_not_pass(table):
    nan = float("nan")
    df = table([(nan, 1.0), (0.5, nan), (0.5, 1.0)], "se double, eaf double")
    assert qc.complete(df, ["se", "eaf"]).count() == 1


def test_count_filter_keeps_quantitative_studies(table):
    df = table(
        [(20.0, None), (20.0, 5.0), (20.0, 15.0), (5.0, None)], "mac double, mac_cases double"
    )
    assert [tuple(r) for r in qc.gwas_count_filter(df, 10).collect()] == [
        (20.0, None), (20.0, 15.0),
    ]


def test_rows_gate_and_reports(table):
    df = table([("a", n, n % 2 == 0) for n in range(9)] + [("b", 1, True)],
               "study_id string, x int, ok boolean")
    assert qc.min_rows_gate(df, 5).count() == 9
    report = [tuple(r) for r in qc.qc_report(df, [("ok", F.col("ok")), ("big", F.col("x") > 4)]).collect()]
    assert report == [(0, "input", 10, 0, 0.0), (1, "ok", 6, 4, 40.0), (2, "big", 2, 4, 40.0)]
    nulls = qc.null_profile(table([(None, 1), (None, None)], "a int, b int")).collect()
    assert {r.column_name: r.nulls for r in nulls} == {"a": 2, "b": 1}


def test_violations(table):
    rows = [("a", 1, 1, None), ("b", None, 1, 2), ("c", None, None, None), ("c", None, None, 3)]
    df = table(rows, "study_id string, n_cases int, n_controls int, n_quant int")
    report = {r.rule: r.n_rows for r in qc.violations(df, qc.manifest_rules(), "study_id").collect()}
    assert report == {
        "n_cases and n_controls come together": 1,
        "either n_cases or n_quant": 1,
        "study_id is unique": 2,
    }
