"""P-values beyond doubles: parsing, logarithms, quantiles, and the ingests that use them."""

import math
from decimal import Decimal, getcontext
from statistics import NormalDist

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helixspan.functions import stats, tails
from helixspan.plans import gwas, molecular
from helixspan.sources import readers

getcontext().prec = 40
TEXTS = [
    "1e-320", "1e-400", "1E-5000", "4.94e-324", "0.05", ".5", "5.", "12345.678e-400", "  3e-7 ", "+2e-3",
    "0." + "0" * 500 + "123", "0.000e-10", "0", "", "NA", "-1e-5", "1e", "1e5.0", "abc1e-5", "100000000000000000000000000000e-40",
]


def plain_ln(text):
    try:
        value = Decimal(text.strip())
    except ArithmeticError:
        return None
    return float(value.ln()) if value > 0 else None


def test_logarithms_of_text(table):
    got = {r["t"]: r["l"] for r in table([(t,) for t in TEXTS], "t string").select("t", tails.ln_of_text(F.col("t")).alias("l")).collect()}
    for text in TEXTS:
        want = plain_ln(text)
        assert got[text] == (None if want is None else pytest.approx(want, rel=1e-14, abs=1e-12)), text


def exact_z(ln_p):
    """By bisection on the continued fraction of the tail, in decimals."""

    def ln_tail(z):
        z = Decimal(z)
        ratio = Decimal(0)
        for k in range(400, 0, -1):
            ratio = k / (z + ratio)
        mills = 1 / (z + ratio)
        return -z * z / 2 - (2 * Decimal("3.14159265358979323846264338327950288")).ln() / 2 + mills.ln()

    low, high = Decimal(30), Decimal(1000)
    target = Decimal(ln_p) - Decimal(2).ln()
    for _ in range(90):
        middle = (low + high) / 2
        low, high = (middle, high) if ln_tail(middle) > target else (low, middle)
    return float(low)


@pytest.mark.parametrize("exponent", [-300, -310, -320, -400, -5000, -100000])
def test_far_quantiles(table, exponent):
    ln_p = exponent * math.log(10)
    z = table([(ln_p,)], "l double").select(tails.z_from_ln_p(F.col("l"))).first()[0]
    assert z == pytest.approx(exact_z(ln_p), rel=1e-13)


def test_both_branches_meet_and_near_ones_are_the_usual_quantile(table):
    lns = [tails.FAR - 1e-9, tails.FAR, tails.FAR + 1e-9, math.log(1e-8), math.log(0.3), 0.0, 0.1]
    zs = [r[0] for r in table([(x,) for x in lns], "l double").select(tails.z_from_ln_p(F.col("l"))).collect()]
    assert zs[0] == pytest.approx(zs[1], rel=1e-11) and zs[1] == pytest.approx(zs[2], rel=1e-11)
    assert zs[3] == pytest.approx(-NormalDist().inv_cdf(5e-9), rel=1e-10)
    assert zs[4] == pytest.approx(-NormalDist().inv_cdf(0.15), rel=1e-10)
    assert zs[5] == pytest.approx(0, abs=1e-12) and zs[6] is None


@settings(max_examples=30, deadline=None)
@given(st.floats(-1e6, -700))
def test_the_start_is_close_enough_for_the_steps(ln_q):
    """The same steps in plain Python end where further steps change nothing."""

    def series(z):
        total, u = 10395.0, 1 / (z * z)
        for f in (-945.0, 105.0, -15.0, 3.0, -1.0, 1.0):
            total = total * u + f
        return total

    z = math.sqrt(-2 * (ln_q + tails.HALF_LN_2PI + math.log(-2 * ln_q) / 2))
    seen = []
    for _ in range(tails.STEPS + 3):
        z += (-z * z / 2 - tails.HALF_LN_2PI - math.log(z) + math.log(series(z)) - ln_q) * series(z) / z
        seen.append(z)
    assert seen[tails.STEPS - 1] == pytest.approx(seen[-1], rel=1e-13)


def test_errors_differ_where_doubles_are_zero(table):
    rows = [(1.0, None, 0.0, -400 * tails.LN10), (1.0, None, 0.0, -5000 * tails.LN10), (1.0, None, 0.0, None),
            (1.0, 0.5, 0.0, -400 * tails.LN10), (1.0, None, 0.01, math.log(0.01))]
    df = table(rows, "beta double, se double, pval double, ln_pval double")
    ses = [r["se"] for r in tails.impute_se(df).collect()]
    assert ses[0] == pytest.approx(1 / exact_z(-400 * tails.LN10)) and ses[1] == pytest.approx(1 / exact_z(-5000 * tails.LN10))
    usual = [r["se"] for r in stats.impute_se(df.drop("ln_pval")).collect()]
    assert ses[2:] == usual[2:] and usual[0] == usual[1]


def test_a_delivered_text_reaches_the_standard_error(spark, table, tmp_path):
    head = "hm_chrom\thm_pos\thm_other_allele\thm_effect_allele\tp_value\thm_beta\tstandard_error\thm_effect_allele_frequency\n"
    lines = "".join(f"1\t{10 + i}\tA\tC\t{p}\t2.0\tNA\t0.3\n" for i, p in enumerate(["1e-320", "1e-400", "1e-5000", "0", "1e-9"]))
    (tmp_path / "in.tsv").write_text(head + lines)
    manifest = table([("S", str(tmp_path / "in.tsv"), 1000, None)], "study_id string, in_tsv string, n_total int, n_cases int")
    panel = table([("1", 10, "1", 10, "A", "C", (0.2,))], "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, af struct<gnomad_nfe:double>")
    gwas.ingest(spark, manifest, panel, str(tmp_path / "out"), min_rows=1)
    rows = readers.read_parquet(spark, str(tmp_path / "out")).orderBy("pos").collect()
    assert [r["se"] for r in rows[:3]] == pytest.approx([2 / exact_z(e * math.log(10)) for e in (-320, -400, -5000)], rel=1e-12)
    assert rows[3]["se"] == pytest.approx(2 / 37.5, rel=0.01) and rows[3]["pval"] == stats.P_FLOOR
    assert rows[4]["se"] == pytest.approx(2 / -NormalDist().inv_cdf(5e-10), rel=1e-9)
    assert "ln_pval" not in rows[0].asDict()


def test_protein_rows_may_get_errors_from_log_p(table):
    rows = table(
        [("P1", "1", 100, "a", "c", 3.0, None, -400.0), ("P1", "1", 101, "a", "c", 3.0, 0.1, -2.0)],
        "phenotype_id string, chrom string, pos int, effect_allele string, other_allele string, beta double, se double, log10_pval double",
    )
    genes = table([("P1", "G", "1", 120)], "phenotype_id string, gene_id string, chrom string, tss int")
    panel = table(
        [("1", 100, "1", 200, "C", "A", (0.3,)), ("1", 101, "1", 201, "C", "A", (0.3,))],
        "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, af struct<gnomad_nfe:double>",
    )
    fixed = dict(study_id="S", bio_feature="T", n_total=1000)
    found = molecular.aligned_pqtl(rows, genes, panel, errors_from_p=True, **fixed).orderBy("pos").collect()
    assert [r["se"] for r in found] == pytest.approx([3 / exact_z(-400 * math.log(10)), 0.1])
    assert molecular.aligned_pqtl(rows, genes, panel, **fixed).count() == 1
