import random

from pyspark.sql import functions as F

from helixspan.operators import genes, ordered, reports
from helixspan.plans import genes as plans

SCHEMA = "study_id string, bio_feature string, gene_id string, num_tests bigint, min_pval double"


def by_hand(rows):
    """Textbook procedure per data set."""
    result = {}
    groups = {}
    for study, tissue, gene, n, p in rows:
        bonf = 1.0 if p is None or p != p else min(1.0, p * n)
        groups.setdefault((study, tissue), []).append((bonf, gene))
    for key, members in groups.items():
        members.sort()
        q = 1.0
        for rank in range(len(members), 0, -1):
            bonf, gene = members[rank - 1]
            q = min(q, bonf * len(members) / rank, 1.0)
            result[(*key, gene)] = (bonf, q)
    return result


def test_fdr_with_a_dominant_data_set_and_ties(table):
    rng = random.Random(3)
    rows = []
    for n in range(4000):
        study = "hot" if rng.random() < 0.7 else rng.choice(["a", "b"])
        kind = rng.random()
        p = 1e-4 if kind < 0.2 else None if kind < 0.22 else float("nan") if kind < 0.24 else rng.random() ** 4
        rows.append((study, rng.choice(["t", None]), f"g{n}", rng.choice([1, 10, 100]), p))
    found = {
        (r.study_id, r.bio_feature, r.gene_id): (r.p_bonf, r.qval)
        for r in genes.bh_fdr(table(rows, SCHEMA)).collect()
    }
    expected = by_hand(rows)
    assert found.keys() == expected.keys()
    for key, (bonf, q) in expected.items():
        assert abs(found[key][0] - bonf) < 1e-12 and abs(found[key][1] - q) < 1e-12
        assert found[key][1] >= found[key][0] - 1e-12


def test_fdr_of_one_gene_and_of_none(table):
    one = genes.bh_fdr(table([("s", "t", "g", 2, 0.01)], SCHEMA)).first()
    assert (one.p_bonf, one.qval) == (0.02, 0.02)
    assert genes.bh_fdr(table([], SCHEMA)).count() == 0


def test_min_p_over_differing_tables(table):
    first = table([("s", "t", "g", 0.2, 1), ("s", "t", "g", None, 1)],
                  "study_id string, bio_feature string, gene_id string, pval double, extra int")
    second = table([(0.1, "g", "t", "s")], "pval double, gene_id string, bio_feature string, study_id string")
    assert tuple(plans.min_p_table([first, second]).first()) == ("s", "t", "g", 2, 0.1)


def test_threshold_tables(table):
    rows = [("GTEx-eQTL", "Liver", "g1", 10, 1e-9, 1e-8, 1e-8), ("GTEx-eQTL", "Liver", "g2", 10, 0.01, 0.1, 0.2),
            ("GTEx-sQTL", "Liver", "g1", 10, 1e-5, 1e-4, 1e-3), ("Other", "X", "g", 1, 1e-7, 1e-7, 1e-7)]
    fdr = table(rows, SCHEMA + ", p_bonf double, qval double")
    tables = plans.threshold_tables(fdr)
    counts = {(r.dataset, r.threshold): (r["count"], r.gws_count) for r in tables["counts"].collect()}
    assert counts[("GTEx-eQTL-Liver", "p < 5e-8")] == (1, 1)
    assert counts[("GTEx-sQTL-Liver", "p < 1e-5")] == (0, 0)
    assert counts[("GTEx-sQTL-Liver", "FDR 5%")] == (1, 0)
    totals = {r.threshold: (r.eQTL, r.sQTL) for r in tables["totals_by_type"].collect()}
    assert totals["FDR 5%"] == (1, 1) and "p < 1e-4" not in totals
    names = genes.compare_types(tables["counts"]).select("dataset").distinct().collect()
    assert [r.dataset for r in names] == ["LIVER"]


def test_running_sum_over_sections(table):
    rng = random.Random(8)
    rows = [(f"k{n:05d}", 1 if rng.random() < 0.5 else rng.randrange(50)) for n in range(3000)]
    out = ordered.running_sum(
        table(rows, "k string, v bigint"), [F.desc("v"), "k"], "v", "total", "place"
    ).collect()
    total, expected = 0, {}
    for place, (k, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        total += v
        expected[k] = (total, place)
    assert {r.k: (r.total, r.place) for r in out} == expected


def test_sample_sizes(table):
    df = table([("10;-;5",), ("-;-",), ("7",), ("15;-",)], "DatasetsNrSamples string")
    assert [tuple(r) for r in reports.sample_size_table(df).collect()] == [(15, 2), (7, 1), (0, 1)]
