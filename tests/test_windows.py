import random

import pytest
from pyspark.sql import functions as F

from helixspan.operators import windows
from helixspan.plans import extract

SCHEMA = "study_id string, phenotype_id string, bio_feature string, chrom string, pos int, pval double"

WIDTH = 12


def made_up_rows():
    """(study, chromosome, position, p): three groups with hits at an edge, close by and alone."""
    hits = {("x", "3"): {40, 55, 90}, ("x", "4"): {2}, ("y", "3"): {100, 113}}
    for (study, chrom), found in hits.items():
        for pos in range(1, 121, 2 if chrom == "3" else 3):
            yield study, chrom, pos, 0.3 + pos / 200
        for pos in found:
            yield study, chrom, pos, 1e-5


def kept_by_hand(rows):
    """Rows within WIDTH of a hit of their own group."""
    return sorted(
        (s, c, p)
        for s, c, p, _ in rows
        if any(s2 == s and c2 == c and abs(p2 - p) <= WIDTH and v <= 0.05 for s2, c2, p2, v in rows)
    )


@pytest.fixture(scope="module")
def labelled(table):
    rows = [(study, None, None, chrom, pos, p) for study, chrom, pos, p in made_up_rows()]
    return table(rows, SCHEMA)


EXPECTED = kept_by_hand(list(made_up_rows()))


def keys(df):
    return sorted((r.study_id, r.chrom, r.pos) for r in df.collect())


def test_labelled_intervals(labelled):
    hits = labelled.where("pval <= 0.05")
    found = sorted(
        (r.study_id, r.chrom, r.start, r.end) for r in windows.merge_windows(hits, WIDTH).collect()
    )
    assert found == [("x", "3", 28, 67), ("x", "3", 78, 102), ("x", "4", 0, 14), ("y", "3", 88, 125)]


def test_labelled_rows_all_forms(labelled):
    hit = F.col("pval") <= 0.05
    by_join, _ = windows.extract_windows(labelled, WIDTH, "gwas", 0.05)
    assert keys(by_join) == EXPECTED
    assert keys(windows.keep_near_by_frame(labelled, hit, WIDTH)) == EXPECTED
    assert keys(windows.keep_near(labelled, labelled.where(hit), WIDTH)) == EXPECTED


def merged_by_hand(positions, width):
    merged = []
    for pos in sorted(set(positions)):
        if merged and pos - width <= merged[-1][1]:
            merged[-1][1] = pos + width
        else:
            merged.append([pos - width, pos + width])
    return [(max(a, 0), b) for a, b in merged]


@pytest.mark.parametrize("width", [0, 1, 7, 40, 500])
def test_against_brute_force(table, width):
    """One study holds most rows, positions repeat, keys may be null."""
    rng = random.Random(width)
    rows = []
    for _ in range(3000):
        study = "hot" if rng.random() < 0.6 else rng.choice(["x", "y"])
        pos = 77 if rng.random() < 0.3 else rng.randrange(3000)
        rows.append(
            (study, rng.choice([None, "p1", "p2"]), None, rng.choice("12"), pos,
             1e-9 if rng.random() < 0.01 else rng.random())
        )
    df = table(rows, SCHEMA)
    hits = {}
    for s, p, b, c, pos, pval in rows:
        if pval <= 1e-6:
            hits.setdefault((s, p, b, c), []).append(pos)
    kept = sorted(
        (str(r) for r in rows if any(abs(r[4] - h) <= width for h in hits.get(r[:4], [])))
    )

    def as_text(frame):
        return sorted(str(tuple(r)) for r in frame.select(df.columns).collect())

    by_join, intervals = windows.extract_windows(df, width, "gwas", 1e-6)
    found = {}
    for r in intervals.collect():
        found.setdefault(tuple(r)[:4], []).append((r.start, r.end))
    assert {k: sorted(v) for k, v in found.items()} == {
        k: merged_by_hand(v, width) for k, v in hits.items()
    }
    assert as_text(by_join) == kept
    hit = F.col("pval") <= 1e-6
    assert as_text(windows.keep_near_by_frame(df, hit, width)) == kept
    assert as_text(windows.keep_near(df, df.where(hit), width, distinct=False)) == kept
    assert as_text(windows.keep_near(df, df.where(hit), width)) == sorted(set(kept))


def test_touching_windows_merge(table):
    rows = [("s", None, None, "1", p, 0.0) for p in (100, 120, 141)]
    found = windows.merge_windows(table(rows, SCHEMA), 10).collect()
    assert sorted((r.start, r.end) for r in found) == [(90, 130), (131, 151)]


def test_molecular_threshold_needs_a_test_count(table):
    rows = [("s", "g", "t", "1", 5, 0.004, 10), ("s", "g", "t", "1", 6, 0.006, 10),
            ("s", "g", "t", "1", 7, 0.004, 0)]
    df = table(rows, SCHEMA + ", num_tests int")
    assert [r.pos for r in df.where(windows.significant("molecular_trait")).collect()] == [5]
    with pytest.raises(ValueError):
        windows.significant("other")


def test_partition_plan(table):
    iv = "study_id string, phenotype_id string, bio_feature string, chrom string, start int, end int"
    rows = [("s", None, f, "1", n, n) for n in range(45) for f in ("a", None)]
    plan = windows.partition_plan(table(rows, iv)).first()
    assert tuple(plan) == (90, 2, 5)
    assert tuple(windows.partition_plan(table([], iv)).first()) == (0, 0, 1)


def test_job_without_hits_still_writes(spark, labelled, tmp_path):
    out = str(tmp_path / "none")
    extract.significant_windows(labelled, out, data_type="gwas", width=10, pval=1e-12)
    assert spark.read.parquet(out).count() == 0


def test_job_molecular_layout(spark, table, tmp_path):
    rows = [("s", "g", "t", "1", n, 1e-9 if n == 50 else 0.5, 100) for n in range(100)]
    out = str(tmp_path / "mol")
    df = table(rows, SCHEMA + ", num_tests int")
    extract.significant_windows(
        df, out, str(tmp_path / "iv"), data_type="molecular_trait", width=10
    )
    assert spark.read.parquet(out + "/bio_feature=t/chrom=1").count() == 21
    assert spark.read.csv(str(tmp_path / "iv"), sep="\t", header=True).count() == 1


def test_rows_without_study_chromosome_or_position_are_not_kept(table):
    rows = [(None, None, None, "1", 5, 0.0), ("s", None, None, None, 5, 0.0),
            ("s", None, None, "1", None, 0.0), ("s", None, None, "1", 7, 0.0)]
    df = table(rows, SCHEMA)
    hit = F.col("pval") <= 0.05
    forms = [
        windows.extract_windows(df, 3, "gwas", 0.05)[0],
        windows.keep_near_by_frame(df, hit, 3),
        windows.keep_near(df, df.where(hit), 3),
    ]
    for kept in forms:
        assert [tuple(r) for r in kept.collect()] == [("s", None, None, "1", 7, 0.0)]
    intervals = windows.merge_windows(df.where(hit), 3).collect()
    assert [(r.start, r.end) for r in intervals] == [(4, 10)]
