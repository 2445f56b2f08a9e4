"""Manifests, paths, numbers, reports and layouts of deliveries."""

import gzip
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from helixspan.functions import ids
from helixspan.operators import harmonise, layout, qc
from helixspan.plans import gwas, jobs
from helixspan.session import hand_over, scratch_path, settings, tidy
from helixspan.sources import readers, sinks

HEADER = "#chrom\tpos\tref\talt\tpval\tbeta\tsebeta\taf_alt\n"
MANIFEST = "in_tsv string, study_id string, n_total int, n_cases int"


def delivery(path, positions, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    rows = "".join(f"1\t{p}\tA\tC\t0.5\t0.1\t0.2\t0.4\n" for p in positions)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress((header + rows).encode()))
    else:
        path.write_text(header + rows)


def test_lines_may_be_files_folders_and_globs_with_odd_names(spark, table, tmp_path):
    delivery(tmp_path / "folder/a.tsv", [1])
    delivery(tmp_path / "folder/b.tsv.gz", [2])
    delivery(tmp_path / "glob/chr1.tsv", [3])
    delivery(tmp_path / "glob/chr2.tsv", [4])
    delivery(tmp_path / "glob/other.tsv", [99])
    delivery(tmp_path / "odd name/100% +x%41.tsv", [5])
    delivery(tmp_path / "x.split000.tsv", [6])
    delivery(tmp_path / "x.split001.tsv", [7])
    delivery(tmp_path / "plain.tsv", [8])
    lines = [
        (f"{tmp_path}/folder", "F"), (f"{tmp_path}/glob/chr[12].tsv", "G"),
        (f"{tmp_path}/odd name/100% +x%41.tsv", "O"), (f"{tmp_path}/x.split*.tsv", "X"),
        (f"file://{tmp_path}/pl{{ain,us}}.tsv", "P"), (f"{tmp_path}/folder/a.tsv", "A"),
    ]
    manifest = table([(*line, 1000, None) for line in lines], MANIFEST)
    out = str(tmp_path / "out")
    gwas.ingest(spark, manifest, None, out, readers.FINNISH_GWAS, min_rows=1)
    found = sorted((r.study_id, r.pos) for r in spark.read.parquet(out).collect())
    assert found == [("A", 1), ("F", 1), ("F", 2), ("G", 3), ("G", 4), ("O", 5), ("P", 8), ("X", 6), ("X", 7)]


def test_a_line_without_rows_fails(spark, table, tmp_path):
    delivery(tmp_path / "a.tsv", [1])
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty/x.tsv").write_text("")
    manifest = table([(f"{tmp_path}/a.tsv", "A", 9, None), (f"{tmp_path}/empty", "E", 9, None)], MANIFEST)
    with pytest.raises(ValueError, match="empty"):
        gwas.read_studies(spark, manifest, readers.FINNISH_GWAS)


def test_lines_with_a_scheme(table):
    files = table([("s3a://b/dir/x.tsv",), ("hdfs://n:8020/d/y.tsv",), ("/l/z.tsv",)], "file_path string")
    lines = table([("s3a://b/dir",), ("/d/y.tsv",), ("/l/*.tsv",), ("/other",), ("s3a://b/di",)], "line string")
    found = {tuple(r) for r in readers.files_of_lines(files, lines).collect()}
    assert found == {
        ("s3a://b/dir/x.tsv", "s3a://b/dir"), ("hdfs://n:8020/d/y.tsv", "/d/y.tsv"), ("/l/z.tsv", "/l/*.tsv"),
    }


def test_header_of_large_files_in_many_splits(spark, tmp_path):
    text = "a\tb\n" + "".join(f"{i}\t{i}\n" for i in range(50_000))
    for n in range(3):
        (tmp_path / f"{n}.tsv").write_text(text)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "65536"}):
        found = readers.header_lines(spark, str(tmp_path)).collect()
    assert sorted(r.header for r in found) == ["a\tb"] * 3


def test_integers_with_decimals(table):
    texts = ["12345.0", "7", "-3.9", "1e3", "x", None, "99999999999", " 5. "]
    got = table([(t,) for t in texts], "t string").select(ids.whole(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [12345, 7, -3, None, None, None, None, 5]


def test_unreadable_numbers_are_counted(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("hm_pos\thm_chrom\tp_value\n10.0\t1\tx\nX\t2\ty\n3\tNA\tNA\n")
    rows = readers.read_mapped_tsv(spark, str(tmp_path / "a.tsv"), readers.HARMONISED_GWAS, bad="lost")
    assert [(r.pos, r.lost) for r in rows.collect()] == [(10, 1), (None, 2), (3, 0)]


def test_confident_ingest_and_report(spark, table, tmp_path):
    header = HEADER.rstrip() + "\tlow_confidence_variant\n"
    rows = [(1, "0.2", "false"), (2, "0.2", "true"), (3, "NaN", "false"), (4, "NA", "false"), (5, "0.2", "false")]
    for study, size in (("A", 5), ("B", 1)):
        body = "".join(f"1\t{p}\tA\tC\t0.5\t0.1\t{se}\t0.4\t{flag}\n" for p, se, flag in rows[:size])
        (tmp_path / f"{study}.tsv").write_text(header + body)
    (tmp_path / "m.json").write_text("".join(
        json.dumps({"in_tsv": f"{tmp_path}/{s}.tsv", "study_id": s, "n_total": 1000, "n_cases": None}) + "\n"
        for s in "AB"))
    jobs.gwas_ingest(spark, str(tmp_path / "m.json"), None, str(tmp_path / "out"), readers.FINNISH_GWAS,
                     min_rows=2, confident=True, log=str(tmp_path / "log"))
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.study_id, r.pos) for r in kept.collect()) == [("A", 1), ("A", 5)]
    log = spark.read.csv(str(tmp_path / "log"), sep="\t", header=True, inferSchema=True)
    found = {(r.study_id, r.step): (r.n_rows, r.removed) for r in log.collect()}
    assert found["A", "input"] == (4, 0) and found["A", "required columns"] == (2, 2)
    assert found["A", "minor allele count"] == (2, 0)
    assert found["B", "required columns"] == (1, 0) and found["B", "enough rows"] == (0, 1)
    assert found["B", "minor allele count"] == (0, 0)


def test_biobank_names_with_odds_ratios(spark, table, tmp_path):
    """The biobank column map from files to the unified table, with a panel."""
    panel = [("1", p, "1", p, "A", "C", (0.2,) if p != 3 else (None,)) for p in range(1, 5)]
    table(panel, "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, "
          "af struct<gnomad_nfe: double>").write.parquet(str(tmp_path / "panel"))  # fmt: skip
    rows = {new: name for name, (new, _) in readers.BIOBANK_GWAS.items()}
    order = [rows[c] for c in ("chrom", "pos", "ref", "alt", "pval", "beta", "se", "oddsr", "oddsr_lower", "eaf")]
    body = ["1\t1.0\tA\tC\t0.5\tNA\tNA\t2.0\t1.5\tNA", "1\t2\tA\tC\t0.5\t0.1\tNA\tNA\tNA\t0.3",
            "1\t3\tA\tC\t0.5\t0.1\t0.2\tNA\tNA\tNA"]
    (tmp_path / "b.tsv").write_text("\t".join(order) + "\n" + "\n".join(body) + "\n")
    manifest = table([(f"{tmp_path}/b.tsv", "UKB", 1000, 200)], MANIFEST)
    gwas.ingest(spark, manifest, readers.read_panel(spark, str(tmp_path / "panel")), str(tmp_path / "out"),
                readers.BIOBANK_GWAS, min_rows=1)
    found = {r.pos: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(found) == {1, 2} and found[1].beta == pytest.approx(math.log(2)) and found[1].eaf == 0.2
    assert found[2].se > 0 and found[2].is_cc


def test_tests_are_counted_before_unknown_frequencies_go(table):
    ddl = ("chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, "
           "af struct<gnomad_nfe: double>")  # fmt: skip
    panel = table([("1", p, "1", p, "A", "G", (0.3,) if p % 2 else (None,)) for p in range(10)], ddl)
    repeated = panel.unionByName(panel.withColumn("af", F.struct(F.lit(None).cast("double").alias("gnomad_nfe"))))
    from helixspan.plans import molecular

    rows = table([(0.1, "1", p, 2.0, "G", "A", "E1", 1000) for p in range(10)],
                 "pval double, chrom string, pos int, z double, effect_allele string, other_allele string, "
                 "gene_id string, n_total int")  # fmt: skip
    for sites in (panel, repeated):
        out = molecular.eqtl_from_z(rows, sites, study_id="S", bio_feature="T").collect()
        assert len(out) == 5 and {r.num_tests for r in out} == {10}


def test_prepared_panel_is_taken_as_it_is(spark, table, tmp_path):
    ddl = ("chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, "
           "af struct<gnomad_nfe: double>")  # fmt: skip
    panel = table([("1", p, "1", p + 5, "A", "G", (0.3,)) for p in (1, 2, 2, 3)], ddl)
    panel.write.parquet(str(tmp_path / "p"))
    jobs.prepare_panel(spark, str(tmp_path / "p"), str(tmp_path / "sites"))
    ready = spark.read.parquet(str(tmp_path / "sites"))
    sites = harmonise.panel_sites(ready)
    assert sorted(r.pos for r in sites.collect()) == [6, 7, 8]
    assert "Aggregate" not in sites._jdf.queryExecution().executedPlan().toString()
    wanted = table([("1", 7, "A", "G")], "chrom string, pos int, ref string, alt string")
    assert [r.pos for r in harmonise.panel_sites(panel, wanted=wanted).collect()] == [7]


def test_exports_write_few_files(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 16).selectExpr("concat('p', id % 50) AS phenotype", "id AS x")
    sinks.write_export(rows, str(tmp_path / "e"), "phenotype")
    files = list((tmp_path / "e").glob("*/part-*"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= 50 + tasks and len({f.parent for f in files}) == 50


def test_one_hot_folder_without_positions_is_spread(spark):
    rows = spark.range(20_000).selectExpr("'hot' AS f", "id AS x")
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}):
        sizes = layout.by_folder_and_position(rows, ["f"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4


def test_finished_studies_are_not_read(spark, table, tmp_path, monkeypatch):
    from helixspan.plans import extract
    from helixspan.schema import GWAS_SCHEMA, conform

    rows = [("gwas", s, "1", n, 0.001) for s in "abc" for n in range(3)]
    base = conform(table(rows, "type string, study_id string, chrom string, pos int, pval double"), GWAS_SCHEMA)
    sinks.write_by_folder(base, str(tmp_path / "g"), ["study_id"])
    jobs.filter_gwas(spark, str(tmp_path / "g/study_id=a"), str(tmp_path / "none"), partitions=1)
    first = extract.filter_gwas(base.where("study_id = 'a'"))
    extract.write_filtered(first, str(tmp_path / "f1"), 1)
    (tmp_path / "done.txt").write_text("/o/a.parquet/_SUCCESS\n/o/b.parquet/_SUCCESS\n")
    plans = []
    write = extract.write_filtered
    monkeypatch.setattr(jobs.extract, "write_filtered", lambda df, *a: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a)))
    jobs.filter_gwas(spark, str(tmp_path / "g"), str(tmp_path / "f2"), str(tmp_path / "f1"),
                     str(tmp_path / "done.txt"), partitions=1)
    out = spark.read.parquet(str(tmp_path / "f2"))
    assert sorted({r.study_id for r in out.collect()}) == ["a", "c"] and out.count() == 6
    assert "PartitionFilters: [NOT study_id" in plans[0] or "PartitionFilters: [isnotnull(study_id" in plans[0]


def test_names_of_finished_studies(table):
    paths = table([("/o/GTEx-eQTL.parquet/_SUCCESS",), ("/o/S1.parquet",)], "path string")
    assert [r[0] for r in paths.select(ids.study_of_output(F.col("path"))).collect()] == ["GTEx-eQTL", "S1"]


def test_jobs_remove_their_tables(spark, table):
    from pathlib import Path

    df = table([(1,)], "a int")
    with tidy(spark):
        path = scratch_path(spark, "x")
        df.write.parquet(path)
        assert hand_over(df).count() == 1
        inner = Path(path.removeprefix("file:").replace("//", "/"))
        assert inner.exists()
    assert not inner.exists()


def test_report_sees_what_the_filter_drops(table):
    rows = [(1.0, "s"), (float("nan"), "s"), (None, "s"), (2.0, None)]
    df = table(rows, "x double, k string")
    steps = [("x", qc.present(F.col("x"))), ("k", qc.present(F.col("k")))]
    found = [(r.step, r.n_rows, r.removed) for r in qc.qc_report(df, steps).orderBy("step_no").collect()]
    assert found == [("input", 4, 0), ("x", 2, 2), ("k", 1, 1)]
    assert qc.complete(df, ["x", "k"]).count() == 1


def test_repeated_lookups_do_not_multiply(spark, table):
    from helixspan.plans import exports

    rng = random.Random(0)
    rows = [(f"1:{p}:A:G", "p1", 100, 20, 0.1, 0.2, rng.random()) for p in range(5)]
    linear = table(rows, "variant string, phenotype string, n_complete_samples int, AC int, beta double, "
                   "se double, pval double")  # fmt: skip
    variants = table([("1", p, "A", "G", f"rs{p}", 0.5) for p in range(5)] * 2,
                     "chr string, pos bigint, ref string, alt string, rsid string, info double")
    known = table([("p1", "d", 1, 1, 5, 5)] * 2, "phenotype string, description string, n_non_missing int, "
                  "n_missing int, n_controls int, n_cases int")  # fmt: skip
    assert exports.linear_model_export(linear, variants, known).count() == 5


def test_manifest_jobs(spark, tmp_path):
    (tmp_path / "paths").write_text("/in/finngen_R5_AB1.gz\n/in/finngen_R5_ZZ.gz\n")
    (tmp_path / "done").write_text("/out/F_OLD.parquet/_SUCCESS\n")
    (tmp_path / "ends.json").write_text(
        '{"phenocode": "AB1", "phenostring": "x", "category": "c", "num_cases": 3, "num_controls": 4}\n')
    jobs.finnish_manifest(spark, str(tmp_path / "ends.json"), str(tmp_path / "paths"), str(tmp_path / "done"),
                          str(tmp_path / "m"), "F_", "finngen_R5_", "/out/")
    found = spark.read.json(str(tmp_path / "m")).collect()
    assert [(r.study_id, r.n_total, r.n_cases, r.out_parquet) for r in found] == [("F_AB1", 7, 3, "/out/F_AB1.parquet")]

    (tmp_path / "meta.tsv").write_text(
        "study_id\tgwascat_path\tto_ingest\tn_cases\tn_controls\tn_quant\n"
        "GCST1\t/s/GCST1/a.gz\t1\t5\t6\t\nGCST2\t/s/GCST2/b.gz\t1\t\t\t9\n")
    (tmp_path / "inputs").write_text("/in/a.gz\n")
    jobs.gwas_manifest(spark, str(tmp_path / "meta.tsv"), str(tmp_path / "inputs"), str(tmp_path / "done"),
                       str(tmp_path / "gm"), "/in/", "/af", "/out/", "/log/")
    assert [(r.study_id, r.n_total) for r in spark.read.json(str(tmp_path / "gm")).collect()] == [("GCST1", 11)]

    (tmp_path / "studies.tsv").write_text(
        "study\tqtl_group\tquant_method\tftp_path\nGTEx\tliver\tge\tftp://x/l.gz\nA\tb\texon\tftp://x/e.gz\n")
    jobs.eqtl_manifest(spark, str(tmp_path / "studies.tsv"), str(tmp_path / "done"), str(tmp_path / "em"), "/in/", "/out/")
    assert [(r.study_id, r.in_nominal) for r in spark.read.json(str(tmp_path / "em")).collect()] == [("GTEx-eQTL", "/in/l.gz")]

    (tmp_path / "ukb").write_text("/g/50.neale2.gz\n/g/PheCode_4.1_SAIGE_Nov2017_x.gz\n")
    (tmp_path / "linear.tsv").write_text("phenotype\tdescription\tn_non_missing\tn_cases\tn_controls\n50\theight\t100\t\t\n")
    (tmp_path / "mixed.csv").write_text(
        'PheCode,Phenotype Description,Phenotype Category,Number of cases,Number of controls\n4.1,d,c,"1,000","2,000"\n')
    jobs.biobank_manifest(spark, str(tmp_path / "ukb"), str(tmp_path / "linear.tsv"), str(tmp_path / "mixed.csv"),
                          str(tmp_path / "done"), str(tmp_path / "bm"), str(tmp_path / "phenotypes"), "/af", "/out/")
    found = {r.study_id: r.n_total for r in spark.read.json(str(tmp_path / "bm")).collect()}
    assert found == {"NEALE2_50": 100, "SAIGE_4_1": 3000}
    assert spark.read.csv(str(tmp_path / "phenotypes"), sep="\t", header=True).count() == 2


def test_metadata_side_tables(spark, tmp_path):
    (tmp_path / "paths.txt").write_text("/s/GCST1/f.gz\n/s/GCST2/f.gz\n/s/GCST2/g.gz\n")
    (tmp_path / "table.tsv").write_text(
        "STUDY ACCESSION\tPUBMEDID\tDISEASE/TRAIT\tINITIAL SAMPLE SIZE\n"
        "GCST1\t9\tt\t12 Finnish cases\nGCST2\t9\tt\t12 Finnish cases\n")
    (tmp_path / "prev.tsv").write_text("study_id\tnote\nGCST7\tn\nGCST1\tm\nGCST1\tm\n")
    (tmp_path / "done.txt").write_text("/o/GCST7.parquet/_SUCCESS\n")
    jobs.metadata(spark, str(tmp_path / "paths.txt"), str(tmp_path / "table.tsv"), str(tmp_path / "prev.tsv"),
                  str(tmp_path / "done.txt"), str(tmp_path / "meta"), str(tmp_path / "twice"), str(tmp_path / "gone"))
    read = lambda name: [tuple(r) for r in spark.read.csv(str(tmp_path / name), sep="\t", header=True).collect()]
    assert read("twice") == [("GCST2", "2")] and read("gone") == [("GCST7", "n")]
    assert sorted(r[0] for r in spark.read.csv(str(tmp_path / "meta"), sep="\t", header=True).select("study_id").collect()) == ["GCST1", "GCST7"]
