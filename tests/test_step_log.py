"""Quality logs written beside the output, and the header audit of many files."""

import gzip

import pytest
from pyspark.sql import functions as F

from helixspan.operators import harmonise, qc
from helixspan.plans import gwas, jobs
from helixspan.session import hand_over
from helixspan.sources import readers

PANEL = "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, af struct<gnomad_nfe:double>"


def counted(monkeypatch, owner, name):
    calls = []
    plain = getattr(owner, name)

    def call(*args, **options):
        calls.append(name)
        return plain(*args, **options)

    monkeypatch.setattr(owner, name, call)
    return calls


def read_log(spark, path):
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=True).collect()
    keys = ["study_id"] * ("study_id" in rows[0].asDict())
    return sorted(tuple(r[c] for c in [*keys, "step_no", "step", "n_rows", "removed"]) for r in rows)


def test_steps_are_counted_while_the_plan_writes(spark, table):
    df = table([(i, i % 7) for i in range(1000)], "id long, k int")
    with qc.step_log() as log:
        kept = qc.step(qc.step(df, "input").where("k < 5"), "small")
        written = hand_over(qc.step(kept.where("id % 2 = 0"), "even"))
    found = [(r["step"], r["n_rows"], r["removed"]) for r in log.report(spark).orderBy("step_no").collect()]
    small = sum(i % 7 < 5 for i in range(1000))
    even = sum(i % 7 < 5 and i % 2 == 0 for i in range(1000))
    assert found == [("input", 1000, 0), ("small", small, 1000 - small), ("even", even, small - even)]
    assert written.count() == even and qc.step(df, "no log open") is df


def test_an_expression_job_logs_its_steps(spark, tmp_path):
    fields = [f.strip().split(" ")[0] for f in readers.EQTL_ROWS.split(",")]
    values = dict(chromosome="1", ref="A", alt="C", beta="0.1", se="0.1", pvalue="0.01", maf="0.2", r2="0.9", gene_id="G", molecular_trait_id="G")
    lines = []
    for i in range(50):
        row = values | {"position": str(i), "ac": str(i % 10), "an": "1000"}
        lines.append("\t".join(row.get(f, "x") for f in fields))
    (tmp_path / "in.tsv").write_text("\n".join(lines) + "\n")
    jobs.eqtl(spark, str(tmp_path / "in.tsv"), str(tmp_path / "out"), "S", "T", log=str(tmp_path / "log"))
    assert read_log(spark, str(tmp_path / "log")) == [(0, "input", 50, 0), (1, "minor allele count", 25, 25)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25


def test_a_splicing_job_logs_with_one_panel_join(spark, table, tmp_path, monkeypatch):
    rows = [
        ("1:10:20:clu_1:ENSG1.1", f"1_{p}_A_C_b38", 5 + p % 3 * 5, 0.2, 0.01 * (p + 1), 0.5, 0.1) for p in range(20)
    ]
    names = [f.strip().split(" ")[0] for f in readers.TISSUE_SQTL.split(",")] if isinstance(readers.TISSUE_SQTL, str) else readers.TISSUE_SQTL.names
    given = dict(zip(["phenotype_id", "variant_id", "ma_count", "maf", "pval_nominal", "slope", "slope_se"], zip(*rows), strict=True))
    schema = spark.createDataFrame([], readers.TISSUE_SQTL).schema
    made = [tuple(given[n][i] if n in given else None for n in names) for i in range(20)]
    cast = [tuple(float(v) if f.dataType.simpleString() in ("double", "float") and v is not None else v for v, f in zip(m, schema)) for m in made]
    spark.createDataFrame(cast, schema).write.parquet(str(tmp_path / "in"))
    table([("1", p, "1", p, "A", "C", (0.2,)) for p in range(10)], PANEL).write.parquet(str(tmp_path / "panel"))
    joins = counted(monkeypatch, harmonise, "in_panel")
    jobs.tissue_sqtl(spark, str(tmp_path / "in"), str(tmp_path / "panel"), str(tmp_path / "out"), "S", "T", log=str(tmp_path / "log"))
    steps = read_log(spark, str(tmp_path / "log"))
    assert [s[1] for s in steps] == ["input", "minor allele count", "variant in panel", "best junction", "required columns"]
    assert steps[0][2] == 20 and steps[-1][2] == spark.read.parquet(str(tmp_path / "out")).count()
    assert joins == ["in_panel"]


@pytest.mark.parametrize("with_panel", [True, False])
def test_the_logged_ingest_equals_result_and_report(table, monkeypatch, with_panel):
    nan = float("nan")
    rows = [
        (f"S{i % 3}", "1", i, "A", "C" if i % 11 else "G", [0.5, nan, None][0 if i % 13 else i % 2 + 1], [0.1, None][i % 4 == 1],
         [0.01, 0.0, 1.0, None, nan][0 if i % 5 else i // 5 % 5], None if i % 6 == 0 else [0.3, 0.001][i % 8 == 7])
        for i in range(300)
    ]
    rows += [("tiny", "1", 1, "A", "C", 0.5, 0.1, 0.1, 0.3)]
    df = table(rows, "study_id string, chrom string, pos int, ref string, alt string, beta double, se double, pval double, eaf double")
    df = df.withColumns({"oddsr": F.lit(None).cast("double"), "oddsr_lower": F.lit(None).cast("double"), "info": F.lit(1.0)})
    studies = table([(s, 1000, 300 if s == "S1" else None) for s in ("S0", "S1", "S2", "tiny")], "study_id string, n_total int, n_cases int")
    panel = table([("1", i, "1", i, "A", "C", (0.25,)) for i in range(0, 300, 2)], PANEL) if with_panel else None
    if with_panel:
        want = gwas.standardise(df, studies, panel, min_rows=5)
    else:
        want = gwas.standardise_complete(df.drop("oddsr", "oddsr_lower"), studies, min_rows=5)
    report = gwas.ingest_report(df, studies, panel, min_rows=5)
    as_rows = lambda d: sorted(map(str, d.collect()))
    want, report = as_rows(want), as_rows(report.select("study_id", "step_no", "step", "n_rows", "removed"))
    joins = counted(monkeypatch, harmonise, "fill_eaf")
    result, logged = gwas.standardise_logged(df, studies, panel, min_rows=5)
    assert as_rows(result) == want
    assert as_rows(logged.select("study_id", "step_no", "step", "n_rows", "removed")) == report
    assert joins == ["fill_eaf"] * with_panel


def test_text_steps_need_no_number_test(table):
    df = table([("NaN", 1.0), (None, 1.0), ("A", float("nan"))], "ref string, beta double")
    report = qc.qc_report(df, [("ref", qc.present(F.col("ref"))), ("beta", qc.present(F.col("beta")))])
    assert [r["n_rows"] for r in report.orderBy("step_no").collect()] == [3, 2, 1]
    assert qc.complete(df, ["ref", "beta"]).count() == 1
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnan") <= 1


def test_headers_of_many_small_files_share_tasks(spark, tmp_path, monkeypatch):
    for i in range(300):
        text = f"a\tb{i % 3}\n" + f"{i}\t1\n" * (i % 5)
        if i % 10 == 0:
            (tmp_path / f"f{i}.tsv.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / f"f{i}.tsv").write_text(text)
    (tmp_path / "nothing.tsv").write_text("")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    found = readers.header_lines(spark, str(tmp_path))
    rows = {r["file_path"].rsplit("/", 1)[1]: r["header"] for r in found.collect()}
    assert len(rows) == 300
    assert all(h == f"a\tb{int(n[1:].split('.')[0]) % 3}" for n, h in rows.items())
    most = max(
        stage.numTasks
        for job in tracker.getJobIdsForGroup("headers")
        for s in tracker.getJobInfo(job).stageIds
        if (stage := tracker.getStageInfo(s))
    )
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert most <= 8


def test_headers_of_long_files_come_from_their_first_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "SMALL_FILE", 1000)
    for i in range(4):
        (tmp_path / f"long{i}.tsv").write_text(f"h{i}\n" + "x\ty\n" * 5000)
        (tmp_path / f"short{i}.tsv").write_text(f"s{i}\n" + "x\ty\n" * 20)
    rows = {r["file_path"].rsplit("/", 1)[1]: r["header"] for r in readers.header_lines(spark, str(tmp_path)).collect()}
    assert rows == {f"long{i}.tsv": f"h{i}" for i in range(4)} | {f"short{i}.tsv": f"s{i}" for i in range(4)}
