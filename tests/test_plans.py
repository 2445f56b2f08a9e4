"""What the plans must and must not contain."""

import contextlib

import pytest
from pyspark.sql import functions as F

from helixspan.operators import harmonise, qtl, windows
from helixspan.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan_of(df, run=False):
    if run:
        df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["window_extract_join", "allele_harmonise", "pipeline_gwas", "pipeline_sqtl", "bh_fdr",
     "liftover_sites", "cis_window", "pipeline_linear_export"],
)
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("NestedLoop", "CartesianProduct", "EvalPython", "MapInPandas", "InArrow"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table([("s", "1", 5, 0.1, 1.0)], "study_id string, chrom string, pos int, pval double, beta double").write.parquet(path)
    df = spark.read.parquet(path).where("pval <= 0.005D AND chrom = '1' AND pos > 3").select("pos")
    plan = plan_of(df)
    assert "LessThanOrEqual(pval,0.005)" in plan and "EqualTo(chrom,1)" in plan
    assert "beta" not in plan and "study_id" not in plan


def test_nested_frequency_is_pruned(spark, table, tmp_path):
    path = str(tmp_path / "p")
    table(
        [("1", 1, "1", 2, "A", "C", (0.1, 0.2))],
        "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, "
        "af struct<gnomad_nfe: double, gnomad_afr: double>",
    ).write.parquet(path)
    from helixspan.sources.readers import read_panel

    plan = plan_of(read_panel(spark, path))
    assert "gnomad_nfe" in plan and "gnomad_afr" not in plan


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def hot(spark):
    """One gene and variant holds a third of 300,000 rows."""
    rows = spark.range(0, 300_000, 1, 16)
    cold = F.col("id") % 3 > 0
    number = F.when(cold, F.col("id") % 5003 + 2).otherwise(F.lit(1))
    return rows.select(
        F.lit("s").alias("study_id"),
        F.lit(None).cast("string").alias("phenotype_id"),
        F.lit("t").alias("bio_feature"),
        F.concat(F.lit("g"), number.cast("string")).alias("gene_id"),
        F.lit("1").alias("chrom"),
        number.cast("int").alias("pos"),
        F.lit("A").alias("ref"),
        F.lit("G").alias("alt"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.lit(None).cast("double").alias("eaf"),
        F.when(F.col("id") == 0, 1e-9).otherwise(0.5).alias("pval"),
    )


def test_a_hot_gene_is_split(spark, hot):
    with settings(spark, **SMALL):
        df = qtl.add_num_tests(hot, ["gene_id"])
        assert "skew=true" in plan_of(df, run=True)
        assert df.where("gene_id = 'g1'").agg(F.count("*"), F.max("num_tests")).first()[:] == (
            100_000, 100_000,
        )


def test_a_hot_variant_is_split(spark, hot, table):
    panel = spark.range(1, 5010).selectExpr(
        "'1' AS chrom_b38", "cast(id as int) AS pos_b38", "'A' AS ref", "'G' AS alt",
        "named_struct('gnomad_nfe', id / 10000D) AS af",
    )
    with settings(spark, **SMALL):
        sites = harmonise.panel_sites(panel)
        df = harmonise.fill_eaf(hot, sites)
        assert "skew=true" in plan_of(df, run=True)
        assert df.where("eaf IS NULL").count() == 0 and df.count() == 300_000
        aligned = harmonise.align_alleles(
            hot.drop("ref", "alt").withColumns({"effect_allele": F.lit("A"), "other_allele": F.lit("G")}),
            sites,
        )
        assert "skew=true" in plan_of(aligned, run=True)


def test_a_hot_window_is_split(spark, hot):
    with settings(spark, **SMALL):
        kept, _ = windows.extract_windows(hot, 100, "gwas", 1e-8)
        assert "skew=true" in plan_of(kept, run=True)
        assert kept.count() == hot.where("pos <= 101").count()


def test_splicing_reads_delivery_and_panel_once(spark, table, tmp_path, monkeypatch):
    from helixspan.plans import molecular
    from helixspan.sources import readers

    scans = []
    real = molecular.hand_over

    def watched(df, label="table"):
        if label == "known":
            scans.append(plan_of(df).count("FileScan"))
        return real(df, label)

    monkeypatch.setattr(molecular, "hand_over", watched)
    rows = [("chr1:1:2:clu_1:ENSG1.1", "chr1_5_A_G_b38", 20, 0.1, 0.01, 0.5, 0.1)]
    table(rows, readers.TISSUE_SQTL).write.parquet(str(tmp_path / "rows.parquet"))
    panel = table(
        [("1", 5, "1", 5, "A", "G", (0.1,))],
        "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, "
        "af struct<gnomad_nfe: double>",
    )
    delivered = spark.read.parquet(str(tmp_path / "rows.parquet"))
    out = molecular.tissue_sqtl(delivered, panel, study_id=F.lit("s"), bio_feature=F.lit("t"))
    assert out.count() == 1 and scans == [2]
    assert "slope_se" in plan_of(out) and "variant_id" not in plan_of(out)
