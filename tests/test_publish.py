"""Outputs that appear as a whole, and joins of bucketed tables."""

import pytest
from pyspark.sql import functions as F

from helixspan.operators import harmonise
from helixspan.plans import jobs
from helixspan.sources import buckets, publish, readers, sinks


def by_folder(df, path):
    sinks.write_by_folder(df, path, ["study_id"])


def rows_of(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("study_id", "x").collect()))


@pytest.fixture
def one(table):
    return table([("A", 1), ("B", 2)], "study_id string, x int")


def test_a_new_output_replaces_the_old_one_with_its_marker(spark, table, one, tmp_path):
    out = str(tmp_path / "out")
    assert publish.publish(one, out, by_folder) == 2 and publish.is_published(spark, out)
    publish.publish(table([("B", 3), ("C", 4)], "study_id string, x int"), out, by_folder)
    assert rows_of(spark, out) == [("B", 3), ("C", 4)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_rows_that_break_a_rule_leave_the_old_output(spark, table, one, tmp_path):
    out = str(tmp_path / "out")
    publish.publish(one, out, by_folder)
    bad = table([("A", 9), ("A", None)], "study_id string, x int")
    with pytest.raises(ValueError, match="x is given"):
        publish.publish(bad, out, by_folder, [("x is given", F.col("x").isNotNull())])
    with pytest.raises(ValueError, match="0 rows"):
        publish.publish(bad.limit(0), out, by_folder)
    assert rows_of(spark, out) == [("A", 1), ("B", 2)] and publish.is_published(spark, out)


def test_a_job_killed_between_two_folders_leaves_the_old_output(spark, table, one, tmp_path):
    out = str(tmp_path / "out")
    publish.publish(one, out, by_folder)

    def dies(df, path):
        by_folder(df.where("study_id = 'A'"), path)
        raise KeyboardInterrupt

    new = table([("A", 7), ("B", 8)], "study_id string, x int")
    with pytest.raises(KeyboardInterrupt):
        publish.publish(new, out, dies)
    assert rows_of(spark, out) == [("A", 1), ("B", 2)]
    fresh = str(tmp_path / "fresh")
    with pytest.raises(KeyboardInterrupt):
        publish.publish(new, fresh, dies)
    assert not publish.is_published(spark, fresh) and not (tmp_path / "fresh").exists()
    publish.publish(new, out, by_folder)
    assert rows_of(spark, out) == [("A", 7), ("B", 8)] and not (tmp_path / "out.staged").exists()


@pytest.mark.parametrize("after", ["old away", "new in place"])
def test_a_job_killed_between_the_renames_is_recovered(spark, table, one, tmp_path, monkeypatch, after):
    out = str(tmp_path / "out")
    publish.publish(one, out, by_folder)
    plain, calls = publish.Files.rename, []

    def dies(self, old, new):
        if after == "old away" and calls:
            raise KeyboardInterrupt
        plain(self, old, new)
        calls.append(new)
        if after == "new in place" and len(calls) == 2:
            raise KeyboardInterrupt

    new = table([("A", 7)], "study_id string, x int")
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(publish.Files, "rename", dies)
        publish.publish(new, out, by_folder)
    publish.recover(spark, out)
    assert rows_of(spark, out) == ([("A", 1), ("B", 2)] if after == "old away" else [("A", 7)])
    assert publish.is_published(spark, out) and sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_windows_are_skipped_only_once_they_are_whole(spark, table, tmp_path, monkeypatch):
    from helixspan.plans import extract

    calls = []

    def dies(table, out, *options):
        calls.append(out)
        table.limit(1).write.parquet(out)
        if len(calls) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(extract, "significant_windows", dies)
    table([("1", 5)], "chrom string, pos int").write.parquet(str(tmp_path / "in"))
    run = lambda: jobs.significant_windows(spark, str(tmp_path / "in"), str(tmp_path / "out"), None, "gwas", skip_finished=True)
    with pytest.raises(RuntimeError):
        run()
    assert not (tmp_path / "out").exists()
    run()
    run()
    assert len(calls) == 2 and publish.is_published(spark, str(tmp_path / "out"))


# -- buckets ---------------------------------------------------------------------------

PANEL = "chrom_b37 string, pos_b37 int, chrom_b38 string, pos_b38 int, ref string, alt string, af struct<gnomad_nfe:double>"


def test_joins_of_bucketed_tables_need_no_exchange(spark, table, tmp_path):
    panel = table([("1", i, "1", i, "A", "C", (i / 1000,)) for i in range(1, 500)], PANEL)
    panel.write.parquet(str(tmp_path / "raw"))
    out = str(tmp_path / "panel")
    jobs.prepare_panel(spark, str(tmp_path / "raw"), out, n_buckets=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sites = harmonise.panel_sites(buckets.read_bucketed(spark, out))
        rows = table([(f"S{i % 3}", "1", i % 600, "A", "C", None if i % 4 else 0.5) for i in range(1200)],
                     "study_id string, chrom string, pos int, ref string, alt string, eaf double")
        dealt = buckets.alike_bucketed(rows, out)
        filled = harmonise.fill_eaf(dealt, sites)
        kept = harmonise.in_panel(dealt, sites)
        named = harmonise.attach_by_variant(dealt, sites.withColumnRenamed("gnomad_nfe", "f"), ["f"])
        want = sorted(map(str, harmonise.fill_eaf(rows, harmonise.panel_sites(panel)).collect()))
        assert sorted(map(str, filled.collect())) == want
        for frame in (filled, kept, named):
            frame.collect()
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert kept.count() == sum(1 <= i % 600 < 500 for i in range(1200))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_have_one_file_per_bucket_and_their_counts(spark, table, tmp_path):
    rows = table([("1", i % 50, "A", "C") for i in range(1000)], "chrom string, pos int, ref string, alt string")
    out = str(tmp_path / "rows")
    buckets.write_bucketed(rows, out, 4)
    files = spark.read.parquet(out).select(F.col("_metadata.file_name").alias("f")).groupBy("f").count()
    counts = sorted(r["n_rows"] for r in buckets.rows_per_bucket(rows, 4).collect())
    assert sorted(r["count"] for r in files.collect()) == counts and sum(counts) == 1000
    assert readers.read_parquet(spark, out).count() == buckets.read_bucketed(spark, out).count() == 1000
