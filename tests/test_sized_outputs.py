"""Outputs whose number of files follows from their size."""

import pytest
from pyspark.sql import functions as F

from helixspan.plans import extract
from helixspan.session import shared_folder
from helixspan.sources import sinks


@pytest.mark.parametrize(
    ("n_bytes", "files"), [(0, 1), (1 << 20, 1), (128 << 20, 1), ((128 << 20) + 1, 2), (10 << 30, 80)]
)
def test_files_for_a_size(n_bytes, files):
    assert sinks.files_for(n_bytes) == files


def rows_of(spark, n):
    """Rows that do not compress to nothing, most of them at one position."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise("2").alias("chrom"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.xxhash64("id") % 10**6).cast("int").alias("pos"),
        F.sha2(F.col("id").cast("string"), 256).alias("variant_id"),
    )


def parts(path):
    return [p for p in path.iterdir() if p.name.startswith("part-")]


def test_files_follow_the_size(spark, tmp_path):
    out = tmp_path / "out"
    df = rows_of(spark, 20000)
    n = sinks.write_sized(df, str(out), 200 << 10)
    assert n > 4
    sizes = [p.stat().st_size for p in parts(out)]
    # A position that a third of the rows share is cut as well.
    assert abs(len(sizes) - n) <= 1 and max(sizes) < 3 * (200 << 10)
    back = spark.read.parquet(str(out))
    assert back.count() == 20000 and back.exceptAll(df).isEmpty()


def test_a_small_output_is_one_file_and_leaves_no_copy(spark, tmp_path):
    from pathlib import Path

    shared = Path(shared_folder(spark))
    before = set(shared.glob("unsized-*"))
    extract.write_filtered(rows_of(spark, 100), str(tmp_path / "out"))
    assert len(parts(tmp_path / "out")) == 1
    assert set(shared.glob("unsized-*")) == before


def test_no_rows_still_make_a_table(spark, tmp_path):
    assert sinks.write_sized(rows_of(spark, 0), str(tmp_path / "out")) == 1
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["chrom", "pos", "variant_id"]


def test_the_input_is_evaluated_once(spark, tmp_path):
    """Sampling of the range bounds reads the copy, not what made the rows."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = rows_of(spark, 5000)
    sinks.write_sized(df.mapInArrow(count, df.schema), str(tmp_path / "out"), 50 << 10)
    assert seen.value == 5000


def test_an_output_replaces_a_table_it_was_made_from(spark, tmp_path):
    out = str(tmp_path / "out")
    extract.write_filtered(rows_of(spark, 300), out)
    extract.write_union(spark.read.parquet(out).where("chrom = '1'"), out)
    assert spark.read.parquet(out).count() == 100
