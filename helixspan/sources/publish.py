"""Outputs that appear as a whole or not at all.

A job writes beside its output, checks the staged rows, and only then puts the staged
folder in the place of the old one. The marker of a finished output is written into the
staged folder, so data and marker appear together: whoever looks for finished outputs
never takes half an output for one. A job that dies leaves the old output untouched and a
staged folder that the next run of the same output removes.

The switch is two renames, which file systems such as HDFS do at once; between them the
old output is complete under its second name, and the next run puts it back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from helixspan.operators import qc

MARKER = "_PUBLISHED"


class Files:
    """The few file operations that publishing needs, on any storage Spark knows."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def exists(self, path: str) -> bool:
        system, where = self.at(path)
        return system.exists(where)

    def stored_bytes(self, path: str) -> int:
        system, where = self.at(path)
        return system.getContentSummary(where).getLength()

    def remove(self, path: str) -> None:
        system, where = self.at(path)
        system.delete(where, True)

    def rename(self, old: str, new: str) -> None:
        system, where = self.at(old)
        if not system.rename(where, self.at(new)[1]):
            raise OSError(f"cannot rename {old} to {new}")

    def touch(self, path: str) -> None:
        system, where = self.at(path)
        system.create(where, True).close()


def names(out: str) -> tuple[str, str]:
    """Where an output is staged, and where the old one is while they change places."""
    plain = out.rstrip("/")
    return f"{plain}.staged", f"{plain}.previous"


def recover(spark: SparkSession, out: str) -> None:
    """Undo what a run left behind that died: staged rows, or an old output out of its place."""
    files = Files(spark)
    staged, previous = names(out)
    files.remove(staged)
    if files.exists(previous):
        if files.exists(out):
            files.remove(previous)
        else:
            files.rename(previous, out.rstrip("/"))


def publish(
    df: DataFrame,
    out: str,
    write: Callable[[DataFrame, str], None],
    rules: Sequence[tuple[str, Column]] = (),
    min_rows: int = 1,
) -> int:
    """Write ``df`` and put it in the place of ``out`` if it passes; returns its rows.

    ``rules`` are (name, predicate) that every staged row has to meet. Jobs for the same
    output must not run at the same time.
    """
    spark = df.sparkSession
    recover(spark, out)
    files, (staged, _) = Files(spark), names(out)
    write(df, staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    n = rows.count()
    broken = [(r["rule"], r["n_rows"]) for r in qc.violations(rows, rules).collect() if r["n_rows"]] if rules else []
    if n < min_rows or broken:
        files.remove(staged)
        raise ValueError(f"{out} stays as it was: {n} rows staged, rules broken by rows: {broken}")
    switch(spark, out)
    return n


def switch(spark: SparkSession, out: str) -> None:
    """Mark the staged folder as finished and put it in the place of the output."""
    files, (staged, previous) = Files(spark), names(out)
    files.touch(f"{staged}/{MARKER}")
    if files.exists(out):
        files.rename(out.rstrip("/"), previous)
    files.rename(staged, out.rstrip("/"))
    files.remove(previous)


def is_published(spark: SparkSession, out: str) -> bool:
    return Files(spark).exists(f"{out.rstrip('/')}/{MARKER}")
