"""Unions of data sets and skipping of finished work."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from helixspan.session import hand_over


def union_all(tables: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by name; with ``allow_missing`` absent columns become null."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(tables)
    )


def gwas_with_molecular(gwas: DataFrame, molecular: DataFrame) -> DataFrame:
    """One table of both kinds, without the test counts only molecular rows have."""
    return gwas.unionByName(molecular.drop("num_tests"))


def not_done(work: DataFrame, done: DataFrame, key: str = "study_id") -> DataFrame:
    """Work items without a finished output."""
    return work.join(done.select(key), key, "left_anti")


def extend(
    finished: DataFrame, new: DataFrame, done: DataFrame | None = None, key: str = "study_id"
) -> DataFrame:
    """Finished rows plus the rows of studies not yet done.

    ``done`` lists the studies that count as finished, also those that left no row;
    without it the studies among the finished rows do.
    """
    studies = hand_over((finished if done is None else done).select(key).distinct(), "done")
    return finished.unionByName(not_done(new, studies, key).select(finished.columns))


def missing_rows(previous: DataFrame, current: DataFrame, key: str = "study_id") -> DataFrame:
    """Rows of the previous table whose id is gone from the current one."""
    return previous.join(current.select(key), key, "left_anti")


def existing_only(work: DataFrame, paths: DataFrame, column: str, path: str = "path") -> DataFrame:
    """Work items whose input file is in the path list."""
    return work.join(paths.select(F.col(path).alias(column)), column, "left_semi")


def id_counts(df: DataFrame, key: str = "study_id") -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def drop_repeated_ids(df: DataFrame, key: str = "study_id") -> DataFrame:
    """Remove every row whose id is not unique, in one combined aggregation."""
    row = F.struct(*df.columns)
    singles = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row")
    )
    return singles.where("_n = 1").select("_row.*")


def without_prefixes(
    df: DataFrame, column: str, prefixes: Sequence[str]
) -> DataFrame:
    """Drop rows whose value starts with any of a short fixed list of prefixes.

    One pattern names the column once: Spark puts the expression behind the column into the
    filter, and would work it out again for every prefix.
    """
    if not prefixes:
        return df
    starts = F.col(column).rlike(f"^(?:{'|'.join(map(re.escape, prefixes))})")
    return df.where(~F.coalesce(starts, F.lit(False)))
