"""Windows kept up to date: a new delivery changes few of them, and only those are read again.

Stored intervals and those of the new hits are merged. What an updated interval covers
beyond the stored ones are the added ranges; the earlier output already holds all else. The
earlier table is read inside the added ranges alone.

This holds for a fixed p-value. A Bonferroni limit moves with the number of tests, so
molecular data sets are cut anew when rows are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from helixspan.operators.windows import KEYS, keep_inside, merge_windows, significant
from helixspan.session import hand_over


def update_intervals(
    stored: DataFrame, fresh: DataFrame, keys: Sequence[str] = KEYS
) -> tuple[DataFrame, DataFrame]:
    """(updated intervals, added ranges) from two sets of intervals, each merged before.

    Intervals that overlap or share an end position become one, as in ``merge_windows``.
    Windows here are per group of keys: disjoint intervals of one study and chromosome.
    """
    columns = [*keys, "start", "end"]
    both = stored.select(*columns, F.lit(True).alias("_old")).unionByName(
        fresh.select(*columns, F.lit(False).alias("_old"))
    )
    along = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = both.withColumn("_apart", F.col("start") > reach).withColumn(
        "_island", F.count_if("_apart").over(upto)
    )
    updated = islands.groupBy(*keys, "_island").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )
    within = Window.partitionBy(*keys, "_island")
    # Stored intervals first, in order; a fresh one stands for its island only if no stored one does.
    ordered = within.orderBy(F.desc("_old"), "start")
    first, last = F.min("start").over(within), F.max("end").over(within)
    marked = islands.select(
        *keys,
        "start",
        "end",
        "_old",
        F.row_number().over(ordered).alias("_nth"),
        F.lag("end").over(ordered).alias("_before"),
        F.count_if("_old").over(within).alias("_n_old"),
        first.alias("_first"),
        last.alias("_last"),
    )

    def piece(start: Column, end: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))

    nth, n_old = F.col("_nth"), F.col("_n_old")
    ahead = piece(F.coalesce(F.col("_before") + 1, F.col("_first")), F.col("start") - 1)
    behind = F.when(nth == n_old, piece(F.col("end") + 1, F.col("_last")))
    whole = F.when((n_old == 0) & (nth == 1), F.array(piece(F.col("_first"), F.col("_last"))))
    pieces = F.when(F.col("_old"), F.array_compact(F.array(ahead, behind))).otherwise(whole)
    added = marked.select(*keys, F.inline(pieces)).where(F.col("start") <= F.col("end"))
    return updated.select(*columns), added


def reading_only(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """``df`` with the bounds of the ranges per chromosome as a filter that reaches the scan.

    One bound per chromosome is read by the driver; how many there are depends on the genome.
    """
    bounds = ranges.groupBy("chrom").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    found = [
        (F.col("chrom") == r["chrom"]) & F.col("pos").between(r["low"], r["high"])
        for r in bounds.toLocalIterator()
        if r["chrom"] is not None
    ]
    return df.where(reduce(lambda a, b: a | b, found, F.lit(False)))


def update_windows(
    new: DataFrame,
    earlier: DataFrame,
    kept: DataFrame,
    intervals: DataFrame,
    width: int = 2_000_000,
    pval: float = 5e-8,
    keys: Sequence[str] = KEYS,
) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, merged intervals) of ``earlier`` and ``new`` together.

    ``kept`` and ``intervals`` are the output for ``earlier`` with the same width and
    p-value. The result is the one of ``extract_windows`` over both tables.
    """
    size = 2 * width + 1
    fresh = merge_windows(new.where(significant("gwas", pval)).select(*keys, "pos"), width, keys)
    updated, added = update_intervals(intervals, hand_over(fresh, "fresh-windows"), keys)
    updated, added = hand_over(updated, "updated-windows"), hand_over(added, "added-ranges")
    uncovered = keep_inside(reading_only(earlier, added), added, size, keys)
    arrived = keep_inside(new, updated, size, keys)
    return kept.unionByName(uncovered).unionByName(arrived), updated
