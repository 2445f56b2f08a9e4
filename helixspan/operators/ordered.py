"""Running aggregates over one long order, without a single-task window.

A window ordered over a whole table (or over one dominant group) is sorted and
scanned by one task. Here the rows are range-partitioned by group and order, each
partition is scanned on its own, and the partitions' totals are carried over in a
table that has one row per (partition, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from helixspan.operators.keys import same_keys
from helixspan.session import hand_over


def range_sections(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Rows in range order with the number of their section.

    The numbered rows are written down, because a second evaluation might choose
    other range bounds.
    """
    ranged = df.repartitionByRange(*group, *order)
    return hand_over(ranged.withColumn("_section", F.spark_partition_id()), "sections")


def carry_in(
    sections: DataFrame, group: Sequence[str], values: dict[str, tuple[Column, Column, Column]]
) -> DataFrame:
    """Attach aggregates over the other sections of the same group.

    ``values`` maps a new column to (aggregate within a section, aggregate over
    section results, default); names ending in ``_after`` look at later sections,
    names ending in ``_all`` at all, others at earlier ones.
    """
    per_section = sections.groupBy(*group, "_section").agg(
        *[inner.alias(name) for name, (inner, _, _) in values.items()]
    )
    along = Window.partitionBy(*group).orderBy("_section")
    back = Window.partitionBy(*group).orderBy(F.desc("_section"))
    frames = {
        "after": back.rowsBetween(Window.unboundedPreceding, -1),
        "all": along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing),
    }
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_section.select(
        *group,
        "_section",
        *[
            F.coalesce(outer.over(frames.get(name.rsplit("_", 1)[-1], before)), default).alias(name)
            for name, (_, outer, default) in values.items()
        ],
    )
    keys = [*group, "_section"]
    return (
        sections.alias("r")
        .join(carried.alias("c"), same_keys("r", "c", keys))
        .select("r.*", *[f"c.{name}" for name in values])
    )


def running_sum(
    df: DataFrame, order: Sequence[Column | str], value: str, out: str, rank: str | None = None
) -> DataFrame:
    """Cumulative sum (and position) of ``value`` over the whole table in ``order``."""
    sections = range_sections(df, [], order)
    carried = carry_in(
        sections,
        [],
        {
            "_sum_before": (F.sum(value), F.sum("_sum_before"), F.lit(0)),
            "_rows_before": (F.count(F.lit(1)), F.sum("_rows_before"), F.lit(0)),
        },
    )
    along = Window.partitionBy("_section").orderBy(*order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = carried.withColumn(out, F.col("_sum_before") + F.sum(value).over(upto))
    if rank:
        result = result.withColumn(rank, F.col("_rows_before") + F.row_number().over(along))
    return result.drop("_section", "_sum_before", "_rows_before")
