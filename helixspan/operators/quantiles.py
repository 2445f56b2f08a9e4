"""Exact medians of groups of any size.

A median as an aggregate keeps all values of a group in one task. Here equal values are
counted first, the counts are range-partitioned by group and value, every section ranks its
own values, and the counts of earlier sections are carried over; the rows at the middle
ranks are then picked. A group, or a value that most rows share, is never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from helixspan.operators.ordered import carry_in, range_sections


def medians(df: DataFrame, group: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """group columns and the median of the values that are not null, as a double.

    Of an even number of values it is the mean of the middle two. Groups without values
    are left out; null is a group of its own; NaN is the largest value.
    """
    if {value, out} & set(group):
        raise ValueError(f"{value} and {out} cannot be group columns")
    counts = (
        df.select(*group, F.col(value).alias("_value"))
        .where("_value IS NOT NULL")
        .groupBy(*group, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sections = range_sections(counts, group, ["_value"])
    carried = carry_in(
        sections,
        group,
        {
            "_before": (F.sum("_n"), F.sum("_before"), F.lit(0)),
            "_rows_all": (F.sum("_n"), F.sum("_rows_all"), F.lit(0)),
        },
    )
    along = Window.partitionBy("_section", *group).orderBy("_value")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = carried.withColumn("_last", F.col("_before") + F.sum("_n").over(upto))
    first = F.col("_last") - F.col("_n") + 1
    low, high = F.floor((F.col("_rows_all") + 1) / 2), F.floor(F.col("_rows_all") / 2) + 1
    middle = ranked.where((first <= high) & (F.col("_last") >= low))
    # One row where both middle ranks have the same value, else two.
    return middle.groupBy(*group).agg(F.avg(F.col("_value").cast("double")).alias(out))
