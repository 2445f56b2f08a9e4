"""Windows around significant variants: building, merging and applying them.

Positions are grouped into tiles of ``2 * width + 1`` bases. Two hits in one tile
are never further apart than ``2 * width``, so their windows always overlap and a
tile can be reduced to its first and last hit before anything is shuffled. What
remains per (study, phenotype, bio_feature, chrom) is at most one row per tile of
the chromosome, however many significant rows one study contributes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from helixspan.operators.keys import same_keys
from helixspan.session import hand_over

KEYS = ("study_id", "phenotype_id", "bio_feature", "chrom")
# Rows without these belong to no window.
_REQUIRED = ("study_id", "chrom", "pos", "_tile")
#: Rows that a task sorts into frames, about.
ROWS_PER_TASK = 1_000_000


def _shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def significant(data_type: str, pval: float = 5e-8) -> Column:
    """Fixed threshold for GWAS, Bonferroni over the tests of the gene for molecular traits."""
    if data_type == "gwas":
        return F.col("pval") <= F.lit(float(pval))
    if data_type == "molecular_trait":
        return F.col("pval") <= F.try_divide(F.lit(0.05), F.col("num_tests"))
    raise ValueError(f"unknown data type: {data_type}")


def _tile(position: Column | str, size: int) -> Column:
    column = F.col(position) if isinstance(position, str) else position
    return F.floor(column / F.lit(size))


def merge_windows(hits: DataFrame, width: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Merged intervals [pos - width, pos + width]; touching ones join, starts stop at 0."""
    size = 2 * width + 1
    placed = hits.dropna(subset=[c for c in _REQUIRED if c in hits.columns])
    tiles = placed.groupBy(*keys, _tile("pos", size).alias("_tile")).agg(
        F.min("pos").alias("_first"), F.max("pos").alias("_last")
    )
    along = Window.partitionBy(*keys).orderBy("_tile")
    gap = F.col("_first") - F.lag("_last").over(along)
    islands = tiles.withColumn("_gap", gap).withColumn(
        "_island",
        F.count_if(F.col("_gap") > 2 * width).over(
            along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    merged = islands.groupBy(*keys, "_island").agg(
        F.greatest(F.min("_first") - F.lit(width), F.lit(0)).alias("start"),
        (F.max("_last") + F.lit(width)).alias("end"),
    )
    return merged.select(*keys, "start", "end")


def keep_inside(
    df: DataFrame, intervals: DataFrame, tile_size: int, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Rows of ``df`` inside any interval of the same keys.

    Intervals are cut into the tiles they touch, which turns the range condition
    into an equi-join on (keys, tile) with the bounds as residual: merged windows
    leave at most two candidates per tile. It is a plain semi join, so Spark
    broadcasts the interval side if its size allows and otherwise shuffles by
    (keys, tile), where a dominant study is spread over its tiles and AQE may split
    any tile that is still too large.
    """
    pieces = intervals.withColumn(
        "_tile",
        F.explode(F.sequence(_tile("start", tile_size), _tile("end", tile_size))),
    )
    rows = df.withColumn("_tile", _tile("pos", tile_size)).alias("rows")
    condition = (
        same_keys("rows", "iv", [*keys, "_tile"], _REQUIRED)
        & (F.col("rows.pos") >= F.col("iv.start"))
        & (F.col("rows.pos") <= F.col("iv.end"))
    )
    return rows.join(pieces.alias("iv"), condition, "left_semi").drop("_tile")


def extract_windows(
    df: DataFrame,
    width: int = 2_000_000,
    data_type: str = "gwas",
    pval: float = 5e-8,
    keys: Sequence[str] = KEYS,
) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, merged intervals) for one data set."""
    hits = df.where(significant(data_type, pval)).select(*keys, "pos")
    intervals = hand_over(merge_windows(hits, width, keys), "intervals")
    return keep_inside(df, intervals, 2 * width + 1, keys), intervals


def keep_near(
    df: DataFrame,
    hits: DataFrame,
    distance: int,
    keys: Sequence[str] = KEYS,
    distinct: bool = True,
) -> DataFrame:
    """Rows at most ``distance`` away from a hit of the same keys, without merging first.

    Tiles are ``distance`` wide, so only the first and last hit of a row's own and the two
    neighbouring tiles can decide about it.
    """
    size = max(distance, 1)
    nearest = hits.groupBy(*keys, _tile("pos", size).alias("_home")).agg(
        F.min("pos").alias("_first"), F.max("pos").alias("_last")
    )
    reach = nearest.withColumn(
        "_tile", F.explode(F.sequence(F.col("_home") - 1, F.col("_home") + 1))
    )
    rows = df.withColumn("_tile", _tile("pos", size)).alias("rows")
    condition = (
        same_keys("rows", "hit", [*keys, "_tile"], _REQUIRED)
        & (F.col("rows.pos") >= F.col("hit._first") - F.lit(distance))
        & (F.col("rows.pos") <= F.col("hit._last") + F.lit(distance))
    )
    kept = rows.join(hand_over(reach, "hits").alias("hit"), condition, "left_semi").drop("_tile")
    return kept.distinct() if distinct else kept


def keep_near_by_frame(
    df: DataFrame, hit: Column, distance: int, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The same rows from window functions: nearest hit before and after each position.

    Rows are first reduced to one per position, so copies and many alleles at one
    site count once; hits are lent to the neighbouring tiles, so every frame is
    complete within its tile and no group holds more than three rows per base. Both
    frames only grow (a range frame would be rescanned for every row). Rows are dealt by
    tile before they are reduced, to as many tasks as their number asks for: positions
    hardly repeat within a task of the scan, whose table of them would be as large as
    what it reads.
    """
    size = max(distance, 1)
    found, home = F.coalesce(hit, F.lit(False)), _tile("pos", size)
    lent = F.when(found, F.array(home - 1, home, home + 1)).otherwise(F.array(home))
    n_tasks = max(_shuffle_tasks(df.sparkSession), -(-df.count() // ROWS_PER_TASK))
    dealt = df.select(*keys, "pos", found.alias("_found"), F.explode(lent).alias("_tile"))
    # One column, as Spark drops constant keys and would then deal the rows a second time.
    within = ["_cell", *keys, "_tile"]
    spots = (
        dealt.withColumn("_cell", F.xxhash64(*keys, "_tile"))
        .repartition(n_tasks, "_cell")
        .groupBy(*within, "pos")
        .agg(F.bool_or("_found").alias("_hit"))
    )
    upto = (Window.unboundedPreceding, Window.currentRow)
    forward = Window.partitionBy(*within).orderBy("pos").rowsBetween(*upto)
    backward = Window.partitionBy(*within).orderBy(F.desc("pos")).rowsBetween(*upto)
    hit_pos = F.when(F.col("_hit"), F.col("pos"))
    near = (
        spots.withColumn("_before", F.max(hit_pos).over(forward))
        .withColumn("_after", F.min(hit_pos).over(backward))
        .where(F.col("_tile") == home)
        .where(
            (F.col("pos") - F.col("_before") <= distance)
            | (F.col("_after") - F.col("pos") <= distance)
        )
        .select(*keys, "pos")
    )
    return df.alias("rows").join(
        near.alias("near"), same_keys("rows", "near", [*keys, "pos"], _REQUIRED), "left_semi"
    )


def partition_plan(intervals: DataFrame, per_partition: int = 10) -> DataFrame:
    """Intervals, bio_features and the output partition count they suggest (at least 1)."""
    counts = intervals.agg(
        F.count(F.lit(1)).alias("n_intervals"),
        (
            F.count_distinct("bio_feature")
            + F.max(F.when(F.col("bio_feature").isNull(), 1).otherwise(0))
        ).alias("n_features"),
    )
    per_feature = F.col("n_intervals") / F.greatest(F.coalesce("n_features", F.lit(1)), F.lit(1))
    return counts.select(
        "n_intervals",
        F.coalesce("n_features", F.lit(0)).cast("bigint").alias("n_features"),
        F.greatest(F.ceil(per_feature / F.lit(per_partition)), F.lit(1))
        .cast("int")
        .alias("n_partitions"),
    )
