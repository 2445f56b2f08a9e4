"""Positions in another genome build, from a table of chain blocks.

Blocks are 0-based and half-open: (chrom, t_start, t_end) in the old build,
(q_chrom, q_start, q_size, strand) in the new one, with the score of their chain.
``q_start`` of a reverse-strand block counts along the reverse strand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from helixspan.session import hand_over

TILE = 1 << 17


def _tiles(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per tile a half-open range touches."""
    return df.withColumn(
        "_tile",
        F.explode(
            F.sequence(F.floor(F.col(start) / TILE), F.floor((F.col(end) - 1) / TILE))
        ),
    )


def flatten_chain(blocks: DataFrame) -> DataFrame:
    """Non-overlapping segments, each with its best-scoring block.

    Works on the chain table alone, tile by tile, so that every position has at
    most one segment afterwards.
    """
    tiled = _tiles(blocks.where("t_end > t_start"), "t_start", "t_end").withColumns(
        {
            "_from": F.greatest(F.col("t_start"), F.col("_tile") * TILE),
            "_to": F.least(F.col("t_end"), (F.col("_tile") + 1) * TILE),
        }
    )
    cuts = (
        tiled.select("chrom", "_tile", F.explode(F.array("_from", "_to")).alias("seg_start"))
        .distinct()
        .withColumn(
            "seg_end",
            F.lead("seg_start").over(Window.partitionBy("chrom", "_tile").orderBy("seg_start")),
        )
        .where("seg_end IS NOT NULL")
    )
    best = F.max_by(
        F.struct("t_start", "q_chrom", "q_start", "q_size", "strand"),
        F.struct(F.col("chain_score"), -F.col("t_start"), F.col("q_chrom"), F.col("q_start")),
    )
    covering = (F.col("_from") <= F.col("seg_start")) & (F.col("_to") >= F.col("seg_end"))
    return (
        cuts.join(tiled, ["chrom", "_tile"])
        .where(covering)
        .groupBy("chrom", "_tile", "seg_start", "seg_end")
        .agg(best.alias("_block"))
        .select("chrom", "_tile", "seg_start", "seg_end", "_block.*")
    )


def lift(df: DataFrame, segments: DataFrame, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """Add ``chrom_b38`` and ``pos_b38`` (null when unmapped) to 1-based positions."""
    table = hand_over(segments, "segments").select(
        F.col("chrom").alias("_chrom"),
        "_tile",
        "seg_start",
        "seg_end",
        "t_start",
        F.col("q_chrom").alias("chrom_b38"),
        "q_start",
        "q_size",
        "strand",
    )
    zero_based = F.col(pos) - 1
    rows = df.withColumn("_home", F.floor(zero_based / TILE))
    joined = rows.join(
        table,
        (F.col(chrom) == F.col("_chrom"))
        & (F.col("_home") == F.col("_tile"))
        & (zero_based >= F.col("seg_start"))
        & (zero_based < F.col("seg_end")),
        "left",
    )
    along = F.col("q_start") + (zero_based - F.col("t_start"))
    lifted = F.when(F.col("strand") == "-", F.col("q_size") - 1 - along).otherwise(along) + 1
    return joined.withColumn("pos_b38", lifted.cast("int")).select(
        *df.columns, "chrom_b38", "pos_b38"
    )
