"""Physical layout of outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Columns that separate rows at one position; they only decide ties.
_TIE_BREAK = ("study_id", "phenotype_id", "bio_feature", "ref", "alt", "variant_id")
# Names that chromosome and position have in unified and exported tables.
_PLACES = ("chrom", "pos", "chromosome", "base_pair_location")


def by_position(
    df: DataFrame, partitions: int | None = None, chrom: str = "chrom", pos: str = "pos"
) -> DataFrame:
    """Range-partition by position and sort inside partitions.

    Rows are ordered by (chrom, pos) overall; further key columns let the range
    bounds cut through positions that very many studies share.
    """
    ties = [c for c in _TIE_BREAK if c in df.columns and c not in (chrom, pos)]
    bounds = [chrom, pos, *ties]
    ranged = (
        df.repartitionByRange(partitions, *bounds) if partitions else df.repartitionByRange(*bounds)
    )
    return ranged.sortWithinPartitions(chrom, pos)


def by_folder_and_position(df: DataFrame, folders: list[str]) -> DataFrame:
    """Layout for folder-partitioned output: folder columns lead the range order.

    A task then writes few folders, and a large folder is shared by several tasks. Tables
    without a position are cut by a hash of the row instead.
    """
    ties = [c for c in _TIE_BREAK if c in df.columns]
    place = [c for c in _PLACES if c in df.columns]
    order = list(dict.fromkeys([*folders, *place]))
    bounds = list(dict.fromkeys([*order, *ties]))
    if not place:
        return df.repartitionByRange(*folders, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    return df.repartitionByRange(*bounds).sortWithinPartitions(*order)


#: Bytes of the sources per task that rows are dealt to by folder, and of a task's rows above
#: which their folders are shared by several tasks.
FOLDER_BYTES, SHARED_BYTES = 4 << 20, 64 << 20
#: Tasks at most, if the session does not ask for more: of up to 2000 Spark knows the exact sizes.
FOLDER_TASKS = 2000


def by_folder(df: DataFrame, folder: str) -> DataFrame:
    """Layout for text in folders: all rows of a folder in one task, in order of position.

    A folder lies in several tasks only if it has very many rows, which Spark finds out from
    what the tasks before have written. So the rows are made once, while the bounds of ranges
    are sampled from rows made for that alone.
    """
    place = [c for c in _PLACES if c in df.columns]
    dealt = df.hint("rebalance", folder_tasks(df), F.col(f"`{folder}`"))
    name = F.col(f"`{folder}`").cast("string")
    return dealt.sortWithinPartitions(name, *[c for c in place if c != folder])


def folder_tasks(df: DataFrame) -> int:
    """Tasks to deal rows to by folder, from the stored size of what they are made of."""
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))
    return max(asked, min(FOLDER_TASKS, size // FOLDER_BYTES))


def integer_mac(df: DataFrame) -> DataFrame:
    """Minor allele count as an integer, as molecular tables declare it."""
    return df.withColumn("mac", df["mac"].cast("int"))
