"""Chain files: alignments of two genome builds as text.

A chain is a header line and one line per block: its size and the gaps to the next block
in the old and the new build; the last block has its size alone. Where a block lies follows
from all blocks before it.

The text is cut at the start of a header, so that a row is a whole chain whatever task its
lines fall into; block positions are running sums within the chain. One chain is one row
and one window: at most a few megabytes, as a chain lies within one chromosome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from helixspan.sources.readers import Paths

_NEXT_HEADER = "\nchain "
# Fields of a header line behind the word "chain".
_HEADER = (
    "score", "t_name", "t_size", "t_strand", "t_from", "t_to",
    "q_name", "q_size", "q_strand", "q_from", "q_to",
)


def read_chain(spark: SparkSession, paths: Paths) -> DataFrame:
    """Blocks as ``liftover.flatten_chain`` takes them: 0-based, half-open, with their chain's
    score; a leading ``chr`` of the old build's names is dropped.

    Lines that start with # are comments. A chain whose blocks do not end where its header
    says (a truncated file, say) fails the job.
    """
    texts = spark.read.option("lineSep", _NEXT_HEADER).text(paths)
    lines = F.filter(
        F.split(F.regexp_replace(F.replace("value", F.lit("\r"), F.lit("")), r"^\s*chain\s+", ""), "\n"),
        lambda line: (F.trim(line) != "") & ~line.startswith("#"),
    )
    chains = texts.select(F.monotonically_increasing_id().alias("_chain"), lines.alias("_lines"))
    chains = chains.where(F.size("_lines") > 0)
    fields = F.split(F.trim(F.element_at("_lines", 1)), r"\s+")
    named = chains.select(
        "_chain",
        "_lines",
        *[F.get(fields, i).alias(name) for i, name in enumerate(_HEADER)],
    )
    numbers = ("t_size", "t_from", "t_to", "q_size", "q_from", "q_to")
    # A header alone has one empty block, which does not end where it should.
    rest = F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(1)))
    rest = F.when(F.size("_lines") > 1, rest).otherwise(F.array(F.lit("")))
    blocks = named.select(
        "_chain",
        F.col("score").try_cast("double").cast("long").alias("chain_score"),
        "t_name", "q_name", "q_strand",
        *[F.col(c).try_cast("long").alias(c) for c in numbers],
        F.size("_lines").alias("_n_lines"),
        F.posexplode(rest).alias("_i", "_line"),
    )
    parts = F.split(F.trim("_line"), r"\s+")
    sized = blocks.withColumns(
        {
            "_size": F.get(parts, 0).try_cast("long"),
            "_t_gap": F.coalesce(F.get(parts, 1).try_cast("long"), F.lit(0)),
            "_q_gap": F.coalesce(F.get(parts, 2).try_cast("long"), F.lit(0)),
        }
    )
    before = Window.partitionBy("_chain").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)

    def offset(gap: str) -> Column:
        return F.coalesce(F.sum(F.col("_size") + F.col(gap)).over(before), F.lit(0))

    placed = sized.withColumns(
        {"t_start": F.col("t_from") + offset("_t_gap"), "q_start": F.col("q_from") + offset("_q_gap")}
    )
    t_end, q_end = F.col("t_start") + F.col("_size"), F.col("q_start") + F.col("_size")
    whole = F.coalesce((t_end == F.col("t_to")) & (q_end == F.col("q_to")), F.lit(False))
    broken = F.concat(F.lit("chain does not end where its header says: "), F.concat_ws(" ", "t_name", "t_from", "q_name", "q_from"))
    ends = F.col("_i") == F.greatest(F.col("_n_lines") - 2, F.lit(0))
    return placed.select(
        F.regexp_replace("t_name", "^chr", "").alias("chrom"),
        F.col("t_start").cast("int").alias("t_start"),
        F.when(ends & ~whole, F.raise_error(broken)).otherwise(t_end).cast("int").alias("t_end"),
        F.col("q_name").alias("q_chrom"),
        F.col("q_start").cast("int").alias("q_start"),
        F.col("q_size").cast("int").alias("q_size"),
        F.col("q_strand").alias("strand"),
        "chain_score",
    )
