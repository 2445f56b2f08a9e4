"""Mixing sources to target weights.

Words are summed per source, the targets follow from weights and a cap, and a document
is emitted floor(rate) times plus once more with probability equal to the fraction. The
draw is a hash of the document's id and the seed, so reruns and lost tasks agree.

Defined cases: a null text has no words; a null source is a source of its own and comes
last; a source without words has target 0; rows with the same id draw alike; an empty
table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixspan.llm.texts import WORD, boxed, in_box, unboxed
from helixspan.operators.ordered import running_sum
from helixspan.session import hand_over

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MAX_RATE = 3
SEED = 0


def size_of(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of a hash of id and seed."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":mix:{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size) -> also target.

    The shares are weight / open weights of what is left; sources above their cap are
    set to it and the excess is shared again. Each round closes at least one source or
    ends. Only three sums per round reach the driver, however many sources there are.
    """
    ranked = hand_over(
        running_sum(
            sizes,
            [F.col("source").isNull(), F.col("source")],
            "source_size",
            "_upto",
            rank="_rank",
        ).drop("_upto"),
        "sources",
    )
    weight = F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]),
        ((F.col("_rank") - 1) % len(weights) + 1).cast("int"),
    )
    cap = F.col("source_size") * max_rate
    weighed = ranked.withColumns({"_weight": weight, "_cap": cap})
    total, left, open_weight, closed = None, 0, 0, -1
    while True:
        is_open = (
            F.lit(True)
            if total is None
            else F.lit(left) * F.col("_weight") < F.col("_cap") * F.lit(open_weight)
        )
        row = weighed.agg(
            F.sum("source_size"),
            F.sum(F.when(~is_open, F.col("_cap"))),
            F.sum(F.when(is_open, F.col("_weight"))),
            F.count(F.when(~is_open, 1)),
        ).first()
        total = row[0] or 0
        if row[3] == closed:
            break
        closed, left, open_weight = row[3], total - (row[1] or 0), row[2] or 0
        if not open_weight:
            break
    share = (F.lit(left) * F.col("_weight")).cast("double") / float(max(open_weight, 1))
    below = F.lit(left) * F.col("_weight") < F.col("_cap") * F.lit(open_weight)
    target = F.when(F.lit(open_weight > 0) & below, share).otherwise(F.col("_cap").cast("double"))
    return weighed.select("source", "source_size", target.alias("target"))


def with_copies(
    docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED
) -> DataFrame:
    """One row per document: the struct ``row`` with its columns, size, source_size, target, copies."""
    names = docs.columns
    sized = boxed(docs).select(
        "row",
        in_box(names, "doc_id").alias("_id"),
        in_box(names, "source").alias("_source"),
        size_of(in_box(names, "text")).alias("size"),
    )
    sizes = hand_over(
        sized.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size")),
        "source-sizes",
    )
    targets = hand_over(source_targets(sizes, weights, max_rate), "targets")
    rate = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    extra = uniform(F.col("_id"), seed) < rate - F.floor(rate)
    copies = F.coalesce(F.floor(rate) + extra.cast("long"), F.lit(0))
    return (
        sized.join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .select("row", "size", "source_size", "target", copies.alias("copies"))
    )


def mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as drawn, with the columns of ``docs``."""
    drawn = with_copies(docs, weights, max_rate, seed)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    emitted = drawn.where(F.col("copies") > 0).select("row", times.alias("copy"))
    return unboxed(emitted, docs.columns)


def mix_summary(docs: DataFrame, **options) -> DataFrame:
    """Per document what the mix takes of it."""
    names = docs.columns
    return with_copies(docs, **options).select(
        in_box(names, "doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


#: DuckDB SQL for mix_summary with the default parameters.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source
), k AS (
  SELECT *, 3 * source_size AS cap, 3e0 * source_size / w AS ratio,
         sum(source_size) OVER () AS total FROM s
), p AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS below,
    sum(w) OVER (ORDER BY ratio RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM k
), c AS (
  SELECT CAST(total - below AS BIGINT) AS remaining, CAST(open_w AS BIGINT) AS open_w
  FROM p WHERE (total - below) * w < cap * open_w ORDER BY ratio LIMIT 1
), t AS (
  SELECT k.source, k.source_size,
    CASE WHEN c.open_w IS NOT NULL AND c.remaining * k.w < k.cap * c.open_w
         THEN CAST(c.remaining * k.w AS DOUBLE) / c.open_w ELSE CAST(k.cap AS DOUBLE) END AS target
  FROM k LEFT JOIN c ON true
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.target / nullif(t.source_size, 0) AS rate,
    CAST(('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':mix:0'), 1, 13)) AS BIGINT)
      / 4503599627370496e0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(coalesce(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 0) AS BIGINT) * size AS taken
FROM r
"""
