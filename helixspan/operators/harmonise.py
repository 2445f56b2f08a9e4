"""Bringing variants to the reference panel: frequencies, allele order, builds, ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from helixspan.functions import stats
from helixspan.session import hand_over

VARIANT = ("chrom", "pos", "ref", "alt")


def panel_sites(
    panel: DataFrame,
    build: str = "b38",
    keep: Sequence[str] = (),
    known_only: bool = True,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """(chrom, pos, ref, alt, gnomad_nfe and ``keep``), one row per variant.

    Variants without a frequency are left out unless ``known_only`` is false: where the
    panel only gives alleles and positions they take part, and are counted as tests.
    ``wanted`` has the only variants to be looked up. Only one field of the nested ``af``
    struct is read. The table is written down: it serves several joins, and a join whose
    other side is a plain scan is one that AQE can split when very many rows share a
    variant. A panel that ``jobs.prepare_panel`` wrote has this form already and is taken
    as it is.
    """
    values = ["gnomad_nfe", *keep]
    if set(panel.columns) >= {*VARIANT, *values}:
        ready = panel.select(*VARIANT, *values)
        return ready.dropna(subset=["gnomad_nfe"]) if known_only else ready
    known = panel.select(
        F.col(f"chrom_{build}").alias("chrom"),
        F.col(f"pos_{build}").alias("pos"),
        "ref",
        "alt",
        F.col("af.gnomad_nfe").alias("gnomad_nfe"),
        *keep,
    ).dropna(subset=[*VARIANT, *["gnomad_nfe"] * known_only])
    if wanted is not None:
        known = known.join(wanted.select(*VARIANT).distinct(), list(VARIANT), "left_semi")
    if not keep:
        once = known.groupBy(*VARIANT).agg(F.min("gnomad_nfe").alias("gnomad_nfe"))
    else:
        first = F.min(F.struct(F.col("gnomad_nfe").isNull().alias("_unknown"), *values))
        grouped = known.groupBy(*VARIANT).agg(first.alias("_site"))
        once = grouped.select(*VARIANT, "_site.*").drop("_unknown")
    return hand_over(once, "panel")


def fill_eaf(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Take a missing effect-allele frequency from the panel sites.

    Only rows without a frequency are joined; the others pass by without a shuffle.
    """
    looked_up = (
        df.where(F.col("eaf").isNull())
        .join(sites.select(*VARIANT, "gnomad_nfe"), list(VARIANT), "left")
        .withColumn("eaf", F.col("gnomad_nfe"))
    )
    return df.where(F.col("eaf").isNotNull()).unionByName(looked_up.select(df.columns))


def in_panel(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows whose variant is among the panel sites, with the sites' columns."""
    return df.join(sites, list(VARIANT))


def align_alleles(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Match variants by position and allele pair in either order.

    Both sides carry the pair in sorted order, so this is one equi-join instead of an OR
    condition per position. The sites supply ref, alt and their other columns.
    Strand-ambiguous pairs are kept.
    """
    pair = [F.col("effect_allele"), F.col("other_allele")]
    rows = df.where(pair[0].isNotNull() & pair[1].isNotNull()).withColumns(
        {"_low": F.least(*pair), "_high": F.greatest(*pair)}
    )
    either = sites.where("ref <> alt").withColumns(
        {"_low": F.least("ref", "alt"), "_high": F.greatest("ref", "alt")}
    )
    return rows.join(either, ["chrom", "pos", "_low", "_high"]).drop("_low", "_high")


def orient(df: DataFrame, *effects: str) -> DataFrame:
    """Flip the given effects where the effect allele is the reference allele."""
    return df.withColumns(
        {
            name: stats.flip_sign(F.col(name), F.col("effect_allele"), F.col("ref"))
            for name in effects
        }
    )


def to_new_build(df: DataFrame) -> DataFrame:
    """Replace chrom and pos by their ``_b38`` counterparts."""
    return df.drop("chrom", "pos").withColumnsRenamed({"chrom_b38": "chrom", "pos_b38": "pos"})


def attach_by_variant(
    df: DataFrame,
    table: DataFrame,
    columns: Sequence[str],
    how: str = "inner",
    on: Sequence[str] = VARIANT,
) -> DataFrame:
    """Add annotation columns (rsid, info, ...) by variant."""
    return df.join(table.select(*on, *columns), list(on), how)


def drop_rsid_copies(df: DataFrame, rsid: str = "rsid") -> DataFrame:
    """One row for rows that differ in nothing but their rsid."""
    return df.drop(rsid).distinct()


def copy_counts(df: DataFrame, file_column: str, rsid: str = "rsid") -> DataFrame:
    """Rows per file before and after removing rsid copies.

    Copies collapse in the first, partially combined, aggregation.
    """
    columns = [c for c in df.columns if c not in (file_column, rsid)]
    once = df.groupBy(file_column, *columns).agg(F.count(F.lit(1)).alias("_copies"))
    return once.groupBy(file_column).agg(
        F.sum("_copies").alias("n_raw"), F.count(F.lit(1)).alias("n_dedup")
    )


def split_alternatives(sites: DataFrame, alts: str = "alts") -> DataFrame:
    """One row per alternative allele of multi-allelic sites."""
    one_each = sites.withColumn("alt", F.explode(F.split(alts, ",")))
    return one_each.drop(alts).distinct()


def site_list(*tables: DataFrame, columns: Sequence[str] = VARIANT) -> DataFrame:
    """Distinct variants over several exported tables."""
    first, *others = [t.select(*columns) for t in tables]
    for table in others:
        first = first.unionByName(table)
    return first.distinct()
