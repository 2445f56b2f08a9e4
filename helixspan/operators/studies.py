"""Study metadata, work lists and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from helixspan.functions import ids, text
from helixspan.operators import combine

# Phenotype codes left out of biobank work lists.
BIOBANK_EXCLUDED = [
    "NEALE2_20024_",
    "NEALE2_22601_",
    "NEALE2_22617_",
    "NEALE2_22660_",
    "NEALE2_22650_",
    "NEALE2_6142_",
    "NEALE2_20079_",
    "NEALE2_20118_",
    "NEALE2_41248_",
    "NEALE2_20090_",
    "NEALE2_20095_",
    "NEALE2_2654_",
    "NEALE2_6144_",
    "NEALE2_3446_",
    "NEALE2_6141_",
    "NEALE2_6140_",
    "NEALE2_6160_",
    "NEALE2_670_",
    "NEALE2_680_",
]


def completed_studies(paths: DataFrame) -> DataFrame:
    """Distinct study ids of finished outputs in a path list."""
    return paths.select(ids.study_of_output(F.col("path")).alias("study_id")).distinct()


def completed_folders(paths: DataFrame, name: str = "out_parquet") -> DataFrame:
    """Distinct output folders of success markers in a path list."""
    return paths.select(ids.parent_folder(F.col("path")).alias(name)).distinct()


def add_sample_sizes(df: DataFrame, description: str = "sample_info") -> DataFrame:
    return df.withColumns(text.sample_sizes(F.col(description)))


def add_ancestries(df: DataFrame, description: str = "sample_info") -> DataFrame:
    return df.withColumn("ancestries", text.ancestries(F.col(description)))


def merge_metadata(current: DataFrame, previous: DataFrame, done: DataFrame) -> DataFrame:
    """Carry curation notes over, append studies that vanished, mark finished ones."""
    # A study noted twice keeps one note; rows are never multiplied.
    notes = previous.groupBy("study_id").agg(F.min("note").alias("note"))
    merged = current.join(notes, "study_id", "left")
    gone = combine.missing_rows(notes, current)
    everything = merged.unionByName(gone, allowMissingColumns=True)
    marked = done.select("study_id").distinct().withColumn("ingested", F.lit("1"))
    return everything.join(marked, "study_id", "left")


def finished_last(df: DataFrame) -> DataFrame:
    """Studies still to do first, then by note, nulls leading."""
    return df.orderBy(F.asc_nulls_first("ingested"), F.asc_nulls_first("note"))


def work_status(studies: DataFrame, manifest: DataFrame) -> DataFrame:
    """Counts of finished, wanted and excluded studies, and of manifest lines."""
    def flag(name: str):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias(name)

    zero = F.lit(0).cast("bigint")
    lines = studies.select(
        F.lit(1).alias("listed"), flag("ingested"), flag("to_ingest"), zero.alias("written")
    ).unionByName(
        manifest.select(
            F.lit(0).alias("listed"),
            zero.alias("ingested"),
            zero.alias("to_ingest"),
            F.lit(1).cast("bigint").alias("written"),
        )
    )
    total = {name: F.coalesce(F.sum(name), zero) for name in lines.columns}
    return lines.agg(
        total["ingested"].alias("n_ingested"),
        total["to_ingest"].alias("n_to_ingest"),
        (total["listed"] - total["ingested"] - total["to_ingest"]).alias("n_excluded"),
        total["written"].alias("n_written"),
        (total["to_ingest"] - total["written"]).alias("n_not_written"),
    )


def phenotype_filter(df: DataFrame, code: str, sex: str | None = None) -> DataFrame:
    """Keep plain numeric phenotype codes, for both sexes when a sex column is named."""
    kept = df.where(F.col(sex) == "both_sexes") if sex else df
    return kept.where(
        F.col(code).isNotNull() & ~F.col(code).endswith("_irnt") & F.col(code).rlike("^[0-9]")
    )


def linear_phenotypes(df: DataFrame) -> DataFrame:
    """Phenotypes of the linear-model release under common names; cases are the smaller arm."""
    smaller = F.when(
        F.col("n_cases").isNotNull() & F.col("n_controls").isNotNull(),
        F.least("n_cases", "n_controls"),
    )
    return df.select(
        F.concat(F.lit("NEALE2_"), "phenotype").alias("code"),
        F.col("description").alias("trait"),
        F.col("n_non_missing").cast("int").alias("n_total"),
        smaller.cast("int").alias("n_cases"),
    )


def mixed_phenotypes(df: DataFrame) -> DataFrame:
    """Phenotypes of the mixed-model release; numbers come with thousands separators."""
    cases = text.whole_number(F.col("Number of cases"))
    controls = text.whole_number(F.col("Number of controls"))
    return df.select(
        F.concat(F.lit("SAIGE_"), ids.dots_to_underscores(F.col("PheCode"))).alias("code"),
        F.col("Phenotype Description").alias("trait"),
        F.col("Phenotype Category").alias("trait_category"),
        cases.alias("n_cases"),
        (cases + controls).alias("n_total"),
    )


def finnish_phenotypes(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(
        F.concat(F.lit(prefix), "phenocode").alias("code"),
        F.col("phenostring").alias("trait"),
        F.col("category").alias("trait_category"),
        F.col("num_cases").cast("int").alias("n_cases"),
        (F.col("num_cases") + F.col("num_controls")).cast("int").alias("n_total"),
    )


def wanted_quantifications(
    studies: DataFrame, methods: Sequence[str] = ("ge", "microarray")
) -> DataFrame:
    return studies.where(F.col("quant_method").isin(list(methods)))


def select_studies(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Studies whose column matches a pattern (download selections)."""
    return df.where(F.col(column).rlike(pattern))
