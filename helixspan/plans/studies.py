"""Study metadata table and the manifests of all sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from helixspan.functions import ids, text
from helixspan.operators import combine, qc, studies


def available_studies(paths: DataFrame) -> DataFrame:
    """Delivered files with the study of their folder."""
    return paths.withColumn("study_id", ids.path_segment(F.col("gwascat_path"), 2)).where(
        F.col("study_id").startswith("GCST")
    )


def metadata_table(
    paths: DataFrame, study_table: DataFrame, previous: DataFrame, completed: DataFrame
) -> DataFrame:
    """One row per available study with sample sizes, ancestries and curation notes.

    ``paths`` lists delivered files (``gwascat_path``), ``study_table`` has study_id,
    pmid, trait and sample_info, ``previous`` the notes of the last curation and
    ``completed`` finished outputs.
    """
    described = studies.add_sample_sizes(
        qc.complete(available_studies(paths).join(study_table, "study_id", "left"))
    )
    unique = combine.drop_repeated_ids(described)
    done = completed.select(ids.accession(F.col("path")).alias("study_id"))
    merged = studies.merge_metadata(unique, previous, done)
    labelled = studies.add_ancestries(merged).withColumn("to_ingest", F.lit(""))
    last = ["to_ingest", "ancestries", "note"]
    return studies.finished_last(
        labelled.select(*[c for c in labelled.columns if c not in last], *last)
    )


def _outputs(folder: str, study: Column) -> Column:
    return F.concat(F.lit(folder), study, F.lit(".parquet"))


def gwas_manifest(
    metadata: DataFrame, inputs: DataFrame, completed: DataFrame,
    in_root: str, in_af: str, out_root: str, log_root: str,
) -> DataFrame:
    """Work list of wanted, unfinished studies whose input file exists."""
    wanted = metadata.where(F.col("to_ingest").try_cast("double") > 0)
    todo = combine.not_done(wanted, studies.completed_studies(completed))
    lines = todo.select(
        F.concat(F.lit(in_root), ids.base_name(F.col("gwascat_path"))).alias("in_tsv"),
        F.lit(in_af).alias("in_af"),
        _outputs(out_root, F.col("study_id")).alias("out_parquet"),
        "study_id",
        text.total_ignoring_nulls(*[F.col(c) for c in ("n_cases", "n_controls", "n_quant")])
        .cast("int")
        .alias("n_total"),
        F.col("n_cases").cast("int").alias("n_cases"),
        F.concat(F.lit(log_root), "study_id", F.lit(".log")).alias("log"),
    )
    return combine.existing_only(lines, inputs, "in_tsv")


def _unfinished(lines: DataFrame, completed: DataFrame) -> DataFrame:
    return combine.not_done(lines, studies.completed_folders(completed), "out_parquet")


def finnish_manifest(
    phenotypes: DataFrame, paths: DataFrame, completed: DataFrame,
    prefix: str, marker: str, out_root: str,
) -> DataFrame:
    """Work list of one endpoint release: files matched with their endpoint."""
    files = paths.select(
        F.col("path").alias("in_tsv"),
        ids.code_after(F.col("path"), marker, prefix).alias("code"),
    )
    lines = files.join(studies.finnish_phenotypes(phenotypes, prefix), "code").select(
        "in_tsv",
        _outputs(out_root, F.col("code")).alias("out_parquet"),
        F.col("code").alias("study_id"),
        "n_total",
        "n_cases",
    )
    return _unfinished(lines, completed)


def biobank_phenotypes(
    paths: DataFrame, linear: DataFrame, mixed: DataFrame
) -> DataFrame:
    """Files of both biobank releases with their phenotype, unwanted codes removed."""
    files = paths.select(ids.glob_of_split(F.col("path")).alias("in_path")).withColumn(
        "code", ids.biobank_code(F.col("in_path"))
    )
    phenotypes = combine.union_all(
        [studies.linear_phenotypes(linear), studies.mixed_phenotypes(mixed)], True
    )
    joined = files.join(phenotypes, "code", "left")
    return combine.without_prefixes(joined, "code", studies.BIOBANK_EXCLUDED)


def biobank_manifest(
    phenotypes: DataFrame, completed: DataFrame, in_af: str, out_root: str
) -> DataFrame:
    lines = phenotypes.select(
        F.col("in_path").alias("in_tsv"),
        F.lit(in_af).alias("in_af"),
        _outputs(out_root, F.col("code")).alias("out_parquet"),
        F.col("code").alias("study_id"),
        "n_total",
        "n_cases",
    )
    return _unfinished(lines, completed)


def eqtl_manifest(
    table: DataFrame, completed: DataFrame, in_root: str, out_root: str
) -> DataFrame:
    """Whole-gene expression studies; one project gets a distinguishing name."""
    study = F.when(F.col("study") == "GTEx", F.lit("GTEx-eQTL")).otherwise(F.col("study"))
    lines = studies.wanted_quantifications(table).select(
        study.alias("study_id"),
        F.upper("qtl_group").alias("qtl_group"),
        F.upper("quant_method").alias("quant_method"),
        F.concat(F.lit(in_root), ids.base_name(F.col("ftp_path"))).alias("in_nominal"),
        _outputs(out_root, study).alias("out_parquet"),
    )
    return _unfinished(lines, completed)


def tissues_of_files(paths: DataFrame, suffix: str) -> DataFrame:
    """Tissues (``qtl_group``) that have files named tissue + ``suffix``, a pattern with stars."""
    name = ids.base_name(F.col("path"))
    fixed = [re.escape(part) for part in suffix.split("*")]
    tissue = F.regexp_extract(name, f"^(.+?){'.*'.join(fixed)}$", 1)
    return paths.select(tissue.alias("qtl_group")).where("qtl_group <> ''").distinct()


def sqtl_manifest(
    tissues: DataFrame, study_id: str, in_root: str, suffix: str,
    in_panel: str, out_root: str, log_root: str,
) -> DataFrame:
    """One line per tissue, all writing to the same data set."""
    tissue = F.col("qtl_group")
    return tissues.select(
        F.lit(study_id).alias("study_id"),
        tissue,
        F.concat(F.lit(in_root), tissue, F.lit(suffix)).alias("in_nominal"),
        F.lit(in_panel).alias("in_varindex"),
        _outputs(out_root, F.lit(study_id)).alias("out_parquet"),
        F.concat(F.lit(f"{log_root}{study_id}_"), tissue, F.lit(".txt")).alias("out_log"),
    )


def window_jobs(paths: DataFrame, completed: DataFrame) -> DataFrame:
    """Data sets still to be cut to windows, with their kind and study."""
    listed = paths.select(ids.parent_folder(F.col("path")).alias("in_path")).select(
        "in_path",
        ids.data_type_of_path(F.col("in_path")).alias("data_type"),
        ids.base_name(F.col("in_path")).alias("study"),
    )
    done = completed.select(
        ids.base_name(ids.parent_folder(F.col("path"))).alias("study")
    ).distinct()
    return combine.not_done(listed, done, "study")
