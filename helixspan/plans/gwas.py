"""GWAS ingest: from delivered summary statistics to the unified GWAS table.

All studies of a delivery go through one job. What differs per study (sample
sizes) comes from a study table instead of command-line arguments.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from helixspan.functions import stats, tails
from helixspan.operators import harmonise, qc
from helixspan.schema import GWAS_SCHEMA, conform
from helixspan.session import hand_over, tidy
from helixspan.sources import readers, sinks

# Columns a usable row must have before frequencies are filled in.
REQUIRED = ["chrom", "pos", "ref", "alt", "pval", "beta", "se"]


def _finish(usable: DataFrame, studies: DataFrame, min_mac: float) -> DataFrame:
    sizes = studies.select(
        "study_id", F.col("n_total").cast("int"), F.col("n_cases").cast("int")
    )
    sized = usable.join(hand_over(sizes, "study-sizes"), "study_id")
    kept = qc.gwas_count_filter(qc.add_gwas_counts(sized), min_mac)
    return conform(_labelled(kept), GWAS_SCHEMA)


def _labelled(kept: DataFrame) -> DataFrame:
    return kept.withColumns(
        {
            "type": F.lit("gwas"),
            "pval": stats.floor_p(F.col("pval")),
            "is_cc": F.col("n_cases").isNotNull(),
            "phenotype_id": F.lit(None),
            "bio_feature": F.lit(None),
            "gene_id": F.lit(None),
        }
    )


def standardise(
    rows: DataFrame,
    studies: DataFrame,
    panel: DataFrame,
    min_rows: int = 10000,
    min_mac: float = 10,
) -> DataFrame:
    """Unified GWAS rows from mapped ones (``study_id`` plus the mapped columns).

    Odds ratios become effects, missing standard errors and frequencies are filled
    in, studies that are too small and variants that are too rare are dropped. The
    delivery is parsed once; counting, the frequency lookup and the output then read
    the usable rows as columns.
    """
    effects = stats.odds_to_effect(rows)
    complete = qc.complete(effects, [c for c in REQUIRED if c != "se"])
    usable = hand_over(complete.where(stats.has_or_gets_se()), "usable-rows")
    gated = qc.min_rows_gate(usable, min_rows)
    sites = harmonise.panel_sites(panel, wanted=gated.where(F.col("eaf").isNull()))
    filled = qc.complete(harmonise.fill_eaf(gated, sites), ["eaf"])
    return _finish(tails.impute_se(filled), studies, min_mac)


def standardise_logged(
    rows: DataFrame,
    studies: DataFrame,
    panel: DataFrame | None,
    min_rows: int = 10000,
    min_mac: float = 10,
) -> tuple[DataFrame, DataFrame]:
    """The result of ``standardise`` (``standardise_complete`` without panel) and its report.

    The delivery is scanned once and joined with the panel once: rows are written with the
    step they fail at, which the report counts from that column and the result filters on.
    """
    effects = stats.odds_to_effect(rows) if panel is not None else rows
    needed = [c for c in REQUIRED if panel is None or c != "se"] + ["eaf"] * (panel is None)
    ready = qc.all_of([qc.present(F.col(c)) for c in needed])
    if panel is not None:
        ready = ready & stats.has_or_gets_se()
    marked = hand_over(effects.withColumn("_ready", F.coalesce(ready, F.lit(False))), "usable-rows")
    counts = hand_over(
        marked.groupBy("study_id").agg(F.count(F.lit(1)).alias("input"), F.count_if("_ready").alias("ready")),
        "usable-counts",
    )
    large = counts.where(F.col("ready") >= min_rows).select("study_id")
    gated = marked.where("_ready").drop("_ready").join(large, "study_id", "left_semi")
    if panel is not None:
        sites = harmonise.panel_sites(panel, wanted=gated.where(F.col("eaf").isNull()))
        gated = tails.impute_se(harmonise.fill_eaf(gated, sites))
    sizes = studies.select("study_id", F.col("n_total").cast("int"), F.col("n_cases").cast("int"))
    sized = qc.add_gwas_counts(gated.join(hand_over(sizes, "study-sizes"), "study_id"))
    (_, has_frequency), (_, enough) = qc_steps(min_mac)[1:]
    failed = F.when(~has_frequency, 1).when(~F.coalesce(enough, F.lit(False)), 2).otherwise(0)
    done = hand_over(sized.withColumn("_failed", failed), "checked-rows")
    later = done.groupBy("study_id").agg(
        F.count_if(F.col("_failed") != 1).alias("frequent"), F.count_if(F.col("_failed") == 0).alias("kept")
    )
    left = counts.join(hand_over(later, "checked-counts"), "study_id", "left")
    steps = [
        ("input", F.col("input")),
        ("required columns", F.col("ready")),
        ("enough rows", F.when(F.col("ready") >= min_rows, F.col("ready")).otherwise(0)),
        ("allele frequency", F.coalesce("frequent", F.lit(0))),
        ("minor allele count", F.coalesce("kept", F.lit(0))),
    ]
    each = F.array(
        *[F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), c.cast("long").alias("n_rows")) for i, (n, c) in enumerate(steps)]
    )
    report = qc.with_removed(left.select("study_id", F.inline(each)), ["study_id"])
    kept = done.where("_failed = 0").drop("_failed")
    return conform(_labelled(kept), GWAS_SCHEMA), report


def standardise_complete(
    rows: DataFrame, studies: DataFrame, min_rows: int = 10000, min_mac: float = 10
) -> DataFrame:
    """The same for deliveries that already have effects, errors and frequencies."""
    usable = hand_over(qc.complete(rows.drop("ln_pval"), [*REQUIRED, "eaf"]), "usable-rows")
    return _finish(qc.min_rows_gate(usable, min_rows), studies, min_mac)


def qc_steps(min_mac: float = 10) -> list[tuple[str, Column]]:
    """Row checks of the ingest as report steps (over rows with filled columns).

    The predicates are those of the filters: a NaN is as missing as a null.
    """
    enough = (F.col("mac") >= min_mac) & (
        (F.col("mac_cases") >= min_mac) | F.col("mac_cases").isNull()
    )
    return [
        ("required columns", qc.all_of([qc.present(F.col(c)) for c in REQUIRED])),
        ("allele frequency", qc.present(F.col("eaf"))),
        ("minor allele count", enough),
    ]


def ingest_report(
    rows: DataFrame,
    studies: DataFrame,
    panel: DataFrame | None,
    min_rows: int = 10000,
    min_mac: float = 10,
) -> DataFrame:
    """Per study the rows left and removed by each step of the ingest, from one aggregate.

    Studies below ``min_rows`` usable rows lose all rows in the step ``enough rows``.
    """
    effects = stats.odds_to_effect(rows) if panel is not None else rows
    if panel is not None:
        effects = stats.impute_se(effects)
        missing = effects.where(F.col("eaf").isNull())
        effects = harmonise.fill_eaf(effects, harmonise.panel_sites(panel, wanted=missing))
    sizes = studies.select("study_id", F.col("n_total").cast("int"), F.col("n_cases").cast("int"))
    counted = qc.add_gwas_counts(effects.join(hand_over(sizes, "study-sizes"), "study_id", "left"))
    required, frequency, enough = qc_steps(min_mac)
    if panel is None:  # complete deliveries need a frequency from the start
        required = (required[0], required[1] & frequency[1])
    steps = qc.qc_counts(counted, [required, frequency, enough], ["study_id"])
    return qc.gate_step(steps, after=required[0], minimum=min_rows, name="enough rows")


def read_studies(
    spark: SparkSession,
    manifest: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    confident: bool = False,
) -> DataFrame:
    """All input files of a manifest, each row with the study of its line.

    A line may be a file, a folder or a glob. A line without any file fails the job.
    """
    lines = manifest.select(F.col("in_tsv").alias("line"), "study_id").distinct()
    paths = [row["line"] for row in lines.select("line").distinct().toLocalIterator()]
    headers = readers.header_lines(spark, paths)
    files = hand_over(readers.files_of_lines(headers.select("file_path"), lines), "input-files")
    lost = [r["line"] for r in lines.join(files, "line", "left_anti").select("line").limit(20).collect()]
    if lost:
        raise ValueError(f"no input rows for these manifest lines (at most 20 shown): {lost}")
    rows = readers.read_mapped_by_header(
        spark, paths, columns, {"in_tsv": readers.source_file()}, confident, headers=headers,
        logs={"pval": "ln_pval"},
    )
    owners = files.join(lines, "line").select(F.col("file_path").alias("in_tsv"), "study_id")
    return rows.join(hand_over(owners.distinct(), "owners"), "in_tsv").drop("in_tsv")


def ingest(
    spark: SparkSession,
    manifest: DataFrame,
    panel: DataFrame | None,
    out: str,
    columns: Mapping[str, tuple[str, str]] = readers.HARMONISED_GWAS,
    min_rows: int = 10000,
    min_mac: float = 10,
    confident: bool = False,
    log: str | None = None,
) -> None:
    """Manifest to Parquet, one folder per study, ordered by position inside.

    ``confident`` drops low-confidence variants; ``log`` is a path for the quality report
    per study. Intermediate tables are removed at the end.
    """
    with tidy(spark):
        rows = read_studies(spark, manifest, columns, confident)
        if log:
            result, report = standardise_logged(rows, manifest, panel, min_rows, min_mac)
        elif panel is not None:
            result = standardise(rows, manifest, panel, min_rows, min_mac)
        else:
            result = standardise_complete(rows, manifest, min_rows, min_mac)
        sinks.write_by_folder(result, out, ["study_id"])
        if log:
            sinks.write_result_table(report, log, sep="\t")


def panel_subset(panel: DataFrame, chroms: list[str], column: str = "chrom_b38") -> DataFrame:
    """Panel rows of the given chromosomes."""
    return panel.where(F.col(column).isin(chroms))
