"""Row filters, gates and quality reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from helixspan.functions import stats
from helixspan.session import hand_over


def p_at_most(df: DataFrame, threshold: float, pval: str = "pval") -> DataFrame:
    return df.where(F.col(pval) <= F.lit(float(threshold)))


def complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in ``columns`` (default: any column)."""
    return df.dropna(subset=list(columns) if columns is not None else None)


def confident_only(df: DataFrame, flag: str = "low_confidence_variant") -> DataFrame:
    """Drop flagged rows when the flag column exists; rows without a verdict go as well."""
    return df.where(~F.col(flag).try_cast("boolean")) if flag in df.columns else df


def add_gwas_counts(df: DataFrame) -> DataFrame:
    """Minor allele counts over all samples and over cases."""
    return df.withColumns(
        {
            "mac": stats.minor_count(F.col("n_total"), F.col("eaf")),
            "mac_cases": stats.minor_count(F.col("n_cases"), F.col("eaf")),
        }
    )


def gwas_count_filter(df: DataFrame, min_mac: float = 10) -> DataFrame:
    """Enough minor alleles overall and, for case-control studies, among cases."""
    return df.where(
        (F.col("mac") >= min_mac)
        & ((F.col("mac_cases") >= min_mac) | F.col("mac_cases").isNull())
    )


def min_count(df: DataFrame, column: str, minimum: float) -> DataFrame:
    return df.where(F.col(column) >= minimum)


def min_rows_gate(df: DataFrame, min_rows: int = 10000, study: str = "study_id") -> DataFrame:
    """Keep only studies with at least ``min_rows`` rows.

    The counts are one row per study, combined on the map side, so a study holding
    most of the rows costs no more than the others.
    """
    enough = df.groupBy(study).count().where(F.col("count") >= min_rows).select(study)
    return df.join(hand_over(enough, "large-studies"), study, "left_semi")


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: (column_name, nulls)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "nulls")


def present(value: Column) -> Column:
    """Neither null nor NaN, as ``complete`` sees it: only numbers can be NaN.

    The type is known when the plan is made, so for texts the test disappears from it.
    """
    not_a_number = F.typeof(value).isin("double", "float") & F.isnan(value.try_cast("double"))
    return value.isNotNull() & ~F.coalesce(not_a_number, F.lit(False))


def qc_counts(
    df: DataFrame, steps: Sequence[tuple[str, Column]], by: Sequence[str] = ()
) -> DataFrame:
    """(by, step_no, step, n_rows): rows left after each step, in one pass.

    ``steps`` are (name, predicate) pairs that apply one after the other. The number of
    steps that a row passes is found once per row; the counters are one aggregate of it.
    """
    passed = F.lit(len(steps))
    for number, (_, predicate) in reversed(list(enumerate(steps))):
        passed = F.when(~F.coalesce(predicate, F.lit(False)), F.lit(number)).otherwise(passed)
    rows = [
        F.struct(
            F.lit(number).alias("step_no"),
            F.lit(name).alias("step"),
            F.count_if(F.col("_passed") >= number).alias("n_rows"),
        )
        for number, name in enumerate(["input", *[name for name, _ in steps]])
    ]
    counted = df.select(*by, passed.alias("_passed")).groupBy(*by).agg(F.array(*rows).alias("steps"))
    return counted.select(*by, F.inline("steps"))


def with_removed(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts with the rows each step removed, also in percent of the input."""
    along = Window.partitionBy(*by).orderBy("step_no")
    before = F.coalesce(F.lag("n_rows").over(along), F.col("n_rows"))
    share = F.try_divide((before - F.col("n_rows")) * F.lit(100.0), F.first("n_rows").over(along))
    return counts.withColumns(
        {"removed": before - F.col("n_rows"), "removed_pct": F.round(share, 2)}
    )


def qc_report(
    df: DataFrame, steps: Sequence[tuple[str, Column]], by: Sequence[str] = ()
) -> DataFrame:
    """Rows left and removed after each step, for all rows or per group."""
    return with_removed(qc_counts(df, steps, by), by)


class StepLog:
    """Rows left after each step of a plan, observed while the plan writes its output.

    A step is an observation on the rows that pass by, so the report needs no scan of its
    own. Every observed frame has to be written by one job without range bounds, whose
    sampling would count again; a stage repeated for a lost executor may count rows twice.
    """

    def __init__(self) -> None:
        self.steps: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation()
        self.steps.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def report(self, spark: SparkSession) -> DataFrame:
        """step_no, step, n_rows, removed, removed_pct; waits until the rows are written."""
        rows = [(i, name, seen.get["n_rows"]) for i, (name, seen) in enumerate(self.steps)]
        return with_removed(spark.createDataFrame(rows, "step_no int, step string, n_rows long"))


_log: ContextVar[StepLog | None] = ContextVar("log", default=None)


@contextmanager
def step_log() -> Iterator[StepLog]:
    """Plans made inside report their steps to the log."""
    log = StepLog()
    token = _log.set(log)
    try:
        yield log
    finally:
        _log.reset(token)


def logging_steps() -> bool:
    return _log.get() is not None


def step(df: DataFrame, name: str) -> DataFrame:
    """``df``, its rows counted under this name if a log is open."""
    log = _log.get()
    return log.watch(df, name) if log else df


def gate_step(
    counts: DataFrame, after: str, minimum: int, name: str, by: Sequence[str] = ("study_id",)
) -> DataFrame:
    """Report of counts per study, with a step that removes studies that are too small.

    The table has a few rows per study.
    """
    keys = [F.col(c) for c in by]
    gate = counts.where(F.col("step") == after).select(
        *keys, F.col("step_no").alias("_at"), (F.col("n_rows") >= minimum).alias("_enough")
    )
    joined = counts.join(gate, list(by))
    later = F.col("step_no") > F.col("_at")
    shifted = joined.select(
        *keys,
        (F.col("step_no") + later.cast("int")).alias("step_no"),
        "step",
        F.when(later & ~F.col("_enough"), 0).otherwise(F.col("n_rows")).alias("n_rows"),
    )
    own = joined.where("step_no = _at").select(
        *keys,
        (F.col("step_no") + 1).alias("step_no"),
        F.lit(name).alias("step"),
        F.when(F.col("_enough"), F.col("n_rows")).otherwise(0).alias("n_rows"),
    )
    return with_removed(shifted.unionByName(own), by)


def violations(df: DataFrame, rules: Sequence[tuple[str, Column]], unique: str | None = None):
    """One row per rule: how many rows break it. ``unique`` adds a duplicate-id rule."""
    broken = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(~F.coalesce(predicate, F.lit(False))).alias("n_rows"),
        )
        for name, predicate in rules
    ]
    report = df.agg(F.array(*broken).alias("rules")).select(F.inline("rules"))
    if unique is None:
        return report
    repeated = (
        df.groupBy(unique)
        .count()
        .agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("n"))
        .select(F.lit(f"{unique} is unique").alias("rule"), F.col("n").alias("n_rows"))
    )
    return report.unionByName(repeated)


def manifest_rules() -> list[tuple[str, Column]]:
    """Case, control and quantitative sample counts must fit together."""
    cases, controls, quant = (F.col(c).isNull() for c in ("n_cases", "n_controls", "n_quant"))
    return [
        ("n_cases and n_controls come together", cases == controls),
        ("either n_cases or n_quant", cases != quant),
    ]


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)
