"""Named queries over the given tables; importing this package registers them all."""

from pyspark.sql import DataFrame, SparkSession

from helixspan.operators import windows
from helixspan.registry import (  # noqa: F401
    files,
    filters,
    genes,
    joins,
    pipelines,
    scalars,
    studies,
)
from helixspan.registry.core import ORACLES, QUERIES
from helixspan.registry.views import Tables

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Rows within 5 kb of a variant with p <= 0.005."""
    kept, _ = windows.extract_windows(Tables(spark, folder).view("v_gwas"), 5000, "gwas", 0.005)
    return kept.select("study_id", "chrom", "pos", "ref", "alt", "beta", "pval")
