"""The unified association row and the functions that enforce it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Column names, order and types of the unified tables.
_KEY_FIELDS = [
    T.StructField("type", T.StringType(), False),
    T.StructField("study_id", T.StringType(), False),
    T.StructField("phenotype_id", T.StringType()),
    T.StructField("bio_feature", T.StringType()),
    T.StructField("gene_id", T.StringType()),
    T.StructField("chrom", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("ref", T.StringType()),
    T.StructField("alt", T.StringType()),
    T.StructField("beta", T.DoubleType()),
    T.StructField("se", T.DoubleType()),
    T.StructField("pval", T.DoubleType()),
    T.StructField("n_total", T.IntegerType()),
    T.StructField("n_cases", T.IntegerType()),
    T.StructField("eaf", T.DoubleType()),
]
_TAIL_FIELDS = [
    T.StructField("info", T.DoubleType()),
    T.StructField("is_cc", T.BooleanType()),
]
GWAS_SCHEMA = T.StructType(
    _KEY_FIELDS
    + [T.StructField("mac", T.DoubleType()), T.StructField("mac_cases", T.DoubleType())]
    + _TAIL_FIELDS
)
QTL_SCHEMA = T.StructType(
    _KEY_FIELDS
    + [
        T.StructField("mac", T.IntegerType()),
        T.StructField("mac_cases", T.IntegerType()),
        T.StructField("num_tests", T.IntegerType()),
    ]
    + _TAIL_FIELDS
)
INTERVAL_SCHEMA = T.StructType(
    [
        T.StructField("study_id", T.StringType()),
        T.StructField("phenotype_id", T.StringType()),
        T.StructField("bio_feature", T.StringType()),
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
# Allowed chromosome names.
CHROMOSOMES = [str(n) for n in range(1, 23)] + ["X", "Y", "MT"]

# Columns a finished molecular-trait row must have.
QTL_REQUIRED = [
    "type", "study_id", "phenotype_id", "bio_feature", "gene_id", "chrom",
    "pos", "ref", "alt", "beta", "se", "pval",
]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``: fixed order and types, absent columns as typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def as_type_id(df: DataFrame) -> DataFrame:
    """Published form: ``type`` becomes ``type_id`` and ``info`` is a double."""
    renamed = df.withColumnRenamed("type", "type_id")
    return renamed.withColumn("info", F.col("info").cast("double"))


def drop_molecular_keys(df: DataFrame) -> DataFrame:
    """Remove the columns that are always null in GWAS rows."""
    return df.drop("phenotype_id", "bio_feature", "gene_id")


def unknown_chromosomes(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Rows whose chromosome is null or outside the allowed set."""
    return df.where(~F.coalesce(F.col(chrom).isin(CHROMOSOMES), F.lit(False)))
