"""Readers for summary statistics, variant tables and lookups.

Schemas are always given or mapped from strings, never inferred: inference would
read the input twice and type a chromosome column by accident.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from helixspan.functions import ids, tails
from helixspan.operators.combine import union_all
from helixspan.session import hand_over, settings

Paths = str | Sequence[str]

# Source column -> (unified column, type) for the delivered formats.
HARMONISED_GWAS = {
    "hm_chrom": ("chrom", "string"),
    "hm_pos": ("pos", "int"),
    "hm_other_allele": ("ref", "string"),
    "hm_effect_allele": ("alt", "string"),
    "p_value": ("pval", "double"),
    "hm_beta": ("beta", "double"),
    "standard_error": ("se", "double"),
    "hm_odds_ratio": ("oddsr", "double"),
    "hm_ci_lower": ("oddsr_lower", "double"),
    "hm_effect_allele_frequency": ("eaf", "double"),
    "info": ("info", "double"),
}
BIOBANK_GWAS = {
    "chromosome": ("chrom", "string"),
    "base_pair_location": ("pos", "int"),
    "other_allele": ("ref", "string"),
    "effect_allele": ("alt", "string"),
    "p-value": ("pval", "double"),
    "beta": ("beta", "double"),
    "standard_error": ("se", "double"),
    "odds_ratio": ("oddsr", "double"),
    "ci_lower": ("oddsr_lower", "double"),
    "effect_allele_frequency": ("eaf", "double"),
    "info": ("info", "double"),
}
FINNISH_GWAS = {
    "#chrom": ("chrom", "string"),
    "pos": ("pos", "int"),
    "ref": ("ref", "string"),
    "alt": ("alt", "string"),
    "pval": ("pval", "double"),
    "beta": ("beta", "double"),
    "sebeta": ("se", "double"),
    "af_alt": ("eaf", "double"),
    "info": ("info", "double"),
}
HARMONISED_PQTL = {
    "hm_chrom": ("chrom", "string"),
    "hm_pos": ("pos", "int"),
    "hm_other_allele": ("ref", "string"),
    "hm_effect_allele": ("alt", "string"),
    "p_value": ("pval", "double"),
    "hm_beta": ("beta", "double"),
    "standard_error": ("se", "double"),
    "hm_effect_allele_frequency": ("eaf", "double"),
    "INFO": ("info", "double"),
}
Z_SCORE_PQTL = {
    "hm_chrom": ("chrom", "string"),
    "hm_pos": ("pos", "int"),
    "hm_other_allele": ("ref", "string"),
    "hm_effect_allele": ("alt", "string"),
    "p-value": ("pval", "double"),
    "hm_beta": ("beta", "double"),
    "z": ("z", "double"),
    "hm_eaf": ("eaf", "double"),
}
# Column order and types of headerless and typed deliveries.
EQTL_ROWS = (
    "molecular_trait_id string, chromosome string, position int, ref string, alt string, "
    "variant string, ma_samples int, maf double, pvalue double, beta double, se double, "
    "type string, ac int, an int, r2 double, molecular_trait_object_id string, "
    "gene_id string, median_tpm double"
)
Z_SCORE_EQTL = (
    "pval double, rsid string, chrom string, pos int, z double, effect_allele string, "
    "other_allele string, gene_id string, gene_name string, gene_chrom string, gene_pos int, "
    "n_cohorts int, n_total int"
)
TISSUE_EQTL = (
    "gene_id string, variant_id string, tss_distance int, ma_samples int, ma_count int, "
    "maf double, pval_nominal double, slope double, slope_se double"
)
TISSUE_SQTL = (
    "phenotype_id string, variant_id string, ma_count int, maf double, pval_nominal double, "
    "slope double, slope_se double"
)
OLD_BUILD_PQTL = (
    "variant_id string, chrom string, pos int, effect_allele string, other_allele string, "
    "beta double, se double, log10_pval double"
)
VCF_SITES = (
    "chrom_b37 string, pos_b37 int, rsid string, ref string, alts string, qual string, "
    "filter string, info string"
)
VARIANT_TABLE = (
    "variant string, chr string, pos bigint, ref string, alt string, rsid string, varid string, "
    "consequence string, consequence_category string, info double, call_rate double, AC int, "
    "AF double, minor_allele string, minor_AF double, p_hwe double, n_called int, "
    "n_not_called int, n_hom_ref int, n_het int, n_hom_var int, n_non_ref int, "
    "r_heterozygosity double, r_het_hom_var string, r_expected_het_frequency double"
)
GENE_DICTIONARY = "gene_id string, chr string, tss int"
TISSUE_CODES = "biofeature_string string, biofeature_code string"
FILE_GENES = "file_name string, gene_id string"
SITE_LIST = "chrom_b37 string, pos_b37 int, ref string, alt string"
CHAIN_BLOCKS = (
    "chrom string, t_start int, t_end int, q_chrom string, q_start int, q_size int, "
    "strand string, chain_score bigint"
)


def source_file() -> Column:
    """Full path of the file a row was read from, as one would write it."""
    return ids.clean_path(F.col("_metadata.file_path"))


def source_name() -> Column:
    """Name of the file a row was read from."""
    return F.col("_metadata.file_name")


def listing(spark: SparkSession):
    """Settings to name many paths with: a few of them per task and core, not one per task."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)})


def header_schema(spark: SparkSession, file: str) -> StructType:
    """Columns of one file, as the CSV reader names them, all of them strings."""
    return spark.read.csv(file, sep="\t", header=True).schema


def _names(column: DataFrame):
    """The texts of a frame's only column as a list of the JVM.

    File names go from there to the readers; by way of Python each costs a call.
    """
    strings = column.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING()
    return getattr(column._jdf, "as")(strings).collectAsList()


def _csv_of(reader, names) -> DataFrame:
    """``reader.csv`` for a list of ``_names``."""
    return reader._df(reader._jreader.csv(reader._spark._sc._jvm.PythonUtils.toSeq(names)))


def read_mapped_tsv(
    spark: SparkSession,
    paths: Paths,
    columns: Mapping[str, tuple[str, str]],
    extra: Mapping[str, Column] | None = None,
    confident: bool = False,
    bad: str | None = None,
    logs: Mapping[str, str] | None = None,
    like: str | None = None,
) -> DataFrame:
    """Header TSV read as strings, ``NA`` as null, mapped to unified names and types.

    Columns the file lacks become typed nulls and unparsable numbers null; ``bad`` names
    a column that counts them per row. Integers may carry decimals, which are cut off.
    ``extra`` adds columns such as the source file; ``confident`` drops rows flagged as
    low-confidence variants before the flag is projected away. ``logs`` maps mapped columns
    to new ones with the natural logarithm of their text, which also holds p-values that are
    zero as doubles. ``like`` names one of the files if all are known to have its header;
    otherwise the paths are listed a second time to look for it.
    """
    reader = spark.read.schema(header_schema(spark, like)) if like else spark.read
    # Its buffer of 2 MB is made anew for every file.
    reader = reader.options(sep="\t", header=True, nullValue="NA", inputBufferSize=1 << 16)
    with listing(spark):
        raw = _csv_of(reader, paths) if isinstance(paths, JavaObject) else reader.csv(paths)
    if confident and "low_confidence_variant" in raw.columns:
        raw = raw.where(~F.col("low_confidence_variant").try_cast("boolean"))
    present = set(raw.columns)

    def parsed(source: str, kind: str) -> Column:
        text = F.col(f"`{source}`")
        return ids.whole(text) if kind == "int" else text.try_cast(kind)

    lost = [
        (F.col(f"`{source}`").isNotNull() & parsed(source, kind).isNull()).cast("int")
        for source, (_, kind) in columns.items()
        if source in present and kind != "string"
    ]
    counted = [sum(lost, F.lit(0)).alias(bad)] if bad else []
    sources = {name: source for source, (name, _) in columns.items() if source in present}
    exact = [
        (tails.ln_of_text(F.col(f"`{sources[name]}`")) if name in sources else F.lit(None).cast("double")).alias(log)
        for name, log in (logs or {}).items()
    ]
    return raw.select(
        *[
            (parsed(source, kind) if source in present else F.lit(None).cast(kind)).alias(name)
            for source, (name, kind) in columns.items()
        ],
        *[value.alias(name) for name, value in (extra or {}).items()],
        *counted,
        *exact,
    )


def read_typed_tsv(
    spark: SparkSession, paths: Paths, schema: str, header: bool = True, comment: str | None = None
) -> DataFrame:
    """TSV with a given schema; ``NA`` is null, numbers that do not parse are null."""
    reader = spark.read.schema(schema).option("sep", "\t").option("nullValue", "NA")
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(paths, header=header)


def read_table(spark: SparkSession, path: Paths, schema: str, sep: str = "\t") -> DataFrame:
    """Small delimited lookup with a header."""
    return spark.read.schema(schema).csv(path, sep=sep, header=True)


def read_json_lookup(spark: SparkSession, path: Paths, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, paths: Paths, schema=None) -> DataFrame:
    """Parquet paths or globs as one scan; a schema also fixes folder-partition types."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_datasets(spark: SparkSession, roots: Iterable[str], schema) -> DataFrame:
    """Several folder-partitioned data sets as one table.

    Each root has its own folder tree, so each is its own scan; the schema types the
    folder columns, and filters on the result reach every scan.
    """
    return union_all(read_parquet(spark, root, schema) for root in roots)


def read_panel(spark: SparkSession, path: Paths) -> DataFrame:
    """Variant panel; the nested frequency is pruned at the scan."""
    return spark.read.parquet(path).select(
        "chrom_b37", "pos_b37", "chrom_b38", "pos_b38", "ref", "alt",
        F.struct(F.col("af.gnomad_nfe").alias("gnomad_nfe")).alias("af"),
    )


def read_paths(spark: SparkSession, path: Paths) -> DataFrame:
    """Path list, one per line, as column ``path``."""
    return spark.read.text(path).where("trim(value) <> ''").select(
        F.trim("value").alias("path")
    )


#: Files up to this size are read whole, many of them per task; of longer ones only the first batch.
SMALL_FILE = 1 << 20
#: Small files per task.
FILES_PER_TASK = 1000
#: What a text may begin with to tell its byte order.
MARK = "\ufeff"


def _first_row(batches: Iterable) -> Iterable:
    """The first row of a partition, if a file starts there; the rest is not fetched."""
    for batch in batches:
        if batch.num_rows:
            if batch.column("start")[0].as_py() == 0:
                yield batch.slice(0, 1).select(["file_path", "header"])
            return


def header_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """(file_path, header) of every file that has a line.

    Spark's text source reads, so every storage, name and compression it knows will do.
    Small files share a task by the thousand; each is one value, of which only the first line
    goes on. Of a longer file the task stops after its first batch of lines: with the cost of
    opening a file set to a whole split no task gets two of them. The size is a property of
    the file, so both scans only open the files they are for.
    """
    whole = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    with listing(spark):
        texts = spark.read.text(paths, wholetext=True)
    size = F.col("_metadata.file_size")
    name = ids.clean_path(F.col("_metadata.file_path")).alias("file_path")
    small = {
        "spark.sql.files.maxPartitionBytes": str(max(whole, SMALL_FILE)),
        "spark.sql.files.openCostInBytes": str(max(1, whole // FILES_PER_TASK)),
        # Otherwise the files would be dealt out to as many tasks as there are cores.
        "spark.sql.files.minPartitionNum": "1",
    }
    # The text source leaves the mark out where it cuts lines itself, at any kind of line end.
    marked = F.col("value").startswith(MARK)
    text = F.when(marked, F.substr("value", F.lit(2))).otherwise(F.col("value"))
    line = F.substring_index(F.substring_index("text", "\n", 1), "\r", 1).alias("header")
    with settings(spark, small):
        firsts = texts.where(size <= SMALL_FILE).select(name, text.alias("text"))
        found = hand_over(firsts.where("text <> ''").select("file_path", line).distinct(), "headers")
    if not texts.where(size > SMALL_FILE).rdd.getNumPartitions():
        return found
    with listing(spark):
        lines = spark.read.text(paths)
    long = lines.where(size > SMALL_FILE).select(
        name, F.col("value").alias("header"), F.col("_metadata.file_block_start").alias("start")
    )
    with settings(spark, {"spark.sql.files.openCostInBytes": str(whole)}):
        firsts = long.mapInArrow(_first_row, "file_path string, header string").distinct()
        return found.unionByName(hand_over(firsts, "headers"))


def header_groups(headers: DataFrame) -> DataFrame:
    """How many files share each header, largest group first."""
    return (
        headers.groupBy("header")
        .agg(F.count(F.lit(1)).alias("n_files"), F.min("file_path").alias("example"))
        .orderBy(F.desc("n_files"), "header")
    )


def read_mapped_by_header(
    spark: SparkSession,
    paths: Paths,
    columns: Mapping[str, tuple[str, str]],
    extra: Mapping[str, Column] | None = None,
    confident: bool = False,
    bad: str | None = None,
    headers: DataFrame | None = None,
    logs: Mapping[str, str] | None = None,
) -> DataFrame:
    """``read_mapped_tsv`` for files whose headers differ: one read per distinct header.

    CSV binds columns by position within one read, so files with another column set
    or order must not share it. ``headers`` is the result of ``header_lines`` if it is
    known. The driver holds file names, which it hands to the readers.
    """
    known = header_lines(spark, paths) if headers is None else headers
    literal = F.regexp_replace("file_path", LITERAL, r"\\$1")
    groups = known.groupBy("header").agg(F.min("file_path").alias("first")).orderBy("header")
    return union_all(
        read_mapped_tsv(
            spark, _names(known.where(F.col("header") == row["header"]).select(literal).distinct()),
            columns, extra, confident, bad, logs, like=literal_path(row["first"]),
        )
        for row in groups.toLocalIterator()
    )


#: Characters of a file name that a pattern would take for more than themselves.
LITERAL = r"([*?\[\]{}\\])"


def literal_path(path: str) -> str:
    """A file's name as a pattern that matches this file only."""
    return re.sub(LITERAL, r"\\\1", path)


def files_of_lines(files: DataFrame, lines: DataFrame) -> DataFrame:
    """(file_path, line): which files a line of a manifest stands for.

    A line is a file, a folder or a glob, with or without a scheme. The part of the line
    before its first pattern is joined with the folders above each file, and the whole
    line then has to match as a pattern, so no file is compared with every line.
    """
    cleaned = F.regexp_replace(F.regexp_replace("line", "^file:/+", "/"), "/+$", "")
    plain = F.regexp_extract(F.col("clean"), r"^[^*?\[{]*", 0)
    fixed = F.when(plain == F.col("clean"), plain).otherwise(F.regexp_replace(plain, "/[^/]*$", ""))
    pattern = F.regexp_replace("clean", r"([.+()^$|\\])", r"\\$1")
    for text, becomes in ((r"\*", "[^/]*"), (r"\?", "[^/]"), (r"\[!", "[^"), (r"\{", "(?:"), (r"\}", ")")):
        pattern = F.regexp_replace(pattern, text, becomes)
    pattern = F.when(F.col("clean").contains("{"), F.replace(pattern, F.lit(","), F.lit("|"))).otherwise(pattern)
    asked = (
        lines.select("line").distinct()
        .withColumn("clean", cleaned)
        .select("line", fixed.alias("fixed"), F.concat(F.lit("^"), pattern, F.lit("(/.*)?$")).alias("pattern"))
    )
    bare = F.regexp_replace("file_path", "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    above = F.transform(
        F.sequence(F.lit(1), F.size(F.split("name", "/"))),
        lambda n: F.array_join(F.slice(F.split("name", "/"), 1, n), "/"),
    )
    placed = (
        files.select("file_path", F.explode(F.array_distinct(F.array("file_path", bare))).alias("name"))
        .select("file_path", "name", F.explode(above).alias("fixed"))
    )
    found = placed.join(hand_over(asked, "lines"), "fixed").where(F.expr("name rlike pattern"))
    return found.select("file_path", "line").distinct()
