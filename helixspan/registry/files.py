"""Queries: readers and writers, as write-then-read round trips in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixspan import schema
from helixspan.functions import ids
from helixspan.operators import layout, qtl, windows
from helixspan.plans import exports, extract, gwas, jobs
from helixspan.registry.core import query
from helixspan.registry.filters import _MERGED, _NEAR, P_WINDOW, WIDTH, _gwas_table, _hits, _qtl_table
from helixspan.registry.views import Tables
from helixspan.session import scratch_path
from helixspan.sources import publish, readers, sinks
from helixspan.streaming import arrivals

_HARMONISED = {new: old for old, (new, _) in readers.HARMONISED_GWAS.items()}
_GWAS_COLUMNS = ["chrom", "pos", "ref", "alt", "pval", "beta", "se", "oddsr", "oddsr_lower", "eaf"]


def _harmonised(t: Tables, *without: str) -> DataFrame:
    """GWAS rows under the column names of a harmonised delivery."""
    rows = t.view("v_gwas").select(*[c for c in _GWAS_COLUMNS if c not in without])
    return rows.withColumnsRenamed(_HARMONISED)


@query(
    """SELECT chrom, pos, ref, alt, pval, beta, se, oddsr, oddsr_lower, eaf,
        cast(NULL AS double) AS info FROM v_gwas"""
)
def tsv_mapped(t: Tables) -> DataFrame:
    """Some positions are delivered as decimal numbers."""
    path = scratch_path(t.spark, "mapped")
    text = F.col("hm_pos").cast("string")
    decimal = F.when(F.col("hm_pos") % 3 == 0, F.concat(text, F.lit(".0"))).otherwise(text)
    sinks.write_export(_harmonised(t).withColumn("hm_pos", decimal), path)
    return readers.read_mapped_tsv(t.spark, path, readers.HARMONISED_GWAS)


@query(
    """SELECT chrom, pos, ref, alt, pval, beta, se FROM v_gwas WHERE NOT low_confidence_variant"""
)
def tsv_confident(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "confident")
    flagged = t.view("v_gwas").select(*_GWAS_COLUMNS[:7], "low_confidence_variant")
    sinks.write_export(flagged.withColumnsRenamed(_HARMONISED), path)
    rows = readers.read_mapped_tsv(t.spark, path, readers.HARMONISED_GWAS, confident=True)
    return rows.select(_GWAS_COLUMNS[:7])


@query(
    """SELECT chrom, pos, ref, alt, pval, beta, se, oddsr, oddsr_lower, eaf,
        cast(NULL AS double) AS info FROM v_gwas"""
)
def tsv_biobank(t: Tables) -> DataFrame:
    """The same rows under the column names of a biobank delivery."""
    path = scratch_path(t.spark, "biobank")
    names = {new: old for old, (new, _) in readers.BIOBANK_GWAS.items()}
    sinks.write_export(t.view("v_gwas").select(*_GWAS_COLUMNS).withColumnsRenamed(names), path)
    return readers.read_mapped_tsv(t.spark, path, readers.BIOBANK_GWAS)


def _two_headers(t: Tables) -> str:
    """Two deliveries in one folder whose column sets and orders differ."""
    path = scratch_path(t.spark, "headers")
    first = _harmonised(t)
    second = _harmonised(t, "oddsr", "oddsr_lower").where("hm_pos%2=0")
    sinks.write_export(first, f"{path}/a")
    sinks.write_result_table(second.select(*reversed(second.columns)), f"{path}/b", sep="\t")
    return path


@query(
    """SELECT chrom, pos, ref, alt, pval, beta, se, oddsr, eaf, 'a' AS folder FROM v_gwas
    UNION ALL SELECT chrom, pos, ref, alt, pval, beta, se, NULL, eaf, 'b' FROM v_gwas WHERE pos%2=0"""
)
def tsv_by_header(t: Tables) -> DataFrame:
    path = _two_headers(t)
    folder = {"folder": F.regexp_extract(readers.source_file(), "/([ab])/[^/]*$", 1)}
    rows = readers.read_mapped_by_header(
        t.spark, [f"{path}/a", f"{path}/b"], readers.HARMONISED_GWAS, folder
    )
    return rows.select("chrom", "pos", "ref", "alt", "pval", "beta", "se", "oddsr", "eaf", "folder")


@query(
    """SELECT column_name, count(*) AS n_files FROM (
        SELECT concat('chrom', chrom) AS column_name FROM v_gwas GROUP BY chrom
        UNION ALL SELECT 'pos' FROM v_gwas GROUP BY chrom) c GROUP BY column_name"""
)
def header_groups(t: Tables) -> DataFrame:
    """One delivery per chromosome, each with a header of its own, audited by column.

    A delivery is a folder with as many files as tasks wrote it; all its files have the header.
    """
    path = scratch_path(t.spark, "audit")
    chroms = [r["chrom"] for r in t.view("v_gwas").select("chrom").distinct().collect()]
    for chrom in chroms:
        rows = t.view("v_gwas").where(F.col("chrom") == chrom)
        named = rows.select(F.col("chrom").alias(f"chrom{chrom}"), "pos")
        sinks.write_result_table(named, f"{path}/{chrom}", sep="\t")
    headers = readers.header_lines(t.spark, f"{path}/*")
    delivery = ids.parent_folder(F.col("file_path")).alias("file_path")
    groups = readers.header_groups(headers.select(delivery, "header").distinct())
    names = groups.select(F.explode(F.split("header", "\t")).alias("column_name"), "n_files")
    return names.groupBy("column_name").agg(F.sum("n_files").alias("n_files"))


@query(
    """SELECT phenotype_id AS molecular_trait_id, chrom AS chromosome, pos AS position, ref, alt,
        maf, pval AS pvalue, ac, an, gene_id FROM v_qtl"""
)
def tsv_headerless(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "headerless")
    text = F.lit(None).cast("string")
    rows = t.view("v_qtl").select(
        "phenotype_id", "chrom", "pos", "ref", "alt", text.alias("variant"),
        F.lit(1).alias("ma_samples"), "maf", "pval", "beta", "se", text.alias("type"), "ac", "an",
        "r2", text.alias("object"), "gene_id", F.lit(0.5).alias("median_tpm"),
    )
    rows.write.csv(path, sep="\t", header=False, nullValue="NA")
    return readers.read_typed_tsv(t.spark, path, readers.EQTL_ROWS, header=False).select(
        "molecular_trait_id", "chromosome", "position", "ref", "alt", "maf", "pvalue", "ac", "an",
        "gene_id",
    )


@query("SELECT chrom_b37, pos_b37, rsid, ref, alts FROM v_vcf")
def tsv_comments(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sites")
    sites = t.view("v_vcf")
    lines = sites.select(
        F.concat_ws("\t", *[F.col(c).cast("string") for c in sites.columns], *[F.lit(".")] * 3)
    )
    remarks = sites.where("pos_b37%100=0").select(F.concat(F.lit("#"), "rsid"))
    lines.union(remarks).write.text(path)
    return readers.read_typed_tsv(
        t.spark, path, readers.VCF_SITES, header=False, comment="#"
    ).select("chrom_b37", "pos_b37", "rsid", "ref", "alts")


@query(
    """SELECT phenotype, snpid, ac, "sebeta" FROM v_mixed"""
)
def export_by_phenotype(t: Tables) -> DataFrame:
    """Folder per phenotype, read back with the phenotype taken from the path."""
    path = scratch_path(t.spark, "export")
    sinks.write_export(t.view("v_mixed").select("phenotype", "snpid", "ac", "sebeta"), path, "phenotype")
    rows = readers.read_typed_tsv(
        t.spark, f"{path}/phenotype=*", "snpid string, ac int, sebeta double"
    )
    phenotype = F.regexp_extract(readers.source_file(), "phenotype=([^/]*)/", 1)
    return rows.select(phenotype.alias("phenotype"), "snpid", "ac", "sebeta")


@query("SELECT study_id, chrom, pos, ref, alt, pval FROM v_gwas")
def parquet_whole(t: Tables) -> DataFrame:
    """Everything written in position order is read back."""
    path = scratch_path(t.spark, "whole")
    sinks.write_by_position(_gwas_table(t), path, 8)
    rows = readers.read_parquet(t.spark, path, schema.GWAS_SCHEMA)
    return rows.select("study_id", "chrom", "pos", "ref", "alt", "pval")


@query("SELECT study_id, chrom, pos, ref, alt, pval FROM v_gwas")
def parquet_sized(t: Tables) -> DataFrame:
    """Written in position order, with files of about 256 KB, and read back whole."""
    path = scratch_path(t.spark, "sized")
    sinks.write_sized(_gwas_table(t), path, 256 << 10)
    rows = readers.read_parquet(t.spark, path, schema.GWAS_SCHEMA)
    return rows.select("study_id", "chrom", "pos", "ref", "alt", "pval")


@query("SELECT study_id, chrom, pos, ref, alt, pval FROM v_gwas WHERE chrom = '3' AND pos >= 1000")
def parquet_by_position(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "positions")
    sinks.write_by_position(_gwas_table(t), path, 8)
    rows = readers.read_parquet(t.spark, path, schema.GWAS_SCHEMA)
    return rows.where("chrom = '3' AND pos >= 1000").select(
        "study_id", "chrom", "pos", "ref", "alt", "pval"
    )


@query("SELECT bio_feature, chrom, phenotype_id, pos, pval FROM v_qtl")
def parquet_by_folder(t: Tables) -> DataFrame:
    """Written twice, one tissue at a time and once more, without doubling any row."""
    path = scratch_path(t.spark, "folders")
    table = _qtl_table(t)
    sinks.write_by_folder(table, path)
    sinks.write_by_folder(table.where("bio_feature = 'F'"), path)
    rows = readers.read_parquet(t.spark, path, schema.QTL_SCHEMA)
    return rows.select("bio_feature", "chrom", "phenotype_id", "pos", "pval")


@query(
    """SELECT study_id, bio_feature, chrom, pos, cast(ma_count AS int) AS mac FROM v_qtl
    WHERE pval <= 0.005e0 UNION ALL SELECT 'second', bio_feature, chrom, pos, cast(ma_count AS int)
    FROM v_qtl WHERE bio_feature = 'F' AND pval <= 0.005e0"""
)
def parquet_many_sets(t: Tables) -> DataFrame:
    """Several folder-partitioned data sets, filtered as one table, mac made an integer."""
    path = scratch_path(t.spark, "sets")
    first = layout.integer_mac(_qtl_table(t).withColumn("mac", F.col("mac") + F.lit(0.5)))
    second = first.where("bio_feature = 'F'").withColumn("study_id", F.lit("second"))
    sinks.write_by_folder(first, f"{path}/one.parquet")
    sinks.write_by_folder(second, f"{path}/two.parquet")
    rows = readers.read_datasets(
        t.spark, [f"{path}/one.parquet", f"{path}/two.parquet"], schema.QTL_SCHEMA
    )
    return rows.where("pval <= 0.005D").select("study_id", "bio_feature", "chrom", "pos", "mac")


@query(
    """SELECT study_id AS col_study_id, bio_feature, chrom, pos, cast(ma_count AS int) AS mac
    FROM v_qtl"""
)
def parquet_by_study(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "studies")
    sinks.write_by_study(_qtl_table(t), path)
    rows = readers.read_parquet(t.spark, path)
    return rows.select(
        "col_study_id", "bio_feature", F.col("chrom").cast("string"), "pos", "mac"
    )


@query(f"""WITH {_MERGED} SELECT study_id, chrom, "start", "end" FROM merged""")
def interval_tsv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "intervals")
    sinks.write_intervals(windows.merge_windows(_hits(t), WIDTH), path)
    rows = readers.read_typed_tsv(t.spark, path, schema.INTERVAL_SCHEMA)
    return rows.select("study_id", "chrom", "start", "end")


@query("SELECT study_id, n_cases, n_quant FROM v_curated")
def json_manifest(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "manifest")
    sinks.write_manifest(t.view("v_curated").select("study_id", "n_cases", "n_quant"), path)
    return readers.read_json_lookup(t.spark, path, "study_id string, n_cases int, n_quant int")


@query("SELECT gene_id, chr, tss FROM v_gene")
def csv_lookup(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lookup")
    sinks.write_result_table(t.view("v_gene").select("gene_id", "chr", "tss"), path)
    return readers.read_table(t.spark, path, readers.GENE_DICTIONARY, sep=",")


@query("SELECT regexp_extract(path, 'GCST[0-9]+') AS study_id FROM v_completed")
def path_list(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "paths")
    t.view("v_completed").select(F.col("path").alias("value")).write.text(path)
    done = readers.read_paths(t.spark, path)
    return done.select(ids.study_of_output(F.col("path")).alias("study_id"))


@query("SELECT chr, cast(pos AS bigint) AS pos, ref, alt, rsid, info FROM v_rsid")
def variant_index(t: Tables) -> DataFrame:
    """Variant table from TSV to Parquet ordered by position."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    whole = F.lit(None).cast("int")
    rows = t.view("v_rsid").select(
        F.concat_ws(":", "chr", F.col("pos").cast("string"), "ref", "alt").alias("variant"),
        "chr", "pos", "ref", "alt", "rsid", text.alias("varid"), text.alias("consequence"),
        text.alias("consequence_category"), "info", number.alias("call_rate"), whole.alias("AC"),
        number.alias("AF"), text.alias("minor_allele"), number.alias("minor_AF"),
        number.alias("p_hwe"), whole.alias("n_called"), whole.alias("n_not_called"),
        whole.alias("n_hom_ref"), whole.alias("n_het"), whole.alias("n_hom_var"),
        whole.alias("n_non_ref"), number.alias("r_heterozygosity"), text.alias("r_het_hom_var"),
        number.alias("r_expected_het_frequency"),
    )
    delivered, index = scratch_path(t.spark, "variants"), scratch_path(t.spark, "index")
    rows.write.csv(delivered, sep="\t", header=True, nullValue="NA")
    typed = readers.read_typed_tsv(t.spark, delivered, readers.VARIANT_TABLE)
    sinks.write_by_position(typed, index, chrom="chr")
    return readers.read_parquet(t.spark, index).select("chr", "pos", "ref", "alt", "rsid", "info")


@query(f"SELECT study_id, chrom, pos, ref, alt, beta, pval {_NEAR}")
def window_job(t: Tables) -> DataFrame:
    """The whole window job: extract, write intervals and rows, read the rows."""
    out = scratch_path(t.spark, "windows")
    extract.significant_windows(
        _gwas_table(t), f"{out}/rows", f"{out}/intervals", "gwas", WIDTH, P_WINDOW
    )
    return readers.read_parquet(t.spark, f"{out}/rows").select(
        "study_id", "chrom", "pos", "ref", "alt", "beta", "pval"
    )


@query(
    """WITH tests AS (SELECT study_id, bio_feature, phenotype_id, count(pval) AS n
        FROM v_qtl GROUP BY 1, 2, 3),
    rated AS (SELECT q.*, CASE WHEN q.pval <= 0.05e0 / n THEN 1 ELSE 0 END AS hit
        FROM v_qtl q JOIN tests USING (study_id, bio_feature, phenotype_id)),
    framed AS (SELECT *, max(hit) OVER (
        PARTITION BY study_id, phenotype_id, bio_feature, chrom ORDER BY pos
        RANGE BETWEEN 5000 PRECEDING AND 5000 FOLLOWING) AS near_hit FROM rated)
    SELECT study_id, phenotype_id, bio_feature, chrom, pos, pval FROM framed WHERE near_hit = 1"""
)
def window_job_molecular(t: Tables) -> DataFrame:
    """The window job on molecular rows, all folders read back."""
    out = scratch_path(t.spark, "molecular-windows")
    tested = qtl.add_num_tests(
        _qtl_table(t).drop("num_tests"), ["study_id", "bio_feature", "phenotype_id"]
    )
    extract.significant_windows(tested, f"{out}/rows", None, "molecular_trait", WIDTH)
    rows = readers.read_parquet(t.spark, f"{out}/rows", schema.QTL_SCHEMA)
    return rows.select("study_id", "phenotype_id", "bio_feature", "chrom", "pos", "pval")


def _phenotype_folder() -> Column:
    """Value of the folder that a row's file lies in."""
    return F.substring_index(F.substring_index(readers.source_file(), "phenotype=", -1), "/", 1)


@query(
    """SELECT phenotype, variant_id, cast("AC" AS double) AS "AC", minor, cases, info FROM (
        SELECT l.phenotype, r.rsid AS variant_id, l."AC", r.info,
            CASE WHEN g = 1 THEN l.pval END AS minor, CASE WHEN g = 0 THEN l.pval END AS cases
        FROM (SELECT *, cast(substr(phenotype, 2) AS int)%3 AS g FROM v_linear) l
        JOIN v_rsid r ON l.variant = concat(r.chr, ':', cast(r.pos AS varchar), ':', r.ref, ':', r.alt)
        WHERE l.phenotype IN (SELECT phenotype FROM v_phenotype)) t"""
)
def linear_export_job(t: Tables) -> DataFrame:
    """Result files in three layouts, found by column name, to exports and back.

    A third of the phenotypes has one expected allele count, a third the other one, and a
    third none; the column orders differ as well.
    """
    root = scratch_path(t.spark, "linear")
    rows = t.view("v_linear").withColumn("g", F.substring("phenotype", 2, 20).cast("int") % 3)
    base = ["variant", "n_complete_samples", "AC", "beta", "se", "pval"]
    extra = {0: "expected_case_minor_AC", 1: "expected_min_category_minor_AC", 2: None}
    for group, name in extra.items():
        columns = [*base[:1], *([name] if name else []), *(reversed(base[1:]) if group else base[1:])]
        named = rows.where(F.col("g") == group)
        if name:
            named = named.withColumn(name, F.col("pval"))
        sinks.write_export(named.select("phenotype", *columns), f"{root}/in{group}", "phenotype")
    t.view("v_rsid").write.parquet(f"{root}/variants")
    rows = readers.read_mapped_by_header(
        t.spark,
        f"{root}/in*/phenotype=*",
        jobs.same_names(jobs.LINEAR_ROWS),
        {"phenotype": _phenotype_folder()},
    )
    result = exports.linear_model_export(
        rows, readers.read_parquet(t.spark, f"{root}/variants"), t.view("v_phenotype")
    )
    sinks.write_export(result, f"{root}/out", "phenotype")
    back = readers.read_mapped_by_header(
        t.spark,
        f"{root}/out/phenotype=*",
        {"variant_id": ("variant_id", "string"), "AC": ("AC", "double"), "info": ("info", "double"),
         "expected_min_category_minor_AC": ("minor", "double"),
         "expected_case_minor_AC": ("cases", "double")},
        {"phenotype": _phenotype_folder()},
    )
    return back.select("phenotype", "variant_id", F.round("AC", 6).alias("AC"), "minor", "cases", "info")


@query("SELECT study_id, chrom, pos, ref, alt, beta, pval FROM v_gwas WHERE pval <= 0.5e0")
def publish_whole(t: Tables) -> DataFrame:
    """An output replaced as a whole, and a later run that fails its checks and changes nothing."""
    out = scratch_path(t.spark, "published")
    rows = t.view("v_gwas").select("study_id", "chrom", "pos", "ref", "alt", "beta", "pval")
    rules = [("pval is in range", F.col("pval") <= 0.5)]
    write = sinks.write_by_position
    publish.publish(rows.where("pval > 0.5D"), out, write)
    publish.publish(rows.where("pval <= 0.5D"), out, write, rules)
    try:
        publish.publish(rows, out, write, rules)
    except ValueError:
        return readers.read_parquet(t.spark, out)
    raise AssertionError("rows that break a rule were published")


@query(
    """WITH sized AS (SELECT study_id, se, eaf, 4000 * CASE WHEN eaf <= 0.5e0 THEN eaf ELSE 1e0-eaf END
        AS mac FROM v_gwas),
    counts AS (SELECT study_id, count(*) AS n0,
        count_if(se IS NOT NULL AND eaf IS NOT NULL) AS n1,
        count_if(se IS NOT NULL AND eaf IS NOT NULL AND mac >= 10) AS n3 FROM sized GROUP BY 1),
    gated AS (SELECT study_id, n0, n1, CASE WHEN study_id = 'GCSTR' THEN 0 ELSE n1 END AS n2,
        CASE WHEN study_id = 'GCSTR' THEN 0 ELSE n3 END AS n3 FROM counts)
    SELECT study_id, cast(step_no AS int) AS step_no, cast(n AS bigint) AS n_rows,
        cast(removed AS bigint) AS removed FROM (
        SELECT study_id, 0 AS step_no, n0 AS n, 0 AS removed FROM gated
        UNION ALL SELECT study_id, 1, n1, n0 - n1 FROM gated
        UNION ALL SELECT study_id, 2, n2, n1 - n2 FROM gated
        UNION ALL SELECT study_id, 3, n2, 0 FROM gated
        UNION ALL SELECT study_id, 4, n3, n2 - n3 FROM gated) t"""
)
def ingest_report(t: Tables) -> DataFrame:
    """Quality steps per study: missing errors as NaN, and one study too small to go on."""
    rows = t.view("v_gwas").drop("phenotype_id", "bio_feature", "gene_id", "oddsr", "oddsr_lower")
    odd = rows.withColumn(
        "se", F.when(F.col("pos") % 2 == 0, F.coalesce("se", F.lit(float("nan")))).otherwise(F.col("se"))
    )
    usable = rows.where("se IS NOT NULL AND eaf IS NOT NULL").groupBy("study_id").count()
    small = {r["study_id"]: r["count"] for r in usable.collect()}
    studies = rows.select("study_id").distinct().withColumns(
        {"n_total": F.lit(2000), "n_cases": F.lit(None).cast("int")}
    )
    # Everything but one study stays above a limit that only that study misses.
    kept = odd.where("study_id <> 'GCSTR'")
    others = gwas.ingest_report(kept, studies, None, min_rows=1)
    tiny = gwas.ingest_report(
        odd.where("study_id = 'GCSTR'"), studies, None, min_rows=small.get("GCSTR", 0) + 1
    )
    return others.unionByName(tiny).select("study_id", "step_no", "n_rows", "removed")


_INGESTED = """SELECT study_id, chrom, pos, ref, alt, beta, se, pval, n_total, eaf, is_cc FROM (
        SELECT study_id, chrom, pos, ref, alt, beta, se, pval, eaf,
            cast(2000 AS int) AS n_total, study_id = 'GCSTA' AS is_cc,
            4000 * CASE WHEN eaf <= 0.5e0 THEN eaf ELSE 1e0-eaf END AS mac FROM v_gwas
        WHERE se IS NOT NULL AND eaf IS NOT NULL) t
    WHERE mac >= 10"""


@query(_INGESTED)
def ingest_job(t: Tables) -> DataFrame:
    """Manifest to finished Parquet: a folder, a glob and an odd file name per study."""
    root = scratch_path(t.spark, "ingest")
    columns = ["study_id", "#chrom", "pos", "ref", "alt", "pval", "beta", "sebeta", "af_alt"]
    delivered = t.view("v_gwas").withColumnsRenamed(
        {"chrom": "#chrom", "se": "sebeta", "eaf": "af_alt"}
    )
    named = delivered.select(*[f"`{c}`" for c in columns])
    sinks.write_export(named.where("study_id <> 'GCSTR'"), f"{root}/in", "study_id")
    sinks.write_export(named.where("study_id = 'GCSTR'").drop("study_id"), f"{root}/in/odd 100%/part+1")
    place = ids.clean_path(F.lit(root))
    files = t.view("v_gwas").select("study_id").distinct().withColumn(
        "in_tsv",
        F.when(F.col("study_id") == "GCSTR", F.concat(place, F.lit("/in/odd 100%/part+1")))
        .when(F.col("study_id") == "GCSTA", F.concat(place, F.lit("/in/study_id=GCSTA/*.csv.{gz,bz2}")))
        .otherwise(F.concat(place, F.lit("/in/study_id="), "study_id")),
    )
    manifest = files.withColumns(
        {
            "n_total": F.lit(2000),
            "n_cases": F.when(F.col("study_id") == "GCSTA", F.lit(2000)),
        }
    )
    gwas.ingest(t.spark, manifest, None, f"{root}/out", readers.FINNISH_GWAS, min_rows=1)
    rows = readers.read_parquet(t.spark, f"{root}/out", schema.GWAS_SCHEMA)
    return rows.select(
        "study_id", "chrom", "pos", "ref", "alt", "beta", "se", "pval", "n_total", "eaf", "is_cc"
    )


@query(_INGESTED)
def stream_ingest(t: Tables) -> DataFrame:
    """Two manifests that arrive one after the other, with a run after each and one without news."""
    root = scratch_path(t.spark, "arrivals")
    delivered = t.view("v_gwas").withColumnsRenamed(
        {"chrom": "#chrom", "se": "sebeta", "eaf": "af_alt"}
    )
    columns = ["study_id", "#chrom", "pos", "ref", "alt", "pval", "beta", "sebeta", "af_alt"]
    sinks.write_export(delivered.select(*[f"`{c}`" for c in columns]), f"{root}/in", "study_id")
    lines = t.view("v_gwas").select("study_id").distinct().select(
        F.concat(ids.clean_path(F.lit(root)), F.lit("/in/study_id="), "study_id").alias("in_tsv"),
        "study_id",
        F.lit(2000).alias("n_total"),
        F.when(F.col("study_id") == "GCSTA", F.lit(2000)).alias("n_cases"),
    )
    for arrived in (F.col("study_id") == "GCSTA", F.col("study_id") != "GCSTA", None):
        if arrived is not None:
            lines.where(arrived).write.json(f"{root}/manifests", mode="append")
        arrivals.ingest_arrived(
            t.spark, f"{root}/manifests", None, f"{root}/out", f"{root}/state",
            readers.FINNISH_GWAS, min_rows=1,
        )
    return readers.read_parquet(t.spark, f"{root}/out", schema.GWAS_SCHEMA).select(
        "study_id", "chrom", "pos", "ref", "alt", "beta", "se", "pval", "n_total", "eaf", "is_cc"
    )
