"""Queries: study metadata, work lists, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan.functions import ids
from helixspan.functions.text import ANCESTRIES, SHADOWED_BY
from helixspan.operators import combine, qc, studies
from helixspan.plans import jobs
from helixspan.plans import studies as plans
from helixspan.registry.core import query
from helixspan.registry.views import Tables
from helixspan.session import scratch_path


def _sum_sql(condition: str) -> str:
    return f"""nullif(coalesce((SELECT sum(coalesce(try_cast(replace(
        regexp_extract(part, '([0-9,]+)', 1), ',', '') AS int), 0))
        FROM (SELECT unnest(string_split(sample_info, ', ')) AS part) x
        WHERE {condition}), 0), 0)"""


_SIZES = f"""cast({_sum_sql("part LIKE '%cases%'")} AS int) AS n_cases,
    cast({_sum_sql("part LIKE '%controls%' AND part NOT LIKE '%cases%'")} AS int) AS n_controls,
    cast({_sum_sql("part NOT LIKE '%controls%' AND part NOT LIKE '%cases%'")} AS int) AS n_quant"""


def _ancestry_sql() -> str:
    cases = []
    for pattern, label in ANCESTRIES:
        extra = (
            f" AND sample_info NOT LIKE '%{SHADOWED_BY[label]}%'" if label in SHADOWED_BY else ""
        )
        cases.append(f"CASE WHEN sample_info LIKE '%{pattern}%'{extra} THEN '{label}' END")
    return f"concat_ws(',', {', '.join(cases)})"


@query(f"SELECT study_id, {_SIZES} FROM v_study")
def sample_size_parse(t: Tables) -> DataFrame:
    return studies.add_sample_sizes(t.view("v_study")).select(
        "study_id", "n_cases", "n_controls", "n_quant"
    )


@query(f"SELECT study_id, {_ancestry_sql()} AS ancestries FROM v_study")
def ancestry_extract(t: Tables) -> DataFrame:
    return studies.add_ancestries(t.view("v_study")).select("study_id", "ancestries")


@query(
    """SELECT path, regexp_extract(path, 'GCST[0-9]+') AS found, split_part(path, '/', 3) AS segment,
        split_part(regexp_extract(path, '[^/]*$'), '.', 1) AS stem FROM v_paths"""
)
def study_id_extract(t: Tables) -> DataFrame:
    path = F.col("path")
    return t.view("v_paths").select(
        "path",
        ids.accession(path).alias("found"),
        ids.path_segment(path, 2).alias("segment"),
        ids.file_stem(path).alias("stem"),
    )


@query(
    """SELECT study_id, trait FROM v_study WHERE study_id NOT IN (
        SELECT regexp_extract(path, '/([^/]*)\\.parquet', 1) FROM v_completed)"""
)
def skip_completed(t: Tables) -> DataFrame:
    done = studies.completed_studies(t.view("v_completed"))
    return combine.not_done(t.view("v_study"), done).select("study_id", "trait")


_REPEATED = """repeated AS (SELECT study_id, trait FROM v_study
    UNION ALL SELECT study_id, 'copy' FROM v_study WHERE study_id LIKE '%7')"""


def _repeated(t: Tables) -> DataFrame:
    rows = t.view("v_study").select("study_id", "trait")
    return rows.unionByName(
        rows.where(F.col("study_id").endswith("7")).withColumn("trait", F.lit("copy"))
    )


@query(f"WITH {_REPEATED} SELECT study_id, count(*) AS n_rows FROM repeated GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(t: Tables) -> DataFrame:
    return combine.id_counts(_repeated(t))


@query(
    f"""WITH {_REPEATED} SELECT study_id, trait FROM repeated
    WHERE study_id IN (SELECT study_id FROM repeated GROUP BY 1 HAVING count(*) = 1)"""
)
def drop_repeated_ids(t: Tables) -> DataFrame:
    return combine.drop_repeated_ids(_repeated(t))


_PREVIOUS = """previous AS (SELECT CASE WHEN study_id LIKE '%5' THEN concat('GCSTX', study_id)
        ELSE study_id END AS study_id, note FROM v_curated WHERE note IS NOT NULL OR study_id LIKE '%5')"""
_DONE = """done AS (SELECT DISTINCT regexp_extract(path, 'GCST[0-9]+') AS study_id, '1' AS ingested
        FROM v_completed)"""


def _previous(t: Tables) -> DataFrame:
    rows = t.view("v_curated").where(
        F.col("note").isNotNull() | F.col("study_id").endswith("5")
    )
    renamed = F.when(
        F.col("study_id").endswith("5"), F.concat(F.lit("GCSTX"), "study_id")
    ).otherwise(F.col("study_id"))
    return rows.select(renamed.alias("study_id"), "note")


@query(
    f"""WITH {_PREVIOUS}, {_DONE},
    merged AS (SELECT s.study_id, s.trait, p.note FROM v_study s LEFT JOIN previous p USING (study_id)
        UNION ALL SELECT study_id, NULL, note FROM previous
        WHERE study_id NOT IN (SELECT study_id FROM v_study))
    SELECT m.*, d.ingested FROM merged m LEFT JOIN done d USING (study_id)"""
)
def metadata_merge(t: Tables) -> DataFrame:
    done = t.view("v_completed").select(ids.accession(F.col("path")).alias("study_id"))
    current = t.view("v_study").select("study_id", "trait")
    return studies.finished_last(studies.merge_metadata(current, _previous(t), done))


@query(
    f"""WITH {_PREVIOUS}, {_DONE},
    described AS (SELECT concat('/summary/', study_id, '/harmonised/', study_id, '.h.tsv.gz')
        AS gwascat_path, study_id, pmid, trait, sample_info, {_SIZES} FROM v_study),
    merged AS (SELECT s.*, p.note FROM described s LEFT JOIN previous p USING (study_id)
        UNION ALL SELECT NULL, study_id, NULL, NULL, NULL, NULL, NULL, NULL, note FROM previous
        WHERE study_id NOT IN (SELECT study_id FROM v_study))
    SELECT m.study_id, gwascat_path, pmid, trait, sample_info, n_cases, n_controls, n_quant,
        d.ingested, '' AS to_ingest, {_ancestry_sql()} AS ancestries, note
    FROM merged m LEFT JOIN done d USING (study_id)"""
)
def pipeline_metadata(t: Tables) -> DataFrame:
    paths = t.view("v_paths").withColumnRenamed("path", "gwascat_path")
    return plans.metadata_table(paths, t.view("v_study"), _previous(t), t.view("v_completed"))


@query(
    """SELECT concat('/raw/', study_id, '.h.tsv.gz') AS in_tsv, '/af' AS in_af,
        concat('/out/', study_id, '.parquet') AS out_parquet, study_id,
        cast(coalesce(n_cases,0)+coalesce(n_controls,0)+coalesce(n_quant,0) AS int) AS n_total,
        n_cases, concat('/log/', study_id, '.log') AS log
    FROM v_curated WHERE to_ingest = '1' AND study_id NOT LIKE '%9'
        AND study_id NOT IN (SELECT regexp_extract(path, 'GCST[0-9]+') FROM v_completed)"""
)
def manifest_build(t: Tables) -> DataFrame:
    inputs = t.view("v_curated").where(~F.col("study_id").endswith("9")).select(
        F.concat(F.lit("/raw/"), "study_id", F.lit(".h.tsv.gz")).alias("path")
    )
    return plans.gwas_manifest(
        t.view("v_curated"), inputs, t.view("v_completed"), "/raw/", "/af", "/out/", "/log/"
    )


@query(
    """SELECT 'n_cases and n_controls come together' AS rule, cast(count_if(
        (n_cases IS NULL) <> (n_controls IS NULL)) AS bigint) AS n_rows FROM v_curated
    UNION ALL SELECT 'either n_cases or n_quant', cast(count_if(
        (n_cases IS NULL) = (n_quant IS NULL)) AS bigint) FROM v_curated
    UNION ALL SELECT 'study_id is unique', cast(0 AS bigint)"""
)
def manifest_violations(t: Tables) -> DataFrame:
    return qc.violations(t.view("v_curated"), qc.manifest_rules(), "study_id")


@query(
    """WITH s AS (SELECT cast(count(*) AS bigint) AS n, cast(count_if(ingested = '1') AS bigint) AS i,
        cast(count_if(to_ingest = '1') AS bigint) AS w FROM v_curated),
    m AS (SELECT cast(count(*) AS bigint) AS x FROM v_curated
        WHERE to_ingest = '1' AND study_id NOT LIKE '%3')
    SELECT i AS n_ingested, w AS n_to_ingest, n-i-w AS n_excluded, x AS n_written,
        w-x AS n_not_written FROM s, m"""
)
def worklist_status(t: Tables) -> DataFrame:
    curated = t.view("v_curated").withColumn("to_ingest", F.col("to_ingest").try_cast("int"))
    written = curated.where((F.col("to_ingest") == 1) & ~F.col("study_id").endswith("3"))
    return studies.work_status(curated, written)



@query(
    """SELECT concat('/in/finngen_R6_', phenocode, '.gz') AS in_tsv,
        concat('/out/R6_', phenocode, '.parquet') AS out_parquet,
        concat('R6_', phenocode) AS study_id, num_cases+num_controls AS n_total,
        num_cases AS n_cases FROM v_endpoint
    WHERE num_cases%5 <> 0 AND NOT phenocode LIKE 'C3%'"""
)
def manifest_endpoints(t: Tables) -> DataFrame:
    endpoints = t.view("v_endpoint")
    paths = endpoints.where(~F.col("phenocode").startswith("C3")).select(
        F.concat(F.lit("/in/finngen_R6_"), "phenocode", F.lit(".gz")).alias("path")
    )
    done = endpoints.where("num_cases%5 = 0").select(
        F.concat(F.lit("/out/R6_"), "phenocode", F.lit(".parquet/_SUCCESS")).alias("path")
    )
    return plans.finnish_manifest(endpoints, paths, done, "R6_", "finngen_R6_", "/out/")


# Codes of the linear release, half of them under unwanted prefixes; numbers with separators.
_LINEAR = """linear AS (SELECT concat(CASE WHEN p_partkey%4=0 THEN '20024_' WHEN p_partkey%4=1
        THEN '670_' ELSE '50_' END, cast(p_partkey AS varchar(20))) AS phenotype,
        p_name AS description, cast(p_partkey+5000 AS int) AS n_non_missing,
        CASE WHEN p_partkey%3=0 THEN cast(p_size AS int) END AS n_cases,
        CASE WHEN p_partkey%6=0 THEN cast(p_size%7 AS int) END AS n_controls FROM part)"""
_MIXED = """mixed AS (SELECT concat(cast(p_partkey AS varchar(20)), '.1') AS "PheCode",
        p_name AS "Phenotype Description", p_type AS "Phenotype Category",
        concat('1,', lpad(cast(p_partkey%1000 AS varchar(20)), 3, '0')) AS "Number of cases",
        '400,000' AS "Number of controls" FROM part)"""


@query(
    f"""WITH {_LINEAR}, {_MIXED},
    codes AS (SELECT concat('NEALE2_', phenotype) AS code, description AS trait,
            n_non_missing AS n_total, CASE WHEN n_cases IS NOT NULL AND n_controls IS NOT NULL
            THEN least(n_cases, n_controls) END AS n_cases,
            concat('/in/', phenotype, '.neale2.split*.gz') AS in_path FROM linear
        UNION ALL SELECT concat('SAIGE_', replace("PheCode", '.', '_')), "Phenotype Description",
            cast(replace("Number of cases", ',', '') AS int) + 400000,
            cast(replace("Number of cases", ',', '') AS int),
            concat('/in/PheCode_', "PheCode", '_SAIGE_Nov2017_x.gz') FROM mixed)
    SELECT in_path AS in_tsv, '/af' AS in_af, concat('/out/', code, '.parquet') AS out_parquet,
        code AS study_id, n_total, n_cases FROM codes
    WHERE code NOT LIKE 'NEALE2\\_20024\\_%' ESCAPE '\\' AND code NOT LIKE 'NEALE2\\_670\\_%' ESCAPE '\\'
        AND code NOT LIKE '%7'"""
)
def manifest_biobank(t: Tables) -> DataFrame:
    part = t.base("part")
    linear = part.selectExpr(
        "concat(case when p_partkey%4=0 then '20024_' when p_partkey%4=1 then '670_'"
        " else '50_' end, cast(p_partkey as string)) AS phenotype",
        "p_name AS description",
        "cast(p_partkey+5000 as int) AS n_non_missing",
        "case when p_partkey%3=0 then cast(p_size as int) end AS n_cases",
        "case when p_partkey%6=0 then cast(p_size%7 as int) end AS n_controls",
    )
    mixed = part.selectExpr(
        "concat(cast(p_partkey as string), '.1') AS PheCode",
        "p_name AS `Phenotype Description`",
        "p_type AS `Phenotype Category`",
        "concat('1,', lpad(cast(p_partkey%1000 as string), 3, '0')) AS `Number of cases`",
        "'400,000' AS `Number of controls`",
    )
    paths = linear.selectExpr("concat('/in/', phenotype, '.neale2.split000.gz') AS path").union(
        mixed.selectExpr("concat('/in/PheCode_', PheCode, '_SAIGE_Nov2017_x.gz') AS path")
    )
    phenotypes = plans.biobank_phenotypes(paths, linear, mixed)
    done = phenotypes.where(F.col("code").endswith("7")).select(
        F.concat(F.lit("/out/"), "code", F.lit(".parquet/_SUCCESS")).alias("path")
    )
    return plans.biobank_manifest(phenotypes, done, "/af", "/out/")


@query(
    """SELECT code FROM (SELECT concat('NEALE2_', cast(p_partkey AS varchar(20)), '_',
        cast(p_size AS varchar(20))) AS code FROM part) t
    WHERE code NOT LIKE 'NEALE2\\_670\\_%' ESCAPE '\\' AND code NOT LIKE 'NEALE2\\_680\\_%' ESCAPE '\\'
      AND code NOT LIKE 'NEALE2\\_2654\\_%' ESCAPE '\\' AND code NOT LIKE 'NEALE2\\_6144\\_%' ESCAPE '\\'
      AND code NOT LIKE 'NEALE2\\_6140\\_%' ESCAPE '\\' AND code NOT LIKE 'NEALE2\\_6141\\_%' ESCAPE '\\'
      AND code NOT LIKE 'NEALE2\\_6142\\_%' ESCAPE '\\' AND code NOT LIKE 'NEALE2\\_6160\\_%' ESCAPE '\\'
      AND code NOT LIKE 'NEALE2\\_3446\\_%' ESCAPE '\\' AND code NOT LIKE 'NEALE2\\_2____\\_%' ESCAPE '\\'
      AND code NOT LIKE 'NEALE2\\_41248\\_%' ESCAPE '\\'"""
)
def prefix_exclude(t: Tables) -> DataFrame:
    codes = t.base("part").selectExpr(
        "concat('NEALE2_', cast(p_partkey as string), '_', cast(p_size as string)) AS code"
    )
    return combine.without_prefixes(codes, "code", studies.BIOBANK_EXCLUDED)


@query(
    """SELECT study_id, upper(qtl_group) AS qtl_group, upper(quant_method) AS quant_method,
        concat('/in/', qtl_group, '_', cast(c_custkey AS varchar), '.tsv.gz') AS in_nominal,
        concat('/out/', study_id, '.parquet') AS out_parquet FROM (
        SELECT c_custkey, CASE WHEN c_custkey%10=0 THEN 'GTEx-eQTL' ELSE concat('Study_',
            cast(c_custkey%40 AS varchar)) END AS study_id, lower(c_mktsegment) AS qtl_group,
            CASE c_custkey%3 WHEN 0 THEN 'ge' WHEN 1 THEN 'microarray' ELSE 'exon' END
            AS quant_method FROM customer) t
    WHERE quant_method <> 'exon' AND study_id <> 'Study_7'"""
)
def manifest_eqtl(t: Tables) -> DataFrame:
    table = t.base("customer").selectExpr(
        "case when c_custkey%10=0 then 'GTEx' else concat('Study_', cast(c_custkey%40 as string))"
        " end AS study",
        "lower(c_mktsegment) AS qtl_group",
        "case c_custkey%3 when 0 then 'ge' when 1 then 'microarray' else 'exon' end AS quant_method",
        "concat('ftp://x/y/', lower(c_mktsegment), '_', cast(c_custkey as string), '.tsv.gz')"
        " AS ftp_path",
    )
    done = table.where("study = 'Study_7'").selectExpr(
        "concat('/out/', study, '.parquet/_SUCCESS') AS path"
    )
    return plans.eqtl_manifest(table, done, "/in/", "/out/")


@query(
    """SELECT DISTINCT 'GTEx-sQTL' AS study_id, c_mktsegment AS qtl_group,
        concat('/in/', c_mktsegment, '.chr*.parquet') AS in_nominal, '/panel' AS in_varindex,
        '/out/GTEx-sQTL.parquet' AS out_parquet,
        concat('/log/GTEx-sQTL_', c_mktsegment, '.txt') AS out_log FROM customer"""
)
def manifest_sqtl(t: Tables) -> DataFrame:
    tissues = t.base("customer").select(F.col("c_mktsegment").alias("qtl_group")).distinct()
    return plans.sqtl_manifest(
        tissues, "GTEx-sQTL", "/in/", ".chr*.parquet", "/panel", "/out/", "/log/"
    )


@query(
    """SELECT DISTINCT 'sQTL' AS study_id, replace(c_mktsegment, ' ', '_') AS qtl_group,
        concat('/in/', replace(c_mktsegment, ' ', '_'), '.v1.chr*.parquet') AS in_nominal,
        '/panel' AS in_varindex, '/out/sQTL.parquet' AS out_parquet,
        concat('/log/sQTL_', replace(c_mktsegment, ' ', '_'), '.txt') AS out_log FROM customer"""
)
def manifest_sqtl_job(t: Tables) -> DataFrame:
    """From a list of paths to JSON lines; files of other kinds are in the list as well."""
    root = scratch_path(t.spark, "sqtl-manifest")
    tissue = F.replace("c_mktsegment", F.lit(" "), F.lit("_"))
    chrom = (F.col("c_custkey") % 22 + 1).cast("string")
    names = t.base("customer").select(
        F.explode(F.array(
            F.concat(F.lit("/in/"), tissue, F.lit(".v1.chr"), chrom, F.lit(".parquet")),
            F.concat(F.lit("/in/"), tissue, F.lit("_other.v1.genes.txt")),
        ))
    )
    names.write.text(f"{root}/paths")
    jobs.sqtl_manifest(
        t.spark, f"{root}/paths", f"{root}/out", "sQTL", "/in/", ".v1.chr*.parquet", "/panel", "/out/", "/log/"
    )
    fields = "study_id string, qtl_group string, in_nominal string, in_varindex string, out_parquet string, out_log string"
    return t.spark.read.schema(fields).json(f"{root}/out")


@query(
    """SELECT concat('/x/gwas/', study_id, '.parquet') AS in_path, 'gwas' AS data_type,
        concat(study_id, '.parquet') AS study FROM v_study
    WHERE study_id NOT IN (SELECT regexp_extract(path, 'GCST[0-9]+') FROM v_completed)"""
)
def window_jobs(t: Tables) -> DataFrame:
    paths = t.view("v_study").select(
        F.concat(F.lit("/x/gwas/"), "study_id", F.lit(".parquet/_SUCCESS")).alias("path")
    )
    return plans.window_jobs(paths, t.view("v_completed"))


@query(
    """SELECT code, sex FROM (SELECT CASE WHEN p_partkey%9=0 THEN NULL ELSE concat(
        CASE WHEN p_partkey%4=0 THEN 'I' ELSE '' END, cast(p_partkey AS varchar),
        CASE WHEN p_partkey%5=0 THEN '_irnt' ELSE '' END) END AS code,
        CASE WHEN p_size%2=0 THEN 'both_sexes' ELSE 'female' END AS sex FROM part) t
    WHERE sex = 'both_sexes' AND code IS NOT NULL AND code NOT LIKE '%_irnt'
        AND regexp_matches(code, '^[0-9]')"""
)
def phenotype_filter(t: Tables) -> DataFrame:
    rows = t.base("part").selectExpr(
        "case when p_partkey%9=0 then null else concat(case when p_partkey%4=0 then 'I' else '' end,"
        " cast(p_partkey as string), case when p_partkey%5=0 then '_irnt' else '' end) end AS code",
        "case when p_size%2=0 then 'both_sexes' else 'female' end AS sex",
    )
    return studies.phenotype_filter(rows, "code", "sex")
