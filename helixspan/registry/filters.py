"""Queries: filters, gates, windows, quality reports, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan import schema
from helixspan.functions import ids
from helixspan.operators import combine, harmonise, layout, qc, qtl, window_updates, windows
from helixspan.plans import extract, gwas
from helixspan.registry.core import query
from helixspan.registry.views import Tables

WIDTH = 5000
P_WINDOW = 0.0005


@query("SELECT study_id, chrom, pos, ref, alt, pval FROM v_gwas WHERE pval <= 0.005e0")
def sig_filter_gwas(t: Tables) -> DataFrame:
    return qc.p_at_most(t.view("v_gwas"), 0.005).select(
        "study_id", "chrom", "pos", "ref", "alt", "pval"
    )


@query(
    """WITH tests AS (SELECT bio_feature, phenotype_id, count(pval) AS num_tests
       FROM v_qtl GROUP BY 1, 2)
    SELECT q.bio_feature, q.phenotype_id, q.chrom, q.pos, q.pval,
           cast(num_tests AS int) AS num_tests
    FROM v_qtl q JOIN tests USING (bio_feature, phenotype_id)
    WHERE q.pval <= 0.05e0 / num_tests"""
)
def sig_filter_bonferroni(t: Tables) -> DataFrame:
    tested = qtl.add_num_tests(t.view("v_qtl"), ["bio_feature", "phenotype_id"])
    return tested.where(windows.significant("molecular_trait")).select(
        "bio_feature", "phenotype_id", "chrom", "pos", "pval", "num_tests"
    )


def _hits(t: Tables) -> DataFrame:
    return t.view("v_gwas").where(windows.significant("gwas", P_WINDOW))


_MERGED = f"""hits AS (SELECT study_id, phenotype_id, bio_feature, chrom, pos FROM v_gwas
      WHERE pval <= {P_WINDOW}e0),
    marked AS (SELECT *, CASE WHEN pos - {WIDTH} > max(pos + {WIDTH}) OVER (
        PARTITION BY study_id, phenotype_id, bio_feature, chrom ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM hits),
    islands AS (SELECT *, sum(fresh) OVER (
        PARTITION BY study_id, phenotype_id, bio_feature, chrom ORDER BY pos
        ROWS UNBOUNDED PRECEDING) AS island FROM marked),
    merged AS (SELECT study_id, phenotype_id, bio_feature, chrom,
        greatest(min(pos) - {WIDTH}, 0) AS "start", max(pos) + {WIDTH} AS "end"
        FROM islands GROUP BY study_id, phenotype_id, bio_feature, chrom, island)"""


@query(f"WITH {_MERGED} SELECT * FROM merged")
def interval_merge(t: Tables) -> DataFrame:
    return windows.merge_windows(_hits(t), WIDTH)


_COLUMNS = ["study_id", "chrom", "pos", "ref", "alt", "beta", "pval"]
_NEAR = f"""FROM (SELECT *, min(pval) OVER (
        PARTITION BY study_id, phenotype_id, bio_feature, chrom ORDER BY pos
        RANGE BETWEEN {WIDTH} PRECEDING AND {WIDTH} FOLLOWING) AS near_p FROM v_gwas) framed
    WHERE near_p <= {P_WINDOW}e0"""


@query(f"SELECT {', '.join(_COLUMNS)} {_NEAR}")
def window_extract_join(t: Tables) -> DataFrame:
    kept, _ = windows.extract_windows(t.view("v_gwas"), WIDTH, "gwas", P_WINDOW)
    return kept.select(_COLUMNS)


@query(f"SELECT {', '.join(_COLUMNS)} {_NEAR}")
def window_update(t: Tables) -> DataFrame:
    """Windows of one delivery, brought up to date with a second one that has all other rows."""
    rows = t.view("v_gwas")
    second = F.pmod(F.xxhash64("study_id", "chrom", "pos", "ref", "alt"), F.lit(4)) == 0
    earlier, new = rows.where(~F.coalesce(second, F.lit(False))), rows.where(second)
    kept, intervals = windows.extract_windows(earlier, WIDTH, "gwas", P_WINDOW)
    found, _ = window_updates.update_windows(new, earlier, kept, intervals, WIDTH, P_WINDOW)
    return found.select(_COLUMNS)


@query(f"SELECT {', '.join(_COLUMNS)} {_NEAR}")
def window_extract_range(t: Tables) -> DataFrame:
    hit = windows.significant("gwas", P_WINDOW)
    return windows.keep_near_by_frame(t.view("v_gwas"), hit, WIDTH).select(_COLUMNS)


@query(f"SELECT DISTINCT {', '.join(_COLUMNS)} {_NEAR}")
def window_extract_theta(t: Tables) -> DataFrame:
    return windows.keep_near(t.view("v_gwas").select(*windows.KEYS, *_COLUMNS[2:]), _hits(t), WIDTH).select(
        _COLUMNS
    )


@query(
    f"""WITH tests AS (SELECT study_id, bio_feature, phenotype_id, count(pval) AS n
        FROM v_qtl GROUP BY 1, 2, 3),
    rated AS (SELECT q.*, CASE WHEN q.pval <= 0.05e0 / n THEN 1 ELSE 0 END AS hit
        FROM v_qtl q JOIN tests USING (study_id, bio_feature, phenotype_id)),
    framed AS (SELECT *, max(hit) OVER (
        PARTITION BY study_id, phenotype_id, bio_feature, chrom ORDER BY pos
        RANGE BETWEEN {WIDTH} PRECEDING AND {WIDTH} FOLLOWING) AS near_hit FROM rated)
    SELECT study_id, phenotype_id, bio_feature, chrom, pos, pval FROM framed WHERE near_hit = 1"""
)
def window_extract_molecular(t: Tables) -> DataFrame:
    tested = qtl.add_num_tests(t.view("v_qtl"), ["study_id", "bio_feature", "phenotype_id"])
    kept, _ = windows.extract_windows(tested, WIDTH, "molecular_trait")
    return kept.select(*windows.KEYS, "pos", "pval")


@query(
    f"""WITH {_MERGED}
    SELECT count(*) AS n_intervals, cast(1 AS bigint) AS n_features,
        cast(greatest(ceil(count(*) / 10e0), 1) AS int) AS n_partitions FROM merged"""
)
def partition_plan(t: Tables) -> DataFrame:
    return windows.partition_plan(windows.merge_windows(_hits(t), WIDTH))


@query(
    """SELECT 'study_id' AS column_name, cast(count_if(study_id IS NULL) AS bigint) AS nulls FROM v_gwas
    UNION ALL SELECT 'phenotype_id', count_if(phenotype_id IS NULL) FROM v_gwas
    UNION ALL SELECT 'se', count_if(se IS NULL) FROM v_gwas
    UNION ALL SELECT 'oddsr', count_if(oddsr IS NULL) FROM v_gwas
    UNION ALL SELECT 'oddsr_lower', count_if(oddsr_lower IS NULL) FROM v_gwas
    UNION ALL SELECT 'eaf', count_if(eaf IS NULL) FROM v_gwas"""
)
def null_profile(t: Tables) -> DataFrame:
    columns = ["study_id", "phenotype_id", "se", "oddsr", "oddsr_lower", "eaf"]
    return qc.null_profile(t.view("v_gwas").select(columns))


_COUNTED = """sized AS (SELECT *, 1000 AS n_total,
        CASE WHEN study_id = 'GCSTA' THEN 30 END AS n_cases FROM v_gwas),
    counted AS (SELECT *, n_total*2*CASE WHEN eaf <= 0.5e0 THEN eaf ELSE 1e0-eaf END AS mac,
        n_cases*2*CASE WHEN eaf <= 0.5e0 THEN eaf ELSE 1e0-eaf END AS mac_cases FROM sized)"""


def _counted(t: Tables) -> DataFrame:
    sized = t.view("v_gwas").withColumns(
        {
            "n_total": F.lit(1000),
            "n_cases": F.when(F.col("study_id") == "GCSTA", F.lit(30)),
        }
    )
    return qc.add_gwas_counts(sized)


@query(
    f"""WITH {_COUNTED}
    SELECT study_id, chrom, pos, pval, eaf, mac, mac_cases FROM counted
    WHERE mac >= 10 AND (mac_cases >= 10 OR mac_cases IS NULL)"""
)
def mac_filter_gwas(t: Tables) -> DataFrame:
    kept = qc.gwas_count_filter(_counted(t), 10)
    return kept.select("study_id", "chrom", "pos", "pval", "eaf", "mac", "mac_cases")


@query(
    f"""WITH {_COUNTED},
    flags AS (SELECT 1 AS f0, CASE WHEN se IS NOT NULL THEN 1 ELSE 0 END AS f1,
        CASE WHEN se IS NOT NULL AND eaf IS NOT NULL THEN 1 ELSE 0 END AS f2,
        CASE WHEN se IS NOT NULL AND eaf IS NOT NULL AND mac >= 10
             AND (mac_cases >= 10 OR mac_cases IS NULL) THEN 1 ELSE 0 END AS f3 FROM counted),
    sums AS (SELECT cast(sum(f0) AS bigint) AS n0, cast(sum(f1) AS bigint) AS n1,
        cast(sum(f2) AS bigint) AS n2, cast(sum(f3) AS bigint) AS n3 FROM flags)
    SELECT 0 AS step_no, 'input' AS step, n0 AS n_rows, cast(0 AS bigint) AS removed,
        0e0 AS removed_pct FROM sums
    UNION ALL SELECT 1, 'required columns', n1, n0-n1, round((n0-n1)*100e0/n0, 2) FROM sums
    UNION ALL SELECT 2, 'allele frequency', n2, n1-n2, round((n1-n2)*100e0/n0, 2) FROM sums
    UNION ALL SELECT 3, 'minor allele count', n3, n2-n3, round((n2-n3)*100e0/n0, 2) FROM sums"""
)
def qc_report(t: Tables) -> DataFrame:
    return qc.qc_report(_counted(t), gwas.qc_steps(10))


@query(
    """SELECT study_id, chrom, pos, pval FROM v_gwas WHERE study_id IN (
        SELECT study_id FROM v_gwas GROUP BY study_id
        HAVING count(*) * 4 >= (SELECT count(*) FROM v_gwas))"""
)
def min_rows_gate(t: Tables) -> DataFrame:
    rows = t.view("v_gwas")
    quarter = -(-rows.count() // 4)
    return qc.min_rows_gate(rows, quarter).select("study_id", "chrom", "pos", "pval")


@query(
    """SELECT study_id, chrom, pos, se, eaf FROM v_gwas
    WHERE se IS NOT NULL AND eaf IS NOT NULL AND NOT low_confidence_variant"""
)
def complete_rows(t: Tables) -> DataFrame:
    confident = qc.confident_only(t.view("v_gwas"))
    return qc.complete(confident, ["se", "eaf"]).select("study_id", "chrom", "pos", "se", "eaf")


@query(
    """SELECT bad AS chrom, count(*) AS n_rows FROM (
        SELECT CASE WHEN pos%50=0 THEN 'chr1' WHEN pos%70=0 THEN '23' ELSE chrom END AS bad
        FROM v_gwas) t WHERE bad IN ('chr1', '23') GROUP BY bad"""
)
def chromosome_check(t: Tables) -> DataFrame:
    mixed = t.view("v_gwas").withColumn(
        "chrom",
        F.when(F.col("pos") % 50 == 0, "chr1")
        .when(F.col("pos") % 70 == 0, "23")
        .otherwise(F.col("chrom")),
    )
    bad = schema.unknown_chromosomes(mixed)
    return bad.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT chrom_b38, pos_b38, ref, alt FROM v_panel WHERE chrom_b38 IN ('2', '5')")
def panel_subset(t: Tables) -> DataFrame:
    subset = gwas.panel_subset(t.panel(), ["2", "5"])
    return layout.by_position(subset, None, "chrom_b38", "pos_b38").select(
        "chrom_b38", "pos_b38", "ref", "alt"
    )


_GWAS_ROW = """SELECT 'gwas' AS type_id, study_id, chrom, pos, ref, alt, beta, se, pval,
    cast(1000 AS int) AS n_total, cast(NULL AS int) AS n_cases, eaf,
    cast(NULL AS double) AS mac, cast(NULL AS double) AS mac_cases, info,
    false AS is_cc FROM v_gwas"""
_QTL_ROW = """SELECT 'eqtl' AS {type}, study_id, phenotype_id, bio_feature, gene_id, chrom, pos,
    ref, alt, beta, se, pval, cast(100 AS int) AS n_total, cast(NULL AS int) AS n_cases,
    maf AS eaf, ma_count AS mac, cast(NULL AS int) AS mac_cases,
    cast(7 AS int) AS num_tests, r2 AS info, false AS is_cc FROM v_qtl"""


def _gwas_table(t: Tables) -> DataFrame:
    rows = t.view("v_gwas").withColumns(
        {
            "type": F.lit("gwas"),
            "n_total": F.lit(1000),
            "gene_id": F.lit(None).cast("string"),
            "is_cc": F.lit(False),
        }
    )
    return schema.conform(rows, schema.GWAS_SCHEMA)


def _qtl_table(t: Tables) -> DataFrame:
    rows = t.view("v_qtl").withColumns(
        {
            "type": F.lit("eqtl"),
            "n_total": F.lit(100),
            "eaf": F.col("maf"),
            "mac": F.col("ma_count"),
            "num_tests": F.lit(7),
            "info": F.col("r2"),
            "is_cc": F.lit(False),
        }
    )
    return schema.conform(rows, schema.QTL_SCHEMA)


@query(f"{_GWAS_ROW} WHERE pval <= 0.005e0")
def pipeline_pvalue_gwas(t: Tables) -> DataFrame:
    return extract.filter_gwas(_gwas_table(t), 0.005)


@query(
    f"""SELECT * FROM ({_QTL_ROW.format(type='type_id')} WHERE pval <= 0.005e0) a
    UNION ALL SELECT * FROM ({_QTL_ROW.format(type='type_id').replace("'eqtl'", "'sqtl'")}
    WHERE pval <= 0.005e0 AND bio_feature = 'F') b"""
)
def pipeline_pvalue_molecular(t: Tables) -> DataFrame:
    first = _qtl_table(t)
    second = first.where(F.col("bio_feature") == "F").withColumn("type", F.lit("sqtl"))
    return extract.filter_molecular([first, second], 0.005)


@query(
    """SELECT * FROM (SELECT study_id, phenotype_id, gene_id, chrom, pos, pval, 'gwas' AS type
        FROM (SELECT study_id, phenotype_id, cast(NULL AS varchar) AS gene_id, chrom, pos, pval
              FROM v_gwas) g) a
    UNION ALL SELECT study_id, phenotype_id, gene_id, chrom, pos, pval, 'eqtl' FROM v_qtl
    UNION ALL SELECT study_id, phenotype_id, gene_id, chrom, pos, pval, 'sqtl' FROM v_qtl
        WHERE bio_feature = 'F'"""
)
def union_all(t: Tables) -> DataFrame:
    first = _qtl_table(t).withColumn("mac", F.col("mac").cast("double"))
    first = first.withColumn("mac_cases", F.col("mac_cases").cast("double"))
    second = first.where(F.col("bio_feature") == "F").withColumn("type", F.lit("sqtl"))
    return extract.union_datasets(_gwas_table(t), [first, second]).select(
        "study_id", "phenotype_id", "gene_id", "chrom", "pos", "pval", "type"
    )


@query(
    f"""SELECT * FROM ({_GWAS_ROW} WHERE pval <= 0.001e0 AND study_id = 'GCSTA') done
    UNION ALL SELECT * FROM ({_GWAS_ROW} WHERE pval <= 0.005e0 AND study_id <> 'GCSTA') fresh"""
)
def incremental_union(t: Tables) -> DataFrame:
    table = _gwas_table(t)
    earlier = table.where(F.col("study_id") == "GCSTA")
    finished = extract.filter_gwas(earlier, 0.001)
    return extract.filter_gwas(table, 0.005, finished, earlier.select("study_id"))


@query(
    """SELECT study_id, bio_feature, gene_id, pval FROM v_qtl
    UNION ALL SELECT study_id, cast(NULL AS varchar), gene_id, pval FROM v_gwas"""
)
def union_missing_columns(t: Tables) -> DataFrame:
    first = t.view("v_qtl").select("study_id", "bio_feature", "gene_id", "pval")
    second = t.view("v_gwas").select("pval", "gene_id", "study_id")
    return combine.union_all([first, second], True)


@query(
    """SELECT bio_feature, cast(sum(n) AS bigint) AS n_raw, count(*) AS n_dedup FROM (
        SELECT bio_feature, phenotype_id, chrom, pos, ref, alt, count(*) AS n FROM (
            SELECT bio_feature, phenotype_id, chrom, pos, ref, alt, rsid FROM v_qtl
            UNION ALL SELECT bio_feature, phenotype_id, chrom, pos, ref, alt, 'rsX' FROM v_qtl
                WHERE pos%4 = 0) u
        GROUP BY 1, 2, 3, 4, 5, 6) g GROUP BY bio_feature"""
)
def copy_counts(t: Tables) -> DataFrame:
    return harmonise.copy_counts(_with_copies(t), "bio_feature")


@query(
    "SELECT DISTINCT bio_feature, phenotype_id, chrom, pos, ref, alt FROM v_qtl",
)
def dedup_rsid(t: Tables) -> DataFrame:
    return harmonise.drop_rsid_copies(_with_copies(t))


def _with_copies(t: Tables) -> DataFrame:
    rows = t.view("v_qtl").select(
        "bio_feature", "phenotype_id", "chrom", "pos", "ref", "alt", "rsid"
    )
    return rows.unionByName(rows.where("pos%4 = 0").withColumn("rsid", F.lit("rsX")))


@query(
    """SELECT CASE WHEN o_orderkey%2=0 THEN 'molecular_trait' ELSE 'gwas' END AS data_type,
        count(*) AS n_sets FROM orders GROUP BY 1"""
)
def data_type_from_path(t: Tables) -> DataFrame:
    paths = t.base("orders").selectExpr(
        "concat('/x/', case when o_orderkey%2=0 then 'molecular_trait' else 'gwas' end,"
        " '/s', cast(o_orderkey as string), '.parquet') AS path"
    )
    typed = paths.select(ids.data_type_of_path(F.col("path")).alias("data_type"))
    return typed.groupBy("data_type").agg(F.count(F.lit(1)).alias("n_sets"))
