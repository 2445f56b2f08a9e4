"""Association-like views over the given tables.

Every view is a dictionary of SQL expressions that Spark and DuckDB read alike, so the
queries and their SQL oracles start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_REF = "substr('ACGT', cast(l_partkey%4 as int)+1, 1)"
_ALT = "substr('ACGT', cast((l_partkey%4 + 1 + l_suppkey%3)%4 as int)+1, 1)"
_CHROM = "cast(l_linenumber as string)"
# Positions stay within the length of a chromosome at any table size.
_PLACE = "(l_orderkey*37 + l_partkey%37)%200000000"
_POS = f"cast({_PLACE} as int)"
_PVAL = (
    "cast((l_partkey*7919 + l_suppkey*104729 + l_orderkey*31)%100003 as double)/100003e0"
)
_GENE = "concat('ENSG', lpad(cast(l_suppkey as string),11,'0'))"
_NULL = "cast(null as string)"
_STUDY = "concat('GCST', lpad(cast(c_custkey as string),10,'0'))"

# view -> (table, columns, optional filter, distinct)
VIEWS: dict[str, tuple[str, dict[str, str], str | None, bool]] = {
    "v_gwas": (
        "lineitem",
        {
            "study_id": "concat('GCST', l_returnflag)",
            "phenotype_id": _NULL,
            "bio_feature": _NULL,
            "gene_id": "concat('G', cast(l_suppkey as string))",
            "chrom": _CHROM,
            "pos": _POS,
            "ref": _REF,
            "alt": _ALT,
            "beta": "(l_quantity-25.5e0)/10e0",
            "se": "case when l_suppkey%10=0 then cast(null as double) else l_discount+0.01e0 end",
            "pval": _PVAL,
            "oddsr": "case when l_partkey%3=0 then l_quantity/10e0 end",
            "oddsr_lower": "case when l_partkey%6=0 then l_quantity/20e0 end",
            "eaf": "case when l_partkey%5=0 then cast(null as double) "
            "else cast(l_partkey%100 as double)/100e0 end",
            "info": "l_tax",
            "low_confidence_variant": "l_linestatus='F'",
        },
        None,
        False,
    ),
    "v_panel": (
        "lineitem",
        {
            "chrom_b37": _CHROM,
            "pos_b37": _POS,
            "chrom_b38": _CHROM,
            "pos_b38": f"{_POS}+1000",
            "ref": _REF,
            "alt": _ALT,
            # Some variants are listed without a frequency.
            "gnomad_nfe": f"case when {_POS}%17=0 then cast(null as double)"
            f" else cast(({_PLACE}*13)%101 as double)/101e0 end",
        },
        f"{_POS}%3<>0",  # so that lookups miss; in both engines
        True,
    ),
    "v_alleles": (
        "lineitem",
        {
            "gene_id": _GENE,
            "chrom": _CHROM,
            "pos": _POS,
            "effect_allele": f"case when {_POS}%2=0 then {_REF} else {_ALT} end",
            "other_allele": f"case when {_POS}%2=0 then {_ALT} else {_REF} end",
            "beta": "(l_quantity-25.5e0)/10e0",
            "se": "l_discount+0.01e0",
            "z": "(l_quantity-25e0)/5e0",
            "pval": _PVAL,
            "log10_pval": f"-cast({_POS}%300 as double)/10e0",
            "n_total": "cast(l_partkey%1000+500 as int)",
        },
        None,
        False,
    ),
    "v_qtl": (
        "lineitem",
        {
            "study_id": "concat('Q', l_returnflag)",
            "phenotype_id": _GENE,
            "gene_id": _GENE,
            "bio_feature": "l_linestatus",
            "chrom": _CHROM,
            "pos": _POS,
            "ref": _REF,
            "alt": _ALT,
            "beta": "(l_quantity-25.5e0)/10e0",
            "se": "l_discount+0.01e0",
            "pval": _PVAL,
            "ac": "cast(l_partkey%50+1 as int)",
            "an": "200",
            "ma_count": "cast(l_partkey%40 as int)",
            "maf": "cast(l_partkey%40 as double)/400e0",
            "r2": "l_tax",
            "rsid": "concat('rs', cast(l_partkey%2 as string))",
        },
        None,
        False,
    ),
    "v_gene": (
        "supplier",
        {
            "gene_id": "concat('ENSG', lpad(cast(s_suppkey as string),11,'0'))",
            "chr": "cast(1+s_suppkey%7 as string)",
            "tss": "cast(s_suppkey*5501%200000000 as int)",
        },
        None,
        False,
    ),
    "v_junction": (
        "lineitem",
        {
            "study_id": "concat('Q', l_returnflag)",
            "bio_feature": "l_linestatus",
            "phenotype_id": f"concat('chr', {_CHROM}, ':', cast({_POS}-{_POS}%5000 as string),"
            f" ':', cast({_POS}-{_POS}%5000+100 as string), ':clu_',"
            " cast(l_suppkey%20 as string), ':ENSG',"
            " lpad(cast(l_suppkey%20 as string),11,'0'), '.',"
            " cast(1+l_suppkey%3 as string))",
            "variant_id": f"concat('chr', {_CHROM}, '_', cast({_POS} as string), '_', {_REF},"
            f" '_', {_ALT}, '_b38')",
            "ma_count": "cast(l_partkey%40 as int)",
            "maf": "cast(l_partkey%40 as double)/400e0",
            "pval_nominal": _PVAL,
            "slope": "(l_quantity-25.5e0)/10e0",
            "slope_se": "l_discount+0.01e0",
        },
        None,
        False,
    ),
    "v_study": (
        "customer",
        {
            "study_id": _STUDY,
            "pmid": "cast(c_custkey%97 as string)",
            "trait": "c_name",
            "sample_info": "case when c_custkey%3=0 then concat('1,',"
            " lpad(cast(c_custkey%1000 as string),3,'0'), ' European ancestry cases, ',"
            " cast(c_custkey+500 as string), ' European ancestry controls')"
            " when c_custkey%3=1 then concat(cast(c_custkey+100 as string),"
            " ' South Asian ancestry individuals')"
            " else concat(cast(c_custkey+100 as string),"
            " ' Japanese ancestry individuals, ', cast(c_custkey+7 as string),"
            " ' Hispanic individuals') end",
        },
        None,
        False,
    ),
    "v_paths": (
        "customer",
        {"path": f"concat('/summary/', {_STUDY}, '/harmonised/', {_STUDY}, '.h.tsv.gz')"},
        None,
        False,
    ),
    "v_completed": (
        "customer",
        {"path": f"concat('/out/', {_STUDY}, '.parquet/_SUCCESS')"},
        "c_custkey%4=0",  # the finished part of the work; in both engines
        False,
    ),
    "v_curated": (
        "customer",
        {
            "study_id": _STUDY,
            "gwascat_path": f"concat('/summary/', {_STUDY}, '/harmonised/', {_STUDY}, '.h.tsv.gz')",
            "n_cases": "case when c_custkey%3=0 then cast(c_custkey+10 as int) end",
            "n_controls": "case when c_custkey%3=0 and c_custkey%30<>0"
            " then cast(c_custkey+20 as int) end",
            "n_quant": "case when c_custkey%3<>0 or c_custkey%33=0"
            " then cast(c_custkey+30 as int) end",
            "ingested": "case when c_custkey%4=0 then '1' end",
            "to_ingest": "case when c_custkey%4<>0 and c_custkey%5<>0 then '1' else '' end",
            "note": "case when c_custkey%2=0 then concat('note ', c_mktsegment) end",
        },
        None,
        False,
    ),
    "v_chain": (
        "nation",
        {
            "chrom": "cast(1+n_nationkey%7 as string)",
            "t_start": "cast(n_nationkey*20000 as int)",
            "t_end": "cast(n_nationkey*20000+15000 as int)",
            "q_chrom": "concat('chr', cast(1+n_nationkey%7 as string))",
            "q_start": "cast(n_nationkey*20000+500 as int)",
            "q_size": "cast(2000000 as int)",
            "strand": "case when n_nationkey%2=0 then '+' else '-' end",
            "chain_score": "cast(1000+n_nationkey as bigint)",
        },
        None,
        False,
    ),
    "v_vcf": (
        "lineitem",
        {
            "chrom_b37": _CHROM,
            "pos_b37": _POS,
            "rsid": f"concat('rs', cast({_POS} as string))",
            "ref": _REF,
            "alts": f"concat({_ALT}, ',', 'T')",
        },
        f"{_POS}%5=0",  # so that lookups miss; in both engines
        True,
    ),
    "v_publication": (
        "orders",
        {
            "study_id": "concat('S', cast(o_orderkey as string))",
            "pmid": "cast(o_custkey as string)",
            "author": "concat('Author ', cast(o_custkey%100 as string))",
            "association_count": "cast(floor(o_totalprice) as bigint)",
        },
        None,
        False,
    ),
    "v_endpoint": (
        "part",
        {
            "phenocode": "concat(case when p_partkey%3=0 then 'CD2_' else 'C3_' end,"
            " upper(p_type), case when p_partkey%2=0 then '_EXALLC' else '' end,"
            " '_', cast(p_partkey as string))",
            "phenostring": "p_name",
            "category": "p_brand",
            "num_cases": "cast(p_size as int)",
            "num_controls": "cast(p_size*10+5 as int)",
            "num_gw_significant": "cast(p_partkey%17 as int)",
        },
        None,
        False,
    ),
    "v_samples": (
        "lineitem",
        {
            "variant": f"concat({_CHROM}, ':', cast({_POS} as string))",
            "DatasetsNrSamples": "concat(cast(l_partkey%50 as string), ';-;',"
            " cast(l_suppkey%20 as string), ';', case when l_linenumber%2=0 then '-'"
            " else '7' end)",
        },
        None,
        False,
    ),
    "v_linear": (
        "lineitem",
        {
            "variant": f"concat({_CHROM}, ':', cast({_POS} as string), ':', {_REF}, ':', {_ALT})",
            "phenotype": "concat('p', cast(l_suppkey as string))",
            "n_complete_samples": "cast(l_partkey%900 as int)",
            "AC": "cast(l_partkey%70 as int)",
            "beta": "(l_quantity-25.5e0)/1000e0",
            "se": "l_discount/100e0+0.001e0",
            "pval": _PVAL,
        },
        None,
        False,
    ),
    "v_phenotype": (
        "supplier",
        {
            "phenotype": "concat('p', cast(s_suppkey as string))",
            "description": "s_name",
            "n_non_missing": "cast(s_suppkey+300 as int)",
            "n_missing": "cast(s_suppkey%10 as int)",
            "n_controls": "cast(200 + s_suppkey%50 as int)",
            "n_cases": "cast(s_suppkey%40 as int)",
        },
        None,
        False,
    ),
    "v_rsid": (
        "lineitem",
        {
            "chr": _CHROM,
            "pos": _POS,
            "ref": _REF,
            "alt": _ALT,
            "rsid": f"concat('rs', {_CHROM}, '_', cast({_POS} as string))",
            "info": f"cast({_POS}%11 as double)/11e0",
        },
        f"{_POS}%4<>0",  # so that lookups miss; in both engines
        True,
    ),
    "v_mixed": (
        "lineitem",
        {
            "chrom": _CHROM,
            "pos": _POS,
            "snpid": f"concat('rs', cast({_POS} as string))",
            "ref": _REF,
            "alt": _ALT,
            "ac": "cast(l_partkey%50 as int)",
            "af": "cast(l_partkey%50 as double)/100e0",
            "beta": "(l_quantity-25.5e0)/10e0",
            "sebeta": "l_discount+0.01e0",
            "pval": _PVAL,
            "phenotype": "concat('PheCode_', cast(l_suppkey%9 as string))",
        },
        None,
        False,
    ),
}


class Tables:
    """The views over one directory of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def base(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def view(self, name: str) -> DataFrame:
        table, columns, where, distinct = VIEWS[name]
        source = self.base(table)
        if where:
            source = source.where(where)
        rows = source.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])
        return rows.distinct() if distinct else rows

    def panel(self) -> DataFrame:
        """Variant panel with its frequency in a struct."""
        return self.view("v_panel").withColumn("af", F.struct("gnomad_nfe")).drop("gnomad_nfe")


def view_sql(name: str) -> str:
    table, columns, where, distinct = VIEWS[name]
    fields = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    keyword = "SELECT DISTINCT" if distinct else "SELECT"
    return f"{keyword} {fields} FROM {table}" + (f" WHERE {where}" if where else "")


def with_views(sql: str) -> str:
    """Put the definitions of the views a query names in front of it."""
    used = [name for name in VIEWS if name in sql.replace(",", " ").replace(")", " ").split()]
    definitions = ", ".join(f"{name} AS ({view_sql(name)})" for name in used)
    body = sql.strip()
    if not definitions:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {definitions}, {body[5:]}"
    return f"WITH {definitions} {body}"
