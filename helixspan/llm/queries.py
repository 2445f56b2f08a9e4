"""Named queries over the given tables, one per operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helixspan.llm import (
    alignment, bpe, fim, iblt, langid, licenses, mixing, neardup, pii, quality, rules, simhash, urls,
)
from helixspan.llm.texts import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op1_mixing": mixing.ORACLE, "op6_rule_ledger": rules.ORACLE, "op12_fim": fim.ORACLE}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_summary(table(spark, folder, "documents"))


@query
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents"))


@query
def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents"))
    return found.drop("template_spans")


@query
def op6_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(table(spark, folder, "documents"))
    return judged.drop("n_lines", "failed")


@query
def op2_iblt(spark: SparkSession, folder: str) -> DataFrame:
    return iblt.fingerprints(table(spark, folder, "documents"))


@query
def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"))


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_classes(table(spark, folder, "documents"))


@query
def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


@query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


@query
def op12_fim(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digest_table(table(spark, folder, "documents"))


@query
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_components(table(spark, folder, "documents"))
