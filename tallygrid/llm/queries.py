"""Registered queries of the operators for training text, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallygrid.llm import (
    bpe,
    decontamination,
    html,
    merkle,
    mixing,
    pii,
    quality,
    runs,
    secrets,
    simhash,
    spelling,
    tokens,
    warc,
)
from tallygrid.llm.common import table
from tallygrid.staging import Staging


def op1_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.resample(docs, labels, Staging(spark))


def op2_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontamination_table(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), Staging(spark)
    )


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(table(spark, folder, "pages"))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_table(table(spark, folder, "documents"), Staging(spark))


def op5_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    return warc.warc_table(table(spark, folder, "pages"), Staging(spark))


def op6_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_table(table(spark, folder, "documents"))


def op7_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_table(table(spark, folder, "documents"))


def op8_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.merkle_table(table(spark, folder, "documents"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_table(table(spark, folder, "documents"), Staging(spark))


def op10_pivotal_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_table(table(spark, folder, "documents"), Staging(spark))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_table(table(spark, folder, "documents"), Staging(spark))


def op12_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_table(table(spark, folder, "documents"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.runs_table(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_importance_resampling,
        op2_winnowing_decontamination,
        op3_html_extraction,
        op4_simhash_near_dedup,
        op5_warc_normaliser,
        op6_pii_spans,
        op7_secret_spans,
        op8_merkle_fingerprints,
        op9_token_files,
        op10_pivotal_mixing,
        op11_spelling_variants,
        op12_bpe_codec,
        op13_periodic_runs,
    )
}

#: None: hashes, word ends of a fixed kind and random rounding have no like in the checking SQL.
SQL: dict[str, str] = {}
