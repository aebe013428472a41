"""From raw documents to token files: the stages of the corpus, in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrid.llm import decontamination, mixing, quality, simhash, tokens
from tallygrid.llm.common import table
from tallygrid.staging import Staging


#: Working tables of the stages that have been called; ``run`` deletes them.
_OPEN: list[Staging] = []


def _working(spark: SparkSession) -> Staging:
    _OPEN.append(Staging(spark))
    return _OPEN[-1]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling does not draw go."""
    return quality.kept(docs, table(spark, sf_dir, "labels"), _working(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of four words, four bits apart at most."""
    return simhash.deduplicated(docs, _working(spark))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), _working(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs, _working(spark))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and a row per document of what was read back from them."""
    return tokens.token_table(docs, _working(spark))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify_quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]


#: Fingerprints, classifier and random rounding have no like in the checking SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next one.

    What a stage has stored is deleted when the next one is written. The token files stay, with
    the table that says what is in them.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        _OPEN.clear()
        output = Staging(spark)
        docs = output.write(name, stage(spark, docs, sf_dir))
        if name != STAGES[-1][0]:
            for working in _OPEN:
                working.release()
        if before is not None:
            before.release()
        before = output
    return docs
