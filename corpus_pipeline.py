"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm._common import materialize, table
from rollcall.llm.decontaminate import decontaminate
from rollcall.llm.language_id import fit_dictionaries, keep_identified
from rollcall.llm.minhash_dedup import drop_near_duplicates
from rollcall.llm.mixture import PRODUCTION, mix_sources
from rollcall.llm.suffix_dedup import without_repeats


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; dictionaries are fitted on the labelled texts of docs themselves."""
    return keep_identified(docs, fit_dictionaries(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicates(docs, width=5, threshold=0.8)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 50 bytes that a document with a smaller id has."""
    return without_repeats(docs, length=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Which documents, and how often and how far, fill the budgets of the domains, languages and sources."""
    return mix_sources(docs, PRODUCTION)


STAGES = [
    ("language_id", identify),
    ("minhash_dedup", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

#: Compression, latent space and suffix order have no SQL. tests/llm checks the duplicate and repeat operators and the
#: mixture against brute force or SQL, as queries; of the stages as such, and of the leaks' recall, it checks small fixtures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
