"""The corpus pipeline: documents in, packed sequences out.

Each stage works on all rows that the one before kept and hands on the columns of documents, whatever they are; the last
gives the packed pieces. A stage's rules for null ids, null and empty texts, ties and repeated rows are
those of its operator; a row with a null id is never dropped as a near copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import decontaminate, exact_dedup, langid, packing, simhash
from quern.llm._shared import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told, by score and fit (``langid.filter_language`` with its defaults); those without a letter, in no learned language or of
    random letters go. With nothing to learn from, all with letters stay."""
    return langid.filter_language(docs, langid.train(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; each row by its own text."""
    return simhash.near_dedup(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"), max_coverage=0.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean), ("packing", packed)]

#: SQL can't express the fingerprints, the language model or the packing; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
