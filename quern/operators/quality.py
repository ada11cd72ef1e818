"""Reports on a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.messages import assistant_text, last_user
from quern.operators.filters import FENCE, outdated


def text_quality(df: DataFrame, user: Column, answer: Column, source: str = "source") -> DataFrame:
    """Per source: rows, mean lengths, and shares of answers with code or outdated parts and of questions with a question mark. Unrounded."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.length(user)).alias("avg_user_len"),
        F.avg(F.length(answer)).alias("avg_asst_len"),
        F.avg(F.contains(answer, F.lit(FENCE)).cast("int")).alias("code_ratio"),
        F.avg(outdated(answer).cast("int")).alias("deprecated_ratio"),
        F.avg(F.contains(user, F.lit("?")).cast("int")).alias("question_ratio"),
    )


def quality(df: DataFrame, source: str = "source") -> DataFrame:
    """The report over messages; rows without a source column count as '?'."""
    if source not in df.columns:
        df = df.withColumn(source, F.lit("?"))
    texts = df.select(source, last_user(F.col("messages")).alias("user"), assistant_text(F.col("messages")).alias("answer"))
    return text_quality(texts, F.col("user"), F.col("answer"), source)


def for_display(report: DataFrame) -> DataFrame:
    """Lengths to one place, shares to three."""
    one, three = ["avg_user_len", "avg_asst_len"], ["code_ratio", "deprecated_ratio", "question_ratio"]
    return report.withColumns({c: F.round(c, 1) for c in one} | {c: F.round(c, 3) for c in three})


def rows_per_source(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def size_rollup(df: DataFrame, size: Column, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.sum(size).cast("long").alias("bytes"), F.count(F.lit(1)).alias("files"))
