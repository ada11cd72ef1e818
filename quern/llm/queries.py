"""The operators' queries over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import decontaminate, exact_dedup, langid, line_dedup, packing, pii, simhash, substring_dedup, url_filter, warc
from quern.llm._shared import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_classes(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"), keep="largest")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = url_filter.default_list(spark)
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), listed, len(url_filter.LISTED_NAMES) * len(url_filter.LISTED_ZONES))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_langid": op3_langid,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_warc": op7_warc,
    "op8_url_filter": op8_url_filter,
    "op9_packing": op9_packing,
    "op10_decontaminate": op10_decontaminate,
}

ORACLE = {
    "op1_line_dedup": line_dedup.SQL,
    "op5_pii": pii.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op7_warc": warc.SQL,
    "op8_url_filter": url_filter.SQL,
    "op10_decontaminate": decontaminate.SQL,
}
