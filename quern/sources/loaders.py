"""Sources: every loader returns pos, messages, source.

A source is a table or a path of files, given by the caller; nothing is fetched from a network. ``pos`` is the row's position. Files
have no order in Spark, so a loader takes it from a column of the table (``pos`` or one named by the caller), and for files from the file's name and the place of the row in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.messages import MESSAGES, SYSTEM_PROMPT, detected, message, pair, with_system
from quern.functions.shared import stored
from quern.functions.text import clean, squeezed, unescape_each, without_tags
from quern.operators import filters

_MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
CANONICAL = T.StructType([T.StructField("pos", T.LongType()), T.StructField("messages", T.ArrayType(_MESSAGE)), T.StructField("source", T.StringType())])
API_SCHEMA = "member string, summary string, signature string, url string, example string"
HOLDOUT_SCHEMA = "category string, question string, reference string"
# Fixed value: what stands between the system prompt and an injected reference.
CONTEXT_HEADING = "\n\n# Reference\n"


def from_rows(spark: SparkSession, rows: list[tuple] | None) -> DataFrame:
    """In-memory (pos, messages, source) rows; typed even if there are none."""
    return spark.createDataFrame(rows or [], CANONICAL)


def tagged(df: DataFrame, messages: Column, source: str, pos: str | None = "pos") -> DataFrame:
    at = F.col(pos) if pos else F.monotonically_increasing_id()
    return df.select(at.alias("pos"), messages.cast(MESSAGES).alias("messages"), F.lit(source).alias("source"))


def question_answer(df: DataFrame, source: str = "ibranze", question: str = "question", answer: str = "answer", pos: str | None = "pos") -> DataFrame:
    return tagged(df, pair(F.col(question), F.col(answer)), source, pos)


def conversations(df: DataFrame, source: str = "erocal", messages: str = "messages", pos: str | None = "pos") -> DataFrame:
    return tagged(df, with_system(F.col(messages).cast(MESSAGES)), source, pos)


def api_answers(df: DataFrame, inject_context: bool = False, source: str = "hypersniper", pos: str | None = "pos") -> DataFrame:
    """Questions and answers, with the entry's ``api`` text behind the system prompt if that is asked for and it isn't blank."""
    system = F.lit(SYSTEM_PROMPT)
    if inject_context:
        api = clean(F.col("api"))
        system = F.when(api != "", F.concat(system, F.lit(CONTEXT_HEADING), api)).otherwise(system)
    return tagged(df, pair(F.col("question"), F.col("answer"), system), source, pos)


def auto_schema(df: DataFrame, source: str = "vishnuoi", pos: str | None = "pos") -> DataFrame:
    return tagged(df, detected(df), source, pos)


def strip_messages(df: DataFrame, closed: bool = False) -> DataFrame:
    """Users' and assistants' contents without mark-up (closed: as in strip_html); system turns as they are. Each row stays a row: the step in Python maps the list of its contents."""
    m = F.col("messages")
    bare = unescape_each(F.transform(m, lambda x: F.when(x["role"].isin("user", "assistant"), without_tags(x["content"]))), closed)
    made = F.zip_with(m, F.col("bare"), lambda x, b: F.when(x.isNotNull(), message(x["role"], F.when(x["role"].isin("user", "assistant"), squeezed(b)).otherwise(x["content"]))))
    return df.withColumn("bare", bare).select("pos", made.cast(MESSAGES).alias("messages"), "source")


def exchange_posts(df: DataFrame, source: str = "gamedev", pos: str | None = "pos", closed: bool = False) -> DataFrame:
    return strip_messages(auto_schema(df, source, pos), closed)


def curated_posts(df: DataFrame, min_score: int = 5, domain_only: bool = True, source: str = "gamedev", pos: str | None = "pos", words: list[str] | None = None, closed: bool = False) -> DataFrame:
    """Posts whose scores and acceptance hold (checked on the raw rows, before any conversion); without such columns, long answers of
    the domain. words: those of the domain, if not DOMAIN_WORDS."""
    if not filters.has_meta(df):
        made = exchange_posts(df, source, pos, closed)
        return made.filter(filters.heuristic_ok(F.col("messages"), domain_only, words=words))
    made = exchange_posts(df.filter(filters.meta_ok(df, min_score)), source, pos, closed)
    if domain_only:
        from quern.functions.messages import full_text

        made = made.filter(filters.in_domain(full_text(F.col("messages")), words))
    return made


def keyword_documents(df: DataFrame, keyword: str = "unity", max_docs: int = 5000, text: str = "text", pos: str = "pos", source: str = "common_pile", gap: str = "\n\n") -> DataFrame:
    """Documents with the keyword (any case) and two paragraphs or more: the first asks, the rest answers. The first max_docs by position, the
    feature's own limit; Spark takes them by a top-k, not a sort of all."""
    parts = F.filter(F.split(F.col(text), gap, -1), lambda p: clean(p) != "")
    hits = df.filter(F.contains(F.lower(F.col(text)), F.lit(keyword.lower()))).select(F.col(pos).alias("pos"), parts.alias("parts")).filter(F.size("parts") >= 2)
    made = tagged(hits, pair(F.col("parts")[0], F.array_join(F.slice("parts", 2, F.size("parts")), gap)), source)
    return made.orderBy("pos").limit(max_docs)


def keyword_stream(spark: SparkSession, path: str, schema: str | T.StructType, keyword: str = "unity", text: str = "text", source: str = "common_pile", gap: str = "\n\n") -> DataFrame:
    """The same as a stream over files that keep arriving; ``take_stream`` ends it when it has enough."""
    df = spark.readStream.schema(schema).parquet(path)
    parts = F.filter(F.split(F.col(text), gap, -1), lambda p: clean(p) != "")
    hits = df.filter(F.contains(F.lower(F.col(text)), F.lit(keyword.lower()))).select(parts.alias("parts")).filter(F.size("parts") >= 2)
    return hits.select(pair(F.col("parts")[0], F.array_join(F.slice("parts", 2, F.size("parts")), gap)).alias("messages"), F.lit(source).alias("source"))


def take_stream(stream: DataFrame, path: str, checkpoint: str, most: int = 5000, **trigger) -> int:
    """Writes the first ``most`` rows of a stream as Parquet, a folder per batch, and ends it then (or when the trigger does): files that come later are never
    read. Returns the number of rows. A batch that runs again replaces its own folder."""
    import time

    have: dict[int, int] = {}

    def put(batch: DataFrame, number: int) -> None:
        room = most - sum(n for b, n in have.items() if b != number)
        if room > 0:
            at = f"{path}/batch={number}"
            batch.limit(room).write.mode("overwrite").parquet(at)
            have[number] = batch.sparkSession.read.parquet(at).count()

    running = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    while running.isActive and sum(have.values()) < most:
        running.awaitTermination(1)
        time.sleep(0.05)
    if running.isActive:
        running.stop()
    elif running.exception() is not None:
        raise running.exception()
    return sum(have.values())


def _placed(df: DataFrame) -> DataFrame:
    """df with ``pos``, a row's place by file name and order in the file, however files were split and dealt to tasks.

    A split's rows stand together in its task, in order, so a place is a row's number in the task, shifted by the rows of the splits before. Rows are written once, with
    their numbers, so that counts and places speak of the same splits, and never shuffled; the driver sees one count per split."""
    at = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__no")]
    kept = stored(df.select("*", *at), "placed")
    shifts, before = [], 0
    for file, start, first, n in sorted(map(tuple, kept.groupBy("__file", "__start").agg(F.min("__no"), F.count(F.lit(1))).collect())):
        shifts.append((file, start, before + 1 - first))
        before += n
    shift = df.sparkSession.createDataFrame(shifts, "__file string, __start long, __shift long")
    placed = kept.join(F.broadcast(shift), ["__file", "__start"]).withColumn("pos", F.col("__no") + F.col("__shift"))
    return placed.drop("__file", "__start", "__no", "__shift")


def json_lines(spark: SparkSession, path: str, source: str = "perf", schema: str | T.StructType | None = None) -> DataFrame:
    """JSON lines with any of the known columns; the schema is inferred unless given."""
    reader = spark.read.schema(schema) if schema else spark.read
    return auto_schema(_placed(reader.json(path)), source)


def api_entries(spark: SparkSession, path: str) -> DataFrame:
    """Reference entries as JSON lines; blank and malformed lines are skipped."""
    rows = _placed(spark.read.schema(API_SCHEMA).option("mode", "DROPMALFORMED").json(path))
    return rows.filter((clean(F.col("member")) != "") & (clean(F.col("summary")) != ""))


def holdout(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOLDOUT_SCHEMA).json(path)


def training_log(spark: SparkSession, path: str) -> DataFrame:
    from quern.operators.trainlog import LOG_SCHEMA

    return spark.read.schema(LOG_SCHEMA).option("header", True).csv(path)


def trainer_state(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a trainer's history, one row each; keys that an entry lacks are null."""
    entry = "struct<step:bigint,epoch:double,loss:double,eval_loss:double,learning_rate:double>"
    doc = spark.read.schema(f"epoch double, log_history array<{entry}>").option("multiLine", True).json(path)
    return doc.select(F.posexplode("log_history").alias("pos", "e")).select("pos", "e.*")


def json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``checkpoint-*`` folders: path of the folder, mtime, bytes. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")
    folder = F.regexp_extract("path", r"^(.*/checkpoint-[^/]*)/", 1)
    return files.select(folder.alias("path"), F.col("modificationTime").alias("mtime"), "length").filter("path <> ''").groupBy("path").agg(F.max("mtime").alias("mtime"), F.sum("length").alias("bytes"))


def split_or_first(splits: dict[str, DataFrame], wanted: str = "train") -> DataFrame:
    """The wanted split, else the first there is."""
    return splits[wanted] if wanted in splits else next(iter(splits.values()))


LOADERS: dict[str, Callable[..., DataFrame]] = {
    "ibranze": question_answer,
    "erocal": conversations,
    "hypersniper": api_answers,
    "vishnuoi": auto_schema,
    "gamedev": exchange_posts,
    "common_pile": keyword_documents,
}


def load(names: list[str], tables: dict[str, DataFrame], strict: bool = True, loaders: dict | None = None) -> dict[str, DataFrame]:
    """Named sources over the caller's tables. An unknown name raises, or is skipped with a warning if not strict."""
    import warnings

    known = loaders or LOADERS
    if unknown := [n for n in names if n not in known]:
        if strict:
            raise ValueError(f"unknown sources: {', '.join(unknown)}")
        warnings.warn(f"skipped unknown sources: {', '.join(unknown)}", stacklevel=2)
    return {n: known[n](tables[n]) for n in names if n in known}
