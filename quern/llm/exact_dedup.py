"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

Every partition of the input is a run of digests with one entry per text: the identifier that stays and the number of copies.
Copies collapse inside the task before they travel, so a text with a third of all rows costs one entry per task. Runs meet in rounds:
in round r an entry moves from run i to the run that has the r-th digit of i replaced by the r-th digit of its digest, and run i is partition i: entries are
dealt by that number itself (``repartitionById``), so a run receives from its ``fan_in`` partners, those that differ in that digit alone, and from
no other. It sorts them and merges equal digests over the sorted run into one entry, with the smallest (or largest) identifier and the sum of copies, before the next
round. That is a binomial exchange with radix ``fan_in`` in place of 2, so that a merge is multiway. Spark hands a task its partners' rows one after the other
and not interleaved, so the merge of the sorted runs is a sort of their concatenation. After the last round the run's number is the digest's own, so each
text is in one run and no run ever holds more than its share of the digests. There are as many runs as shuffle partitions at least.

An entry is verified by three values together: SHA-256, length in bytes and XXH64. Texts whose
digests collide would need to agree in all of them to be merged.

Defined results: a null text counts as empty; rows with a null id count in group_size and never
stay while another row has an id; identical rows with the same id are one document and share one verdict; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fewest runs.
RUNS = 64
FAN_IN = 8
_KEY = ["__sha", "__len", "__xxh"]


def _digests(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("__id"),
        F.sha2(text, 256).alias("__sha"),
        F.octet_length(text).alias("__len"),
        F.xxhash64(text).alias("__xxh"),
    )


def _digit(number: Column, place: int, fan_in: int) -> Column:
    return F.pmod(F.floor(number / F.lit(fan_in**place)), F.lit(fan_in)).cast("int")


def merge_runs(digests: DataFrame, keep: str = "smallest", runs: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """One row per text: its digest key, ``keep_id`` and ``group_size``. runs: at least so many, rounded up to a power of fan_in; by default
    the number of shuffle partitions, and RUNS at least."""
    runs = runs or max(RUNS, int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pick = {"smallest": F.min, "largest": F.max}[keep]
    rounds, width = 0, 1
    while rounds == 0 or width < runs:
        rounds, width = rounds + 1, width * fan_in

    def merged(entries: DataFrame) -> DataFrame:
        best = pick(F.when(F.col("__id").isNotNull(), F.struct("__id"))).alias("__best")
        return entries.groupBy("__run", *_KEY).agg(best, F.sum("__n").alias("__n")).select("__run", *_KEY, F.col("__best.__id").alias("__id"), "__n")

    run = F.pmod(F.spark_partition_id(), F.lit(width)).cast("int")
    entries = merged(digests.select("__id", *_KEY, F.lit(1).cast("long").alias("__n"), run.alias("__run")))
    own = F.pmod(F.col("__xxh"), F.lit(width))
    for place in range(rounds):
        step = F.lit(fan_in**place)
        partner = F.col("__run") + (_digit(own, place, fan_in) - _digit(F.col("__run"), place, fan_in)) * step
        dealt = entries.withColumn("__run", partner.cast("int")).repartitionById(width, F.col("__run"))
        entries = merged(dealt.sortWithinPartitions("__run", *_KEY))
    return entries.select(*_KEY, F.col("__id").alias("keep_id"), F.col("__n").alias("group_size"))


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", runs: int | None = None, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256."""
    digests = _digests(docs, id_col, F.col(text_col))
    classes = merge_runs(digests, keep, runs, fan_in)
    return digests.join(classes, _KEY).select(
        F.col("__id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of docs, all columns, whose text's class they represent.

    Only identifiers are looked up: each text's own id is compared with that of its class, and a
    row without an id stays if nothing with an id shares its text.
    """
    digests = merge_runs(_digests(docs, id_col, F.col(text_col)), keep)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(id_col).alias("__id"),
        F.sha2(text, 256).alias("__sha"),
        F.octet_length(text).alias("__len"),
        F.xxhash64(text).alias("__xxh"),
    )
    same = [keyed[c] == digests[c] for c in _KEY] + [keyed["__id"].eqNullSafe(digests["keep_id"])]
    return keyed.join(digests, same, "left_semi").select("__row.*")


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
