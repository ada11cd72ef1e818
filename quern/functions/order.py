"""Ranks over a whole table without a single task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.shared import shared_dir


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """df with its 1-based place in the order. Rows are dealt by ranges of it, ranked inside each range, and ranges are offset by the
    number of rows before them: the driver sees one count per range. The dealt rows are checkpointed in the shared folder, so that
    counts and ranks speak of the same ranges."""
    shared_dir(df.sparkSession)
    dealt = df.select("*", F.struct(*order).alias("__order")).repartitionByRange(F.col("__order"))
    dealt = dealt.withColumn("__range", F.spark_partition_id()).checkpoint()
    counts = dict(dealt.groupBy("__range").count().collect())
    before, offsets = 0, []
    for part in sorted(counts):
        offsets += [F.lit(part), F.lit(before).cast("long")]
        before += counts[part]
    ahead = F.try_element_at(F.create_map(*offsets), F.col("__range")) if offsets else F.lit(0).cast("long")
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__order"))
    return dealt.withColumn(name, (ahead + place).cast("long")).drop("__order", "__range")
