"""Analytics of training logs: one row per event, evaluations and training steps mixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.order import global_rank
from quern.functions.shared import shared_dir

# Columns of the log.
LOG_COLUMNS = ["epoch", "step", "train_loss", "eval_loss", "train_accuracy", "eval_accuracy", "learning_rate", "perplexity", "eval_perplexity"]
LOG_SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "step" else T.DoubleType()) for c in LOG_COLUMNS])


def is_eval(loss: str = "loss", eval_loss: str = "eval_loss") -> Column:
    return F.col(eval_loss).isNotNull()


def is_train(loss: str = "loss", eval_loss: str = "eval_loss") -> Column:
    return F.col(loss).isNotNull() & F.col(eval_loss).isNull()


def forward_fill(df: DataFrame, evaluation: Column, values: list[str], order: list[str | Column], run: list[str] | None = None) -> DataFrame:
    """Rows that are no evaluations, each with the values of the latest evaluation before it, as ``last_<value>``. The latest is
    taken whole: a null in it stays null. Runs are the unit of distribution; a log without runs is one sorted stream, as the semantics ask for."""
    w = Window.partitionBy(*(run or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last(F.when(evaluation, F.struct(*values)), ignorenulls=True).over(w)
    filled = df.withColumn("__seen", seen).filter(~evaluation)
    return filled.select(*df.columns, *[F.col(f"__seen.{v}").alias(f"last_{v}") for v in values])


def count_windows(df: DataFrame, step: str, every: int, correct: str, total: str, run: list[str] | None = None) -> DataFrame:
    """Windows of ``every`` steps (the last may be short): sums and their ratio, 0 if nothing was counted. Training batches
    only: the caller leaves evaluation batches out."""
    w = F.floor((F.col(step) - 1) / F.lit(every)).cast("long")
    return df.groupBy(*(run or []), w.alias("window")).agg(
        F.max(step).alias("last_step"),
        F.sum(correct).alias("correct"),
        F.sum(total).alias("total"),
        F.when(F.sum(total) > 0, F.sum(correct) / F.sum(total)).otherwise(0.0).alias("accuracy"),
    )


def final_backfill(df: DataFrame, final_step: int | Column, step: str = "step", loss: str = "train_loss") -> DataFrame:
    """df, and if its last step isn't the final one a row for that, copied from the latest entry with a loss."""
    rest = [c for c in df.columns if c != step]
    last = df.agg(
        F.max(step).alias("__last"), F.max_by(F.struct(*rest), F.when(F.col(loss).isNotNull(), F.col(step))).alias("__row"), F.max(F.when(F.col(loss).isNotNull(), F.col(step))).alias("__with")
    )
    final = F.lit(final_step) if isinstance(final_step, int) else final_step
    added = last.filter((F.col("__last") != final) & F.col("__with").isNotNull()).select(final.cast(df.schema[step].dataType).alias(step), "__row.*")
    return df.unionByName(added)


def epoch_axis(df: DataFrame, epoch: str, step: str) -> DataFrame:
    """df with ``axis_step``: each epoch on the axis of steps, by the last step and the last epoch of the whole log."""
    ends = df.agg(F.max(step).alias("__step"), F.max(epoch).alias("__epoch"))
    return df.join(F.broadcast(ends)).select(*df.columns, (F.col(epoch) * F.col("__step") / F.col("__epoch")).alias("axis_step"))


def approximate_accuracy(eval_loss: Column) -> Column:
    return F.exp(-eval_loss)


# The quartiles of a description.
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: count, mean, std (of a sample), min, quartiles (interpolated), max.

    One pass for all columns, one for their ranks. Quartiles are exact and come from the ranks of a distributed sort, so that no buffer holds a column's distinct values.
    """
    shared_dir(df.sparkSession)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    cells = df.select(each.alias("c")).select("c.*")
    stats = cells.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")).checkpoint()
    ahead, wanted = 0, []
    for name, n in sorted((r["column"], r["count"]) for r in stats.collect()):
        for q, share in QUARTILES.items() if n else ():
            low, part = divmod((n - 1) * share, 1)
            wanted += [(name, q, ahead + int(low) + 1, 1 - part), *([(name, q, ahead + int(low) + 2, part)] if part else [])]
        ahead += n
    places = df.sparkSession.createDataFrame(wanted, "column string, q string, rank bigint, weight double")
    ranked = global_rank(cells.filter("x IS NOT NULL"), F.col("column"), F.col("x")).select("rank", "x")
    met = ranked.join(F.broadcast(places), "rank").groupBy("column", "q").agg(F.sum(F.col("x") * F.col("weight")).alias("x"))
    quartiles = met.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("x"))).alias(q) for q in QUARTILES])
    return stats.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", *QUARTILES, "max")


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def series(df: DataFrame, step: str, value: str, scale: float = 1.0) -> DataFrame:
    """(step, value) where a value is there; accuracies are scaled by 100."""
    return df.select(F.col(step).alias("step"), (F.col(value).try_cast("double") * scale).alias("value")).filter(F.col("step").isNotNull() & F.col("value").isNotNull())


def axis_floor(points: DataFrame) -> DataFrame:
    """Where a chart's axis starts: a twentieth of the range below the least value, 0 at least."""
    low, high = F.min("value"), F.max("value")
    return points.agg(F.greatest(F.lit(0.0), low - 0.05 * (high - low)).alias("y_min"), F.count(F.lit(1)).alias("n"))


def checkpoint_number(path: Column) -> Column:
    """The number at the end of a checkpoint's name; 0 if it isn't one."""
    return F.coalesce(F.regexp_extract(path, r"-([0-9]+)$", 1).try_cast("bigint"), F.lit(0))


def latest_checkpoint(df: DataFrame, path: str = "path", mtime: str | None = None) -> DataFrame:
    """The path with the largest number, or with a time column the newest; ties go to the path that sorts last."""
    by = F.col(mtime) if mtime else checkpoint_number(F.col(path))
    return df.agg(F.max_by(path, F.struct(by, F.col(path))).alias("path"))
