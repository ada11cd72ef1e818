"""Sinks: logs, metrics, reports and corpora."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.messages import rendered
from quern.functions.text import cell_text
from quern.operators.evalmetrics import improvement, improvement_label
from quern.operators.mix import restored


def append_log(df: DataFrame, path: str) -> None:
    """Appends rows as CSV, with a header in each file."""
    df.write.mode("append").option("header", True).csv(path)


def log_stream(df: DataFrame, path: str, checkpoint: str, **trigger):
    """A streaming log, appended batch by batch; a batch that runs again replaces its own folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("header", True).csv(f"{path}/batch={number}")

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def comparison_table(compared: DataFrame, base: str = "base", tuned: str = "tuned") -> DataFrame:
    """label, base_model, finetuned_model, improvement."""
    imp = improvement(F.col(base), F.col(tuned), F.col("lower_is_better"))
    return compared.select(F.col("label").alias("metric"), F.col(base).alias("base_model"), F.col(tuned).alias("finetuned_model"), improvement_label(imp).alias("improvement"))


def metrics_csv(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def metrics_json(df: DataFrame, path: str) -> None:
    """One JSON document per row, nested, characters as they are."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def upsert_field(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A document with a field set or replaced; write it to a new path."""
    return df.withColumn(name, value)


def markdown_report(table: DataFrame, categories: DataFrame | None = None, series: list[str] | None = None, title: str = "Evaluation") -> str:
    """A report of a comparison (a few rows, as many as there are metrics and categories)."""
    shown = table.select("metric", cell_text(F.col("base_model")), cell_text(F.col("finetuned_model")), "improvement")
    lines = [f"# {title}", "", "| Metric | Base Model | Fine-tuned Model | Improvement |", "|---|---|---|---|"]
    lines += ["| " + " | ".join(map(str, r)) + " |" for r in shown.collect()]
    if categories is not None:
        lines += ["", "| Category | Base | Fine-tuned | Improvement |", "|---|---|---|---|"]
        lines += ["| " + " | ".join(map(str, r)) + " |" for r in categories.collect()]
    if series:
        lines += ["", "## Charts", "", *[f"- {s}" for s in series]]
    return "\n".join(lines) + "\n"


def rendered_text(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Rendered conversations joined by blank lines, as one value. For samples: the caller limits the rows."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos), rendered(F.col("messages")).alias("t"))))
    return df.agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n\n").alias("text"))


def json_lines(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Rows as JSON lines, in order of the columns named, if any are."""
    df = restored(df, *order) if order else df
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def mirror(source: str, target: str) -> tuple[int, int] | None:
    """Copies a folder through pyarrow's file systems; (files, bytes), or None with a warning if that fails."""
    import warnings

    from pyarrow import fs

    try:
        a, at = fs.FileSystem.from_uri(source)
        b, to = fs.FileSystem.from_uri(target)
        if a.get_file_info(at).type == fs.FileType.Directory:
            b.create_dir(to, recursive=True)
        fs.copy_files(at, to, source_filesystem=a, destination_filesystem=b)
        files = [f for f in b.get_file_info(fs.FileSelector(to, recursive=True)) if f.is_file]
        return len(files), sum(f.size for f in files)
    except Exception as e:  # a failed copy must not end a finished run
        warnings.warn(f"{source} was not copied: {e}", stacklevel=2)
        return None


def document(row: dict) -> str:
    return json.dumps(row, ensure_ascii=False, indent=2)
