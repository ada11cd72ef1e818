"""Where intermediate results live: the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quern.functions.shared import scratch_root, shared_dir, stored

__all__ = ["per_process", "scratch", "shared_dir", "stored", "table"]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_process(key: str, make):
    """make(), kept by this worker process for later tasks with the same key. One object at a time is kept. Functions reach
    workers by value, so their own globals don't outlive a task; a module entry does."""
    import sys
    import types

    home = sys.modules.setdefault("_quern_process", types.ModuleType("_quern_process"))
    if getattr(home, "key", None) != key:
        home.key, home.kept = None, None
        home.kept = make()
        home.key = key
    return home.kept
