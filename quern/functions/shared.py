"""The folder that driver and executors share, for intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_FOLDER = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, else the one the session checkpoints to; it is made the session's own if that has none.

    A local session (tests) that names neither gets LOCAL_FOLDER. Any other must name one: a machine-local folder would be lost with its machine.
    """
    own = spark.sparkContext.getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or own
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
        base = LOCAL_FOLDER
    if own is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """Where this application's intermediate tables are."""
    return f"{shared_dir(spark)}/quern/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that still read them must have been written by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as a table in the shared folder and read back: lineage ends there, and a lost executor costs nothing that was computed before."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
