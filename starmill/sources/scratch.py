"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.session import two_writers

_SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """Fresh folder for one intermediate table, grouped by application.

    The base is the session's ``spark.checkpoint.dir``, or the checkpoint folder set on
    its context. Only a local session, as in tests, may go without: on a cluster a
    machine-local folder would vanish with its machine.
    """
    context = spark.sparkContext
    base = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{context.applicationId}/{label}-{uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back.

    Cuts the lineage at files that survive lost executors, fixes row positions, and
    keeps column pruning and footer counts for the readers that follow.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_apart(df: DataFrame, flag: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Write a frame once, its rows apart by a boolean column, and read both parts back.

    Returns the rows where the flag is false, and those where it is true, both without it.
    Tasks hold a writer for each part, so nothing is sorted for it.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    with two_writers(spark):
        df.write.partitionBy(flag).parquet(path)
    whole = spark.read.schema(df.schema).parquet(path)
    return whole.filter(~F.col(flag)).drop(flag), whole.filter(F.col(flag)).drop(flag)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once nothing reads them any more.

    Results that are built lazily still read them, so only the caller knows when that is.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark, "none")).getParent()
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(folder):
        files.delete(folder, True)
