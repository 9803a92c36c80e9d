"""Session settings the loads rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Spark's own tools against skew and badly sized partitions, stated because the loads
# count on them. Partition numbers are left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Call sites for error messages cost a stack walk per expression built in Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    cores: int | str = 8, name: str = "starmill", scratch: str | None = None
) -> SparkSession:
    """Single-machine session for tests and the benchmark; ``scratch`` is the folder of
    intermediate tables."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    return (
        builder.config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@contextmanager
def _with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def split_generated_code(spark: SparkSession):
    """Run wide projections as several methods instead of one, inside a ``with`` block.

    The JVM never compiles a method beyond 8000 bytecodes, and a projection that cleans
    some twenty text columns is beyond that; interpreted, it takes more than twice as
    long. The session's setting is put back afterwards.
    """
    return _with_settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


def finer_tasks(spark: SparkSession):
    """Leave four tasks a core at least, inside a ``with`` block, where small shuffle partitions
    are combined. One a core, as Spark has it, ends in a second round of a few tasks, twice as
    long where the work per row is dear."""
    wanted = str(4 * spark.sparkContext.defaultParallelism)
    return _with_settings(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionNum": wanted})


def footer_aggregates(spark: SparkSession):
    """Answer MIN, MAX and COUNT of Parquet tables read inside the ``with`` block from
    file footers, without reading any column."""
    settings = {
        "spark.sql.sources.useV1SourceList": "",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    return _with_settings(spark, settings)


def two_writers(spark: SparkSession):
    """Let a task hold several open files when it writes partitions, inside a ``with`` block,
    so that its rows need not be sorted by partition first."""
    return _with_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"})
