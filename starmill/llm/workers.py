"""Arrow functions on Spark's Python workers, which first receive this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import starmill

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers the modules, once per application, as ``spark-submit --py-files``
    would. Spark serves the archive to every executor."""
    context = spark.sparkContext
    root = Path(starmill.__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="starmill-")) / "starmill_modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, str(Path(root.name) / module.relative_to(root)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


# Rows and bytes of a batch that crosses to Python at once, where the session leaves
# Spark's own limits (10,000 rows, 64 MiB): texts are long, and each task of an executor
# holds a batch on both sides.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16777216"),
}


def bound_batches(spark: SparkSession) -> None:
    for name, (usual, bounded) in BATCH.items():
        if spark.conf.get(name) == usual:
            spark.conf.set(name, bounded)


def map_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package at hand on the workers."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
