"""Which state of which file has been loaded."""

from __future__ import annotations

import re
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.delimited import FILE_SIZE, FILE_TIME, SOURCE_PATH
from starmill.sources.tables import read_or_empty

_SCHEMA = f"{SOURCE_PATH} string, {FILE_SIZE} bigint, {FILE_TIME} timestamp"
_KEY = [SOURCE_PATH, FILE_SIZE, FILE_TIME]


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and modification time of every file below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.col("_metadata.file_path").alias(SOURCE_PATH),
        F.col("_metadata.file_size").alias(FILE_SIZE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
    )


def readable_path(file: str) -> str:
    """A listed path as a reader takes it: decoded, and with no part of it a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(file))


class FileLedger:
    """Stored table of loaded files, as (path, size, modification time).

    Spark's file stream knows a path once, so it never reads a file that was corrected under
    its path. The ledger tells such files, by an anti-join of a listing: their size or time
    differs from what was loaded. Entries are only ever added.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, _SCHEMA)

    def unloaded(self, folder: str) -> DataFrame:
        """Files below a folder that were not loaded in their present state.

        Spark lists no file of length 0. So known files that the listing lacks are looked up
        one by one: those that exist were emptied, the others are gone and stay loaded.
        """
        listed = listed_files(self.spark, folder)
        entries = self.entries()
        last = entries.groupBy(SOURCE_PATH).agg(F.max_by(FILE_SIZE, FILE_TIME).alias("size"))
        unseen = last.filter("size > 0").join(listed, SOURCE_PATH, "left_anti").select(SOURCE_PATH)
        emptied = [row for file in unseen.collect() for row in self._emptied(file[0])]
        changed = listed.join(entries, _KEY, "left_anti")
        if emptied:
            changed = changed.unionByName(self.spark.createDataFrame(emptied, _SCHEMA))
        return changed

    def _emptied(self, file: str) -> list[tuple]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(unquote(file))
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        status = files.getFileStatus(path)
        time = datetime.fromtimestamp(status.getModificationTime() / 1000)
        return [(file, 0, time)] if status.getLen() == 0 else []

    def record(self, files: DataFrame) -> None:
        """Note files as loaded. A load that fails before this runs again, and replaces."""
        files.select(*_KEY).distinct().write.mode("append").parquet(self.path)
