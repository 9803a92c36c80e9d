"""Parquet tables of a warehouse: replaced, appended to, or replaced by delivery."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmill.functions.values import constant


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Table without rows, which the optimizer knows to have none."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def dealt_evenly(scan: DataFrame, *by: str) -> DataFrame:
    """A plain scan whose rows are dealt by columns over the session's shuffle partitions where
    it has fewer splits than that, as one row group cannot be split. For work per row that is
    dear beside a shuffle; a scan with splits enough stays as it is."""
    wanted = int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if scan._jdf.rdd().getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, *by)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Stored table, or no rows when it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


class BrokenRules(ValueError):
    """A new version breaks rules of its table; the version before it stays the newest."""

    def __init__(self, name: str, broken: Mapping[str, int]):
        self.name, self.broken = name, dict(broken)
        listed = ", ".join(f"{rule}: {count} rows" for rule, count in self.broken.items())
        super().__init__(f"{name} is not published; {listed}")


Check = Callable[[DataFrame], Mapping[str, int]]


class Tables:
    """Tables under one root folder.

    A replaced table gets a new version folder, so a load may read the version it
    replaces; a version counts only once Spark has put its success marker there.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, name: str) -> list[tuple[int, bool]]:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        paths = [s.getPath() for s in files.listStatus(folder)]
        return sorted(
            (
                int(p.getName().removeprefix("v")),
                files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")),
            )
            for p in paths
            if p.getName().removeprefix("v").isdigit()
        )

    def path(self, name: str) -> str:
        """Folder of the newest complete version."""
        return self._folder(name, max(self._complete(name), default=1))

    def _folder(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/v{number:06d}"

    def _complete(self, name: str) -> list[int]:
        return [number for number, complete in self._versions(name) if complete]

    def _target(self, name: str) -> str:
        """Folder to add to: the newest complete version, else a new one."""
        unfinished = max([n for n, _ in self._versions(name)], default=0)
        return self._folder(name, max(self._complete(name), default=unfinished + 1))

    def _mark(self, folder: str) -> None:
        """State that a version is complete, also where Spark writes no success marker."""
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        files = marker.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(marker):
            files.create(marker, True).close()

    def read(self, name: str, schema: StructType | str) -> DataFrame:
        """Newest complete version; no rows while there is none."""
        if not self._complete(name):
            return empty(self.spark, schema)
        return read_or_empty(self.spark, self.path(name), schema)

    def replace(self, name: str, df: DataFrame, check: Check | None = None) -> DataFrame:
        """Full refresh: write the next version, check it, then publish it.

        Readers move to it once it is marked. ``check`` gets the version as it was written and
        returns the rules that it breaks, with the number of rows: if any, ``BrokenRules`` is
        raised and the version is never marked, so readers stay with the one before.
        """
        number = max([n for n, _ in self._versions(name)], default=0) + 1
        path = f"{self.root}/{name}/v{number:06d}"
        unmarked = df.write.mode("overwrite").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
        )
        unmarked.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        broken = check(stored) if check else {}
        if broken:
            raise BrokenRules(name, broken)
        self._mark(path)
        return stored

    def clean(self, name: str, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` complete versions, and the unfinished ones before
        the newest. Returns the deleted folders. Frames that still read them fail, so this
        is a step of its own and not part of a load."""
        complete = sorted(self._complete(name))[-keep:] if keep > 0 else []
        if not complete:
            return []
        jvm = self.spark._jvm
        gone = [n for n, _ in self._versions(name) if n not in complete and n < complete[-1]]
        for number in gone:
            folder = jvm.org.apache.hadoop.fs.Path(self._folder(name, number))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return [self._folder(name, number) for number in gone]

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows; the files already there stay untouched."""
        folder = self._target(name)
        df.write.mode("append").parquet(folder)
        self._mark(folder)

    def replace_deliveries(
        self, name: str, df: DataFrame, delivery: str, emptied: Iterable[str] = ()
    ) -> None:
        """Replace the rows of the deliveries in ``df`` and keep all others.

        Loading a file again then leaves one copy of it. ``emptied`` names delivered files
        of which no row is left: their stored rows go, too.
        """
        folder = self._target(name)
        # Rebalancing brings a delivery's rows together and splits a large delivery over
        # tasks, so files per delivery follow its size.
        df.hint("rebalance", delivery).write.mode("overwrite").partitionBy(delivery).option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(folder)
        self._mark(folder)
        jvm = self.spark._jvm
        for value in sorted(emptied):
            part = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
            stored = jvm.org.apache.hadoop.fs.Path(f"{folder}/{delivery}={part}")
            files = stored.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if files.exists(stored):
                files.delete(stored, True)


def appended(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def stamped(df: DataFrame, stamp, name: str = "DT_CARGA") -> DataFrame:
    """Add the load stamp of the run, one constant for all rows."""
    return df.withColumn(name, constant(stamp).cast("timestamp"))
