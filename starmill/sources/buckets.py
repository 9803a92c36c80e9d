"""Parquet tables stored in buckets of a key, for joins on it without a shuffle."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class BucketedTable:
    """A table under a path whose rows are stored by a hash of their key, sorted within.

    Spark keeps buckets in its catalog, so a session registers the table once, from its
    schema, key and number of buckets; the files are all that lasts. Two tables with equal
    numbers of buckets are joined on their keys bucket by bucket.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: str, buckets: int):
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.columns = fields.names
        self.name = "buckets_" + hashlib.md5(f"{path}|{key}|{buckets}".encode()).hexdigest()
        if not spark.catalog.tableExists(self.name):
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            place = path.replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE {self.name} ({listed}) USING parquet"
                f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
            )

    def append(self, df: DataFrame) -> None:
        """Add rows. They are dealt by key first, so that a bucket gets one file a load."""
        self._dealt(df).write.insertInto(self.name)

    def replace(self, df: DataFrame) -> None:
        """Replace all rows; ``df`` must not read the table."""
        self._dealt(df).write.insertInto(self.name, overwrite=True)

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.select(*[f"`{c}`" for c in self.columns]).repartition(self.buckets, self.key)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)
